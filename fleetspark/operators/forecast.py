"""Forecasts fitted for many series at once.

The fact is aggregated to months on the cluster; a series is at most a few hundred monthly rows.
``keys`` names the columns that tell series apart; without keys there is one fleet-wide series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from ..functions.columns import merged_exact, merged_sum, partials, round_floor
from .star import add_months

MONTH = ["ano", "mes"]
ONE_SERIES = "serie"
REGRESSORS = ["periodo_idx", "km_rodado", "custo_combustivel"]
TARGET = "custo_por_km"
MIN_ARIMA_POINTS = 8
ARIMA, AVERAGE = "arima_hr", "media_movel_3m"
# why a series has the model it has
FITTED, SHORT, SINGULAR, UNSTABLE = "ajustado", "poucos_meses", "singular", "instavel"


def _with_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Give the keyless case one constant key, so every step groups the same way."""
    if keys:
        return df, list(keys)
    keyed = df if ONE_SERIES in df.columns else df.withColumn(ONE_SERIES, F.lit("TOTAL"))
    return keyed, [ONE_SERIES]


# --- monthly series ---------------------------------------------------------------

def monthly_base(rows: DataFrame, keys: Sequence[str] = (), dim_veiculo: DataFrame | None = None) -> DataFrame:
    """Sums and counts per series and month: the only step that reads the fact. Coarser series
    come from it with ``roll_up``.

    ``rows`` have ``ano`` and ``mes``, or ``sk_tempo``. With the key ``tipo_veiculo`` the vehicle table
    gives the type; it joins what the fact folds to per vehicle and month.
    """
    rows, keys = _with_keys(rows, keys)
    month = MONTH if "ano" in rows.columns else ["sk_tempo"]
    sums = partials(["custo_combustivel", "custo_manutencao", "km_rodado"], [TARGET])
    if "tipo_veiculo" in keys and dim_veiculo is not None:
        own = [k for k in keys if k != "tipo_veiculo"]
        folded = rows.groupBy("sk_veiculo", *own, *month).agg(*sums)
        parts = [c for c in folded.columns if c[:2] in ("s_", "n_")]
        typed = folded.join(dim_veiculo.select("sk_veiculo", "tipo_veiculo"), "sk_veiculo")
        base = typed.groupBy(*keys, *month).agg(
            *(F.sum(F.col(c).cast("decimal(28,0)")).cast("decimal(28,0)").alias(c) for c in parts)
        )
    else:
        base = rows.groupBy(*keys, *month).agg(*sums)
    return base if month == MONTH else base.transform(add_months, *MONTH).drop("sk_tempo")


def roll_up(base: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean cost per km and monthly sums per series, with a month index that starts in January
    of the series' first year as 1."""
    base, keys = _with_keys(base, keys)
    monthly = base.groupBy(*keys, *MONTH).agg(
        merged_exact(TARGET).cast("double").alias(TARGET),
        merged_sum("custo_combustivel").cast("double").alias("custo_combustivel"),
        merged_sum("custo_manutencao").cast("double").alias("custo_manutencao"),
        merged_sum("km_rodado").alias("km_rodado"),
    )
    first_year = F.min("ano").over(Window.partitionBy(*keys))
    return monthly.withColumn("periodo_idx", ((F.col("ano") - first_year) * 12 + F.col("mes")).cast("int"))


def monthly_series(rows: DataFrame, keys: Sequence[str] = (), dim_veiculo: DataFrame | None = None) -> DataFrame:
    """The monthly series of fact rows."""
    return roll_up(monthly_base(rows, keys, dim_veiculo), keys)


def last_period(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Latest year and the latest month within it, per series."""
    series, keys = _with_keys(series, keys)
    last = series.groupBy(*keys).agg(F.max(F.struct(*MONTH)).alias("u"))
    return last.select(*keys, F.col("u.ano").alias("ultimo_ano"), F.col("u.mes").alias("ultimo_mes"))


# --- linear regression ------------------------------------------------------------

# a regressor that the ones before it explain up to this share of its variation has coefficient 0
DEPENDENT = 1e-10


def fit_regression(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per series: coefficients, in-sample R² (0 for a constant target), mean absolute
    error and the last month.

    Least squares on centred values: the regressors are made orthogonal one after the other
    (month, distance, fuel cost), each against the ones before it. One that is constant, or that depends
    on the ones before it, gets the coefficient 0. All sums are windows over one series, so one
    shuffle serves means, sums and errors. Months with a missing value teach nothing.
    """
    series, keys = _with_keys(series, keys)
    whole = Window.partitionBy(*keys)
    names = dict(zip("pqzw", [*REGRESSORS, TARGET]))
    points = series.select(
        *keys, *MONTH, *(F.col(c).cast("double").alias(x) for x, c in names.items())
    ).dropna(subset=list(names))
    points = points.withColumns({f"m{x}": F.avg(x).over(whole) for x in names} | {"n": F.count(F.lit(1)).over(whole)})
    points = points.withColumns({f"c{x}": F.col(x) - F.col(f"m{x}") for x in names})
    pairs = ["pp", "pq", "pz", "pw", "qq", "qz", "qw", "zz", "zw", "ww"]
    points = points.withColumns({xy: F.sum(F.col(f"c{xy[0]}") * F.col(f"c{xy[1]}")).over(whole) for xy in pairs})
    pp, pq, pz, pw, qq, qz, qw, zz, zw, ww = (F.col(xy) for xy in pairs)

    def varies(left: Column, of: Column, mean: str) -> Column:
        """Whether a variation is more than what rounding leaves of ``of`` or of a constant."""
        return (left > F.lit(DEPENDENT) * of) & (left > F.lit(DEPENDENT**2) * F.col("n") * F.col(mean) * F.col(mean))

    def over(num: Column, den: str, able: str) -> Column:
        return F.when(F.col(able), num / F.col(den)).otherwise(0.0)

    steps = [
        {"up": varies(pp, pp, "mp")},
        {"qp": over(pq, "pp", "up"), "zp": over(pz, "pp", "up"), "wp": over(pw, "pp", "up")},
        {"q1": qq - F.col("qp") * pq, "qz1": qz - F.col("qp") * pz, "qw1": qw - F.col("qp") * pw},
        {"uq": varies(F.col("q1"), qq, "mq")},
        {"zq": over(F.col("qz1"), "q1", "uq"), "wq": over(F.col("qw1"), "q1", "uq")},
        {"z1": zz - F.col("zp") * pz - F.col("zq") * F.col("qz1"), "zw1": zw - F.col("zp") * pw - F.col("zq") * F.col("qw1")},
        {"uz": varies(F.col("z1"), zz, "mz")},
        {"bz": over(F.col("zw1"), "z1", "uz")},
        {"bq": F.col("wq") - F.col("bz") * F.col("zq")},
        {"bp": F.col("wp") - F.col("bz") * F.col("zp") - F.col("bq") * F.col("qp")},
        {"erro": F.col("cw") - F.col("bp") * F.col("cp") - F.col("bq") * F.col("cq") - F.col("bz") * F.col("cz")},
    ]
    for step in steps:
        points = points.withColumns(step)
    b0 = F.col("mw") - F.col("bp") * F.col("mp") - F.col("bq") * F.col("mq") - F.col("bz") * F.col("mz")
    fits = points.groupBy(*keys).agg(
        F.first(b0).alias("intercepto"), F.first("bp").alias("coef_periodo_idx"),
        F.first("bq").alias("coef_km_rodado"), F.first("bz").alias("coef_custo_combustivel"),
        F.first(F.when(varies(ww, ww, "mw"), ww)).alias("ww"), F.sum(F.col("erro") * F.col("erro")).alias("sse"),
        F.avg(F.abs("erro")).alias("mae"), F.count(F.lit(1)).alias("n"),
        F.min("ano").cast("long").alias("ano_base"), F.max(F.struct(*MONTH)).alias("u"),
    )
    return fits.select(
        *keys, "intercepto", "coef_periodo_idx", "coef_km_rodado", "coef_custo_combustivel",
        F.coalesce(1.0 - F.col("sse") / F.col("ww"), F.lit(0.0)).alias("r2"), "mae", "n", "ano_base",
        F.col("u.ano").cast("long").alias("ultimo_ano"), F.col("u.mes").cast("long").alias("ultimo_mes"),
    )


def forecast_regression(
    fit: DataFrame, keys: Sequence[str] = (), periods: int = 6,
    km: float = 500_000.0, fuel_cost: float = 1_800_000.0,
) -> DataFrame:
    """The next months from the fitted plane at assumed distance and fuel cost, on the same month
    index the fit used."""
    keys = list(keys) or [ONE_SERIES]
    steps = fit.withColumn("passo", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    month0 = F.col("ultimo_mes") + F.col("passo") - 1
    steps = steps.withColumns(
        {
            "mes": (month0 % 12 + 1).cast("int"),
            "ano": (F.col("ultimo_ano") + F.floor(month0 / 12)).cast("int"),
        }
    )
    index = (F.col("ano") - F.col("ano_base")) * 12 + F.col("mes")
    value = (
        F.col("intercepto") + F.col("coef_periodo_idx") * index
        + F.col("coef_km_rodado") * F.lit(km) + F.col("coef_custo_combustivel") * F.lit(fuel_cost)
    )
    return steps.select(
        *keys, "ano", "mes", round_floor(value, 4).alias("custo_por_km_previsto"),
        F.lit("regressao_linear").alias("modelo"),
    )


# --- ARIMA(1,1,1) -----------------------------------------------------------------

def _solve2(a11: Column, a12: Column, a22: Column, b1: Column, b2: Column) -> tuple[Column, Column]:
    """Solution of a symmetric 2x2 system; NULL when it is singular."""
    det = a11 * a22 - a12 * a12
    safe = F.when(F.abs(det) > F.lit(1e-12) * a11 * a22, det)
    return (b1 * a22 - b2 * a12) / safe, (b2 * a11 - b1 * a12) / safe


def fit_arima(
    series: DataFrame, keys: Sequence[str] = (), min_points: int = MIN_ARIMA_POINTS, averages: int = 0,
) -> DataFrame:
    """ARIMA(1,1,1) without constant by two least-squares stages (Hannan-Rissanen).

    Stage one regresses the monthly change on its two predecessors and keeps the residuals;
    stage two regresses it on its predecessor and the previous residual, which gives ``phi`` and
    ``theta``. Everything is a window over one series, so one shuffle serves both stages.
    ``valido`` is false for fewer than ``min_points`` months, as two stages on three lost months would
    fit noise, for a singular stage or abs(phi) >= 1; ``motivo`` says which. ``aic`` is
    conditional on the first changes and not comparable with an exact-likelihood one. With ``averages``
    the row also has what ``moving_average`` needs for so many steps, from the same windows.
    """
    series, keys = _with_keys(series, keys)
    in_order = Window.partitionBy(*keys).orderBy(*MONTH)
    whole = Window.partitionBy(*keys)
    y, w, w1, w2, e, e1 = (F.col(c) for c in ["y", "w", "w1", "w2", "e", "e1"])

    def summed(product: Column, used: Column) -> Column:
        return F.sum(F.when(used, product)).over(whole)

    more = _averages(in_order, whole) if averages else {}
    base = series.select(*keys, *MONTH, F.col(TARGET).alias("y"), *(c.alias(x) for x, c in more.items()))
    base = base.withColumn("w", y - F.lag("y").over(in_order))
    base = base.withColumns({"w1": F.lag("w", 1).over(in_order), "w2": F.lag("w", 2).over(in_order)})
    two = w2.isNotNull()
    a1, a2 = _solve2(*(F.col(c) for c in ["s11", "s12", "s22", "s01", "s02"]))
    one = base.withColumns(
        {
            "s11": summed(w1 * w1, two), "s12": summed(w1 * w2, two), "s22": summed(w2 * w2, two),
            "s01": summed(w * w1, two), "s02": summed(w * w2, two),
        }
    ).withColumn("e", w - a1 * w1 - a2 * w2)
    lagged = one.withColumn("e1", F.lag("e").over(in_order))
    has = e1.isNotNull()
    phi, theta = _solve2(*(F.col(c) for c in ["t11", "t12", "t22", "t01", "t02"]))
    limit = F.lit(0.99)
    stage2 = lagged.withColumns(
        {
            "t11": summed(w1 * w1, has), "t12": summed(w1 * e1, has), "t22": summed(e1 * e1, has),
            "t01": summed(w * w1, has), "t02": summed(w * e1, has),
        }
    ).withColumns({"phi": phi, "theta": F.greatest(F.least(theta, limit), -limit)})
    error = w - F.col("phi") * w1 - F.col("theta") * e1
    latest = F.max_by(F.struct("y", "w", "e", *MONTH), F.struct(*MONTH)).alias("u")
    out = stage2.groupBy(*keys).agg(
        F.count("y").alias("n"), F.first("phi").alias("phi"), F.first("theta").alias("theta"),
        F.sum(F.when(has, error * error)).alias("sse"), F.count(F.when(has, 1)).alias("usados"),
        latest, *(_kept_averages("y", averages) if averages else []),
    )
    valid = (
        (F.col("n") >= min_points) & F.col("phi").isNotNull() & F.col("theta").isNotNull()
        & (F.abs("phi") < 1)
    )
    reason = (
        F.when(F.col("n") < min_points, SHORT)
        .when(F.col("phi").isNull() | F.col("theta").isNull(), SINGULAR)
        .when(F.abs("phi") < 1, FITTED).otherwise(UNSTABLE)
    )
    aic = F.col("usados") * F.log(F.col("sse") / F.col("usados")) + F.lit(2.0 * 3)
    return out.select(
        *keys, "n", "phi", "theta", F.coalesce(valid, F.lit(False)).alias("valido"), reason.alias("motivo"),
        F.when(valid & (F.col("sse") > 0), aic).alias("aic"),
        F.col("u.y").alias("y_ultimo"),
        (F.col("phi") * F.col("u.w") + F.col("theta") * F.col("u.e")).alias("delta_1"),
        *(["meses", "geral", "medias"] if averages else []),
    )


def forecast_arima(fit: DataFrame, keys: Sequence[str] = (), periods: int = 6) -> DataFrame:
    """Closed-form forecast of the valid fits: last value plus a geometric sum of the next change."""
    keys = list(keys) or [ONE_SERIES]
    steps = fit.filter("valido").withColumn("periodo", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    return steps.select(
        *keys, "periodo", round_floor(_arima_value(), 4).alias("valor_previsto"), F.lit(ARIMA).alias("modelo"))


def _arima_value() -> Column:
    path = (F.lit(1.0) - F.pow("phi", F.col("periodo").cast("double"))) / (F.lit(1.0) - F.col("phi"))
    return F.col("y_ultimo") + F.col("delta_1") * path


# --- moving average ---------------------------------------------------------------

def _averages(in_order: WindowSpec, whole: WindowSpec) -> dict[str, Column]:
    """Three-month means and the place of each month of a series."""
    three = in_order.rowsBetween(-2, 0)
    return {
        "media": F.when(F.count(TARGET).over(three) == 3, F.avg(TARGET).over(three)),
        "pos": F.row_number().over(in_order),
        "meses": F.count(F.lit(1)).over(whole),
    }


def _kept_averages(target: str, periods: int) -> list[Column]:
    """Number of months, mean of the series and its last ``periods`` three-month means by place."""
    last = F.when(F.col("pos") > F.col("meses") - periods, F.struct("pos", "media"))
    return [
        F.first("meses").alias("meses"), F.avg(target).alias("geral"),
        F.map_from_entries(F.collect_list(last)).alias("medias"),
    ]


def _average_value(periods: int) -> Column:
    rolling = F.try_element_at("medias", (F.col("meses") - periods + F.col("periodo")).cast("int"))
    return F.when(F.col("meses") >= periods, rolling).otherwise(F.col("geral"))


def moving_average(series: DataFrame, keys: Sequence[str] = (), periods: int = 6) -> DataFrame:
    """The last ``periods`` three-month means as the forecast; the series mean throughout when the
    series has fewer months than that. Places before the third month have no mean and stay NULL."""
    series, keys = _with_keys(series, keys)
    columns = _averages(Window.partitionBy(*keys).orderBy(*MONTH), Window.partitionBy(*keys))
    rows = series.select(*keys, *MONTH, TARGET, *(c.alias(x) for x, c in columns.items()))
    folded = rows.groupBy(*keys).agg(*_kept_averages(TARGET, periods))
    placed = folded.withColumn("periodo", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    return placed.select(
        *keys, "periodo", round_floor(_average_value(periods), 4).alias("valor_previsto"), F.lit(AVERAGE).alias("modelo"))


def fallback(series: DataFrame, fit: DataFrame, keys: Sequence[str] = (), periods: int = 6) -> DataFrame:
    """The moving average of the series that ARIMA could not be fitted to."""
    keys_ = list(keys) or [ONE_SERIES]
    rest = fit.filter(~F.col("valido")).select(*keys_)
    return moving_average(series, keys, periods).join(rest, keys_, "left_semi")


def forecast_series(series: DataFrame, keys: Sequence[str] = (), periods: int = 6) -> DataFrame:
    """A forecast for every series: ARIMA where it could be fitted, else the moving average, with the model
    and the reason for it (``motivo``). The windows of one shuffle give both."""
    fit = fit_arima(series, keys, averages=periods)
    keys = list(keys) or [ONE_SERIES]
    steps = fit.withColumn("periodo", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    value = F.when(F.col("valido"), _arima_value()).otherwise(_average_value(periods))
    return steps.select(
        *keys, "periodo", round_floor(value, 4).alias("valor_previsto"),
        F.when(F.col("valido"), ARIMA).otherwise(AVERAGE).alias("modelo"), "motivo",
    )


# --- trend ------------------------------------------------------------------------

def trend(series: DataFrame, keys: Sequence[str] = ("tipo_veiculo",), min_months: int = 3) -> DataFrame:
    """Straight line over the month position 0..n-1 of each series with enough months.

    The projection stands at position n+6, seven steps after the last month, as published.
    """
    keys = list(keys)
    in_order = Window.partitionBy(*keys).orderBy(*MONTH)
    placed = series.select(
        *keys, TARGET, (F.row_number().over(in_order) - 1).cast("double").alias("x")
    )
    lines = placed.groupBy(*keys).agg(
        F.regr_slope(TARGET, "x").alias("a"), F.regr_intercept(TARGET, "x").alias("b"),
        F.max_by(TARGET, "x").alias("ultimo"), F.count(F.lit(1)).alias("n"),
    )
    return lines.filter(F.col("n") >= min_months).select(
        *keys,
        F.when(F.col("a") > 0, "CRESCENTE").otherwise("DECRESCENTE").alias("tendencia"),
        round_floor("a", 6).alias("inclinação"),
        round_floor("ultimo", 4).alias("custo_atual"),
        round_floor(F.col("a") * (F.col("n") + 6) + F.col("b"), 4).alias("custo_projecao_6m"),
    )
