import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from fleetspark.operators import forecast

from .conftest import rows

SERIES = "k string, ano int, mes int, custo_por_km double, custo_combustivel double, custo_manutencao double, km_rodado long, periodo_idx int"


def months(n, start=2020):
    return [(start + i // 12, i % 12 + 1) for i in range(n)]


def series(spark, **values):
    """One series per keyword from its monthly values; regressors vary but carry no signal of their own."""
    data = []
    for key, ys in values.items():
        for i, ((ano, mes), y) in enumerate(zip(months(len(ys)), ys)):
            data.append((key, ano, mes, float(y), float(1000 + (i * 37) % 11 * 50), 0.0, 500 + (i * 53) % 13 * 20, i + 1))
    return spark.createDataFrame(data, SERIES)


def test_monthly_series_index_and_last_period(spark):
    df = spark.createDataFrame(
        [("a", 2023, 11, "1.0", 1), ("a", 2023, 11, "2.0", 2), ("a", 2025, 2, "3.0", 3), ("b", 2024, 6, "4.0", 4)],
        "k string, ano int, mes int, custo_por_km string, km_rodado int",
    ).withColumns({"custo_por_km": F.col("custo_por_km").cast("decimal(12,4)"),
                   "custo_combustivel": F.lit(1).cast("decimal(12,2)"), "custo_manutencao": F.lit(2).cast("decimal(12,2)")})
    got = {(r.k, r.ano, r.mes): (r.periodo_idx, r.custo_por_km, r.km_rodado) for r in forecast.monthly_series(df, ["k"]).collect()}
    assert got == {("a", 2023, 11): (11, 1.5, 3), ("a", 2025, 2): (26, 3.0, 3), ("b", 2024, 6): (6, 4.0, 4)}
    assert {r.serie for r in forecast.monthly_series(df).collect()} == {"TOTAL"}
    last = {r.k: (r.ultimo_ano, r.ultimo_mes) for r in forecast.last_period(forecast.monthly_series(df, ["k"]), ["k"]).collect()}
    assert last == {"a": (2025, 2), "b": (2024, 6)}


def plane(spark, n=30):
    return series(spark, a=[0] * n).withColumn(
        "custo_por_km", 2 + 0.01 * F.col("periodo_idx") + 1e-3 * F.col("km_rodado") - 5e-4 * F.col("custo_combustivel"))


def test_regression_recovers_a_plane(spark):
    fit = forecast.fit_regression(plane(spark), ["k"]).first()
    got = [fit.intercepto, fit.coef_periodo_idx, fit.coef_km_rodado, fit.coef_custo_combustivel]
    assert np.allclose(got, [2, 0.01, 1e-3, -5e-4]) and fit.r2 == pytest.approx(1) and fit.mae < 1e-9
    f = forecast.forecast_regression(forecast.fit_regression(plane(spark), ["k"]), ["k"], periods=8, km=600, fuel_cost=1000)
    got = [(r.ano, r.mes, r.custo_por_km_previsto) for r in f.orderBy("ano", "mes").collect()]
    assert [g[:2] for g in got] == [(2022, m) for m in range(7, 13)] + [(2023, 1), (2023, 2)]
    assert [g[2] for g in got] == [pytest.approx(round(2.1 + 0.01 * i, 4)) for i in range(31, 39)]


def test_regression_equals_spark_ml(spark):
    rng = np.random.default_rng(5)
    df = series(spark, a=3 + rng.normal(size=40))
    fit = forecast.fit_regression(df, ["k"]).first()
    data = VectorAssembler(inputCols=forecast.REGRESSORS, outputCol="x").transform(df)
    model = LinearRegression(featuresCol="x", labelCol="custo_por_km", solver="normal", regParam=0.0).fit(data)
    assert np.allclose([fit.coef_periodo_idx, fit.coef_km_rodado, fit.coef_custo_combustivel], model.coefficients.toArray())
    assert fit.r2 == pytest.approx(model.summary.r2) and fit.mae == pytest.approx(model.summary.meanAbsoluteError)


def test_dependent_regressors_get_the_coefficient_zero(spark):
    df = series(spark, a=[0] * 20).withColumns({"km_rodado": F.col("periodo_idx") * 7 + 3, "custo_combustivel": F.lit(0.1)})
    fit = forecast.fit_regression(df.withColumn("custo_por_km", 1 + F.col("periodo_idx") * 0.5), ["k"]).first()
    assert (fit.coef_km_rodado, fit.coef_custo_combustivel) == (0, 0)
    assert np.allclose([fit.intercepto, fit.coef_periodo_idx, fit.r2], [1, 0.5, 1]) and fit.mae < 1e-9
    missing = df.withColumn("custo_por_km", F.when(F.col("mes") != 3, 1 + F.col("periodo_idx") * 0.5))
    assert forecast.fit_regression(missing, ["k"]).first().n == 18


def test_series_with_the_type_fold_before_the_vehicles_join(spark):
    fact = spark.createDataFrame([(1, 202401, "1.0", 10), (1, 202401, "2.0", 20), (2, 202402, "4.0", 40), (3, 202401, "6.0", 60)],
                                 "sk_veiculo long, sk_tempo int, custo_por_km string, km_rodado int")
    fact = fact.withColumns({"custo_por_km": F.col("custo_por_km").cast("decimal(12,4)"),
                             "custo_combustivel": F.lit(1).cast("decimal(12,2)"), "custo_manutencao": F.lit(2).cast("decimal(12,2)")})
    types = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A")], "sk_veiculo long, tipo_veiculo string")
    got = [(r.tipo_veiculo, r.ano, r.mes, r.custo_por_km, r.km_rodado) for r in
           forecast.monthly_series(fact, ["tipo_veiculo"], types).orderBy("mes").collect()]
    assert got == [("A", 2024, 1, 3.0, 90), ("A", 2024, 2, 4.0, 40)]


def test_constant_and_tiny_series(spark):
    fits = {r.k: r for r in forecast.fit_regression(series(spark, c=[2.5] * 12, one=[7.0]), ["k"]).collect()}
    assert fits["c"].r2 == 0 and fits["c"].intercepto == pytest.approx(2.5)
    assert fits["one"].r2 == 0 and fits["one"].mae == 0 and fits["one"].n == 1


def arma(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 200)
    w = np.zeros(n + 200)
    for t in range(1, n + 200):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    return 100 + np.cumsum(w[200:])


def hannan_rissanen(y):
    """The two stages by numpy least squares."""
    w = np.diff(y)
    a, *_ = np.linalg.lstsq(np.c_[w[1:-1], w[:-2]], w[2:], rcond=None)
    e = w[2:] - np.c_[w[1:-1], w[:-2]] @ a
    x, target = np.c_[w[2:-1], e[:-1]], w[3:]
    (phi, theta), *_ = np.linalg.lstsq(x, target, rcond=None)
    theta = min(max(theta, -0.99), 0.99)
    sse = float(((target - x @ [phi, theta]) ** 2).sum())
    step = phi * w[-1] + theta * e[-1]
    path = [y[-1] + step * sum(phi**j for j in range(h)) for h in range(1, 7)]
    return phi, theta, len(target) * math.log(sse / len(target)) + 6, path


def test_arima_equals_numpy(spark):
    data = {f"s{i}": arma(84, 0.6, 0.3, i) for i in range(6)}
    fit = forecast.fit_arima(series(spark, **data), ["k"])
    fits = {r.k: r for r in fit.collect()}
    paths = {}
    for r in forecast.forecast_arima(fit, ["k"]).orderBy("k", "periodo").collect():
        paths.setdefault(r.k, []).append(r.valor_previsto)
    for k, y in data.items():
        phi, theta, aic, path = hannan_rissanen(y)
        assert (fits[k].phi, fits[k].theta, fits[k].aic) == pytest.approx((phi, theta, aic))
        if abs(phi) < 1:
            assert paths[k] == pytest.approx(path, abs=1e-4)


def test_arima_recovers_its_parameters(spark):
    fit = forecast.fit_arima(series(spark, a=arma(4000, 0.6, 0.3, 1)), ["k"]).first()
    assert fit.phi == pytest.approx(0.6, abs=0.08) and fit.theta == pytest.approx(0.3, abs=0.08)


def test_short_and_singular_series_fall_back(spark):
    wild = [2.0**i + 0.1 * (i % 3) for i in range(12)]
    df = series(spark, short=[1, 2, 4, 3, 5, 4, 6], flat=[3.0] * 20, good=arma(60, 0.5, 0.2, 3), wild=wild, one=[2.0])
    got = {}
    for r in forecast.forecast_series(df, ["k"]).orderBy("k", "periodo").collect():
        got.setdefault((r.k, r.modelo, r.motivo), []).append(r.valor_previsto)
    average = "media_movel_3m"
    assert set(got) == {("short", average, "poucos_meses"), ("flat", average, "singular"), ("good", "arima_hr", "ajustado"),
                        ("wild", average, "instavel"), ("one", average, "poucos_meses")}
    assert got[("flat", average, "singular")] == [3.0] * 6
    assert got[("short", average, "poucos_meses")] == [None, 2.3333, 3.0, 4.0, 4.0, 5.0]
    assert got[("one", average, "poucos_meses")] == [2.0] * 6


def test_one_pass_equals_both_models_apart(spark):
    df = series(spark, short=[1, 2, 4, 3, 5, 4, 6], good=arma(60, 0.5, 0.2, 3), flat=[1.5] * 9)
    fit = forecast.fit_arima(df, ["k"])
    apart = forecast.forecast_arima(fit, ["k"]).unionByName(forecast.fallback(df, fit, ["k"]))
    assert rows(forecast.forecast_series(df, ["k"]).drop("motivo")) == rows(apart)
    plan = forecast.forecast_series(df.repartition(3), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1


def test_moving_average_of_few_months_is_the_mean(spark):
    got = forecast.moving_average(series(spark, a=[1, 2, 4]), ["k"], periods=4)
    assert [r.valor_previsto for r in got.collect()] == [2.3333] * 4
    got = forecast.moving_average(series(spark, a=[1, 2, 3, 4, 5]), ["k"], periods=3).orderBy("periodo")
    assert [r.valor_previsto for r in got.collect()] == [2.0, 3.0, 4.0]


def test_trend(spark):
    df = series(spark, up=[1, 2, 3], down=[9, 7, 5, 3], flat=[2, 2, 2], two=[1, 5]).withColumnRenamed("k", "tipo_veiculo")
    got = {r.tipo_veiculo: (r.tendencia, r["inclinação"], r.custo_atual, r.custo_projecao_6m) for r in forecast.trend(df).collect()}
    assert got == {"up": ("CRESCENTE", 1.0, 3.0, 10.0), "down": ("DECRESCENTE", -2.0, 3.0, -11.0),
                   "flat": ("DECRESCENTE", 0.0, 2.0, 2.0)}


def test_keyless_series_work_end_to_end(spark):
    df = series(spark, a=arma(40, 0.4, 0.1, 9)).drop("k")
    assert forecast.forecast_series(df).count() == 6
    assert rows(forecast.fit_regression(df).select("serie", "n")) == [(40, "TOTAL")]
