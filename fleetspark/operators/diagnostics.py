"""The five diagnostics: price impact, inefficiency, root cause, age effect, consumption anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import reference_data as ref
from ..functions.columns import (
    RATIO_DIGITS, exact_mean, mean, merged_exact, merged_mean, partials, per, percent,
    rounded_quotient, upper_bound_band,
)
from .star import add_months
from .views import by_month_and_type, per_km


def _dec(text: str) -> Column:
    return F.lit(text).cast("decimal(6,2)")


def price_impact(
    fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame, by_state: bool = False,
) -> DataFrame:
    """Fuel price, its share of cost and the change against the previous row of the type.

    Rows of one type are ordered by month and, within a month, by state, which makes the
    previous row definite; ``by_state`` compares each state with its own previous month instead.
    The window runs on the aggregate (states x months per type).
    """
    rows = by_month_and_type(
        fato, dim_veiculo, ["sk_tempo", "sk_estado"],
        partials(
            means=["preco_combustivel", "custo_por_km", "custo_combustivel"],
            ratios={"impacto": per("custo_combustivel", "custo_total")},
        ),
    ).agg(
        F.sum("s_preco_combustivel").cast("decimal(20,0)").alias("s"),  # in cents
        F.sum("n_preco_combustivel").cast("decimal(18,0)").alias("n"),
        merged_mean("custo_por_km", 4).alias("custo_por_km"),
        merged_mean("custo_combustivel", 2).alias("custo_combustivel"),
        F.round(merged_exact("impacto", RATIO_DIGITS) * 100, 1).alias("impacto_pct"),
    )
    group = ["tipo_veiculo", "sigla_estado"] if by_state else ["tipo_veiculo"]
    before = Window.partitionBy(*group).orderBy("ano", "mes", "sigla_estado")
    s, n, s0, n0 = (F.col(c) for c in ["s", "n", "s0", "n0"])
    return (
        rows.join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .transform(add_months, "ano", "mes")
        .withColumns({"s0": F.lag("s").over(before), "n0": F.lag("n").over(before)})
        .select(
            "ano", "mes", "tipo_veiculo", "sigla_estado",
            rounded_quotient(s, n, 2).alias("preco_combustivel"), "custo_por_km", "custo_combustivel",
            "impacto_pct",
            rounded_quotient(s0, n0, 2).alias("preco_anterior"),
            # the change of the mean, over a common divisor so the quotient is taken once
            rounded_quotient((s * n0 - s0 * n) * 1000, s0 * n, 1).alias("variacao_preco_pct"),
        )
    )


def inefficient_vehicles(fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Vehicle, state and age rows above 1.00 per km with class and consumption deviation."""
    rows = (
        fato.groupBy("sk_veiculo", "sk_estado", "idade_veiculo")
        .agg(
            exact_mean("custo_por_km").alias("_custo"),
            mean("custo_combustivel", 2).alias("custo_combustivel_medio"),
            mean("custo_manutencao", 2).alias("custo_manutencao_medio"),
            mean("disponibilidade_pct", 1).alias("disponibilidade"),
            exact_mean("km_por_litro_real").alias("_consumo"),
        )
        .filter(F.col("_custo") > _dec("1.00"))
    )
    vehicle = dim_veiculo.select(
        "sk_veiculo", "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "status",
        F.col("consumo_medio_km_l").alias("consumo_esperado"),
    )
    critical, attention, _ = ref.LIMITS["custo_por_km"]
    cost_class = (
        F.when(F.col("_custo") > _dec(str(critical)), "CRITICO")
        .when(F.col("_custo") > _dec(str(attention)), "ATENCAO")
        .otherwise("NORMAL")
    )
    return (
        rows.join(vehicle, "sk_veiculo")
        .join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .orderBy(F.col("_custo").desc(), "id_veiculo", "sigla_estado", "idade_veiculo")
        .select(
            "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "status", "sigla_estado",
            "idade_veiculo", F.round("_custo", 4).alias("custo_por_km"), "custo_combustivel_medio",
            "custo_manutencao_medio", "disponibilidade", F.round("_consumo", 2).alias("consumo_real"),
            "consumo_esperado",
            percent(F.col("consumo_esperado") - F.col("_consumo"), "consumo_esperado", 1)
            .alias("desvio_consumo_pct"),
            cost_class.alias("classificacao_custo"),
        )
    )


def root_cause(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Cost components per km by type and age, and the largest of fuel, maintenance and
    depreciation (fuel must beat both others; maintenance must beat depreciation)."""
    parts = {
        "custo_comb_km": "custo_combustivel", "custo_man_km": "custo_manutencao",
        "custo_seg_km": "custo_seguro", "custo_dep_km": "custo_depreciacao",
    }
    by_vehicle = fato.groupBy("sk_veiculo", "idade_veiculo").agg(
        F.count(F.lit(1)).alias("linhas"),
        *partials(means=["custo_por_km"], ratios={name: per_km(cost) for name, cost in parts.items()}),
    )
    fuel, upkeep, wear = (
        merged_exact(c, RATIO_DIGITS) for c in ("custo_comb_km", "custo_man_km", "custo_dep_km")
    )
    cause = (
        F.when((fuel > upkeep) & (fuel > wear), "COMBUSTIVEL")
        .when(upkeep > wear, "MANUTENCAO")
        .otherwise("DEPRECIACAO")
    )
    band = upper_bound_band("idade_veiculo", ref.AGE_YEARS, ref.AGE_YEARS_ABOVE)
    return (
        by_vehicle.join(dim_veiculo.select("sk_veiculo", "tipo_veiculo"), "sk_veiculo")
        .groupBy("tipo_veiculo", "idade_veiculo", band.alias("faixa_idade"))
        .agg(
            F.sum("linhas").alias("num_registros"),
            merged_mean("custo_por_km", 4).alias("custo_por_km"),
            *(merged_mean(name, 4, RATIO_DIGITS).alias(name) for name in parts),
            cause.alias("principal_causa"),
        )
        .orderBy("tipo_veiculo", "faixa_idade", "idade_veiculo")
    )


def age_and_maintenance(fato: DataFrame) -> DataFrame:
    """Maintenance, cost, availability and consumption by vehicle age."""
    return (
        fato.groupBy("idade_veiculo")
        .agg(
            F.count_distinct("sk_veiculo").alias("total_veiculos"),
            mean("custo_manutencao", 2).alias("custo_manutencao_medio"),
            mean("custo_por_km", 4).alias("custo_por_km_medio"),
            mean("disponibilidade_pct", 1).alias("disponibilidade"),
            mean("km_por_litro_real", 2).alias("consumo_real"),
        )
        .orderBy(F.col("idade_veiculo").asc_nulls_last())
    )


def consumption_anomalies(fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Real against expected consumption by state and type: under 70 % of the expected value is
    anomalous, under 85 % suboptimal."""
    by_vehicle = fato.groupBy("sk_estado", "sk_veiculo").agg(
        *partials(means=["preco_combustivel", "km_por_litro_real"])
    )
    types = dim_veiculo.select(
        "sk_veiculo", "tipo_veiculo", F.col("consumo_medio_km_l").alias("consumo_esperado")
    )
    expected, real = F.col("consumo_esperado"), F.col("_consumo")
    status = (
        F.when(real < expected * _dec("0.70"), "ANOMALO")
        .when(real < expected * _dec("0.85"), "SUBOTIMO")
        .otherwise("NORMAL")
    )
    return (
        by_vehicle.join(types, "sk_veiculo")
        .groupBy("sk_estado", "tipo_veiculo", "consumo_esperado")
        .agg(
            merged_mean("preco_combustivel", 2).alias("preco_combustivel"),
            merged_exact("km_por_litro_real").alias("_consumo"),
        )
        .join(dim_estado, "sk_estado")
        .select(
            "sigla_estado", "regiao", "tipo_veiculo", "preco_combustivel",
            F.round("_consumo", 2).alias("consumo_real"), "consumo_esperado",
            percent(expected - real, expected, 1).alias("desvio_consumo_pct"),
            status.alias("status_consumo"),
        )
        .orderBy(F.col("desvio_consumo_pct").desc_nulls_first(), "sigla_estado", "tipo_veiculo")
    )
