"""The seven analytic views over the star.

Each view aggregates the fact on its surrogate keys first, where copies of a hot key fold
together before the shuffle, and joins dimensions to the small result. Averages are carried as
exact sums and counts, so two-stage results equal one-stage ones.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from .. import reference_data as ref
from ..functions.columns import (
    RATIO_DIGITS, Measure, exact_mean, mean, merged_mean, merged_share, merged_sum, partials, per,
    total, upper_bound_band,
)
from .star import add_months

HIGH_COST_LIMIT = "1.50"


def per_km(cost: Column | str) -> Measure:
    """Row-level cost per km, NULL at zero km."""
    return per(cost, "km_rodado")


def active_vehicles(fato: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct vehicles per key.

    For keys with a month, where nearly every row is its own pair of key and vehicle: counted apart
    from the sums, so the pairs alone are shuffled and do not drag every partial sum along.
    """
    return fato.select(*keys, "sk_veiculo").distinct().groupBy(*keys).agg(F.count("sk_veiculo").alias(name))


def by_month_and_type(fato: DataFrame, dim_veiculo: DataFrame, keys: list[str], sums: list[Column]) -> GroupedData:
    """Groups of ``keys`` and vehicle type over partial sums per ``keys`` and vehicle.

    The fact folds before the vehicle table joins: copies of a hot vehicle's months meet map-side, and
    however large the vehicle table is, no fact row is moved for it.
    """
    folded = fato.groupBy(*keys, "sk_veiculo").agg(*sums)
    types = dim_veiculo.select("sk_veiculo", "tipo_veiculo")
    return folded.join(types, "sk_veiculo").groupBy(*keys, "tipo_veiculo")


def _profit() -> Column:
    return (total("receita_estimada") - total("custo_total")).alias("lucro_operacional")


def vw_resumo_mensal(fato: DataFrame) -> DataFrame:
    """Fleet totals and averages by month."""
    vehicles = active_vehicles(fato, ["sk_tempo"], "total_veiculos")
    by_month = fato.groupBy("sk_tempo").agg(
        total("km_rodado").alias("total_km_rodado"),
        total("custo_combustivel").alias("total_custo_combustivel"),
        total("custo_manutencao").alias("total_custo_manutencao"),
        total("custo_total").alias("total_custo"),
        total("receita_estimada").alias("total_receita"),
        total("viagens_realizadas").alias("total_viagens"),
        mean("custo_por_km", 4).alias("custo_medio_por_km"),
        mean("margem_operacional", 4).alias("margem_media"),
        mean("disponibilidade_pct", 1).alias("disponibilidade_media"),
        mean("km_por_litro_real", 2).alias("consumo_medio_real"),
        _profit(),
    )
    rows = vehicles.join(by_month, "sk_tempo").transform(add_months, "ano", "mes", "nome_mes")
    return rows.select("ano", "mes", "nome_mes", *[c for c in rows.columns if c not in ("sk_tempo", "ano", "mes", "nome_mes")])


def vw_kpi_estado(fato: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Totals and averages by state."""
    by_state = fato.groupBy("sk_estado").agg(
        F.count_distinct("sk_veiculo").alias("total_veiculos"),
        total("km_rodado").alias("total_km_rodado"),
        total("custo_total").alias("total_custo"),
        total("receita_estimada").alias("total_receita"),
        mean("custo_por_km", 4).alias("custo_medio_por_km"),
        mean("margem_operacional", 4).alias("margem_media"),
        mean("disponibilidade_pct", 1).alias("disponibilidade_media"),
        mean("km_por_litro_real", 2).alias("consumo_medio_km_l"),
        _profit(),
    )
    return dim_estado.join(by_state, "sk_estado").drop("sk_estado")


def vw_kpi_tipo_veiculo(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """By vehicle type and fuel. One row per vehicle after the first stage, so the number of
    vehicles is a plain count; per-km costs are means of row ratios."""
    by_vehicle = fato.groupBy("sk_veiculo").agg(
        *partials(
            ["km_rodado", "custo_total", "receita_estimada"],
            ["custo_por_km", "margem_operacional", "km_por_litro_real", "disponibilidade_pct"],
            {"comb_km": per_km("custo_combustivel"), "man_km": per_km("custo_manutencao")},
        )
    )
    types = dim_veiculo.select("sk_veiculo", "tipo_veiculo", "combustivel")
    return by_vehicle.join(types, "sk_veiculo").groupBy("tipo_veiculo", "combustivel").agg(
        F.count("sk_veiculo").alias("total_veiculos"),
        merged_sum("km_rodado").alias("total_km_rodado"),
        merged_sum("custo_total").alias("total_custo"),
        merged_sum("receita_estimada").alias("total_receita"),
        merged_mean("custo_por_km", 4).alias("custo_medio_por_km"),
        merged_mean("comb_km", 4, RATIO_DIGITS).alias("custo_combustivel_por_km"),
        merged_mean("man_km", 4, RATIO_DIGITS).alias("custo_manutencao_por_km"),
        merged_mean("margem_operacional", 4).alias("margem_media"),
        merged_mean("km_por_litro_real", 2).alias("consumo_medio_real"),
        merged_mean("disponibilidade_pct", 1).alias("disponibilidade_media"),
    )


def vw_veiculos_alto_custo(fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Vehicle, state and age rows whose mean cost per km is above 1.50, dearest first."""
    rows = (
        fato.groupBy("sk_veiculo", "sk_estado", "idade_veiculo")
        .agg(
            exact_mean("custo_por_km").alias("_custo"),
            mean("margem_operacional", 4).alias("margem_media"),
            mean("disponibilidade_pct", 1).alias("disponibilidade_media"),
            total("custo_total").alias("custo_total_periodo"),
            total("km_rodado").alias("km_total_periodo"),
        )
        .filter(F.col("_custo") > F.lit(HIGH_COST_LIMIT).cast("decimal(6,2)"))
    )
    vehicle = dim_veiculo.select(
        "sk_veiculo", "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "status"
    )
    return (
        rows.join(vehicle, "sk_veiculo")
        .join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .orderBy(F.col("_custo").desc(), "id_veiculo", "sigla_estado", "idade_veiculo")
        .select(
            "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "status", "sigla_estado",
            F.round("_custo", 4).alias("custo_medio_por_km"), "margem_media",
            "disponibilidade_media", "custo_total_periodo", "km_total_periodo", "idade_veiculo",
        )
    )


def vw_impacto_combustivel(
    fato: DataFrame, dim_estado: DataFrame, dim_veiculo: DataFrame,
) -> DataFrame:
    """Fuel price, volume and share of cost by month, state and type (a ratio of sums)."""
    rows = by_month_and_type(
        fato, dim_veiculo, ["sk_tempo", "sk_estado"],
        partials(["litros_consumidos", "custo_combustivel", "custo_total"], ["preco_combustivel"]),
    ).agg(
        merged_mean("preco_combustivel", 2).alias("preco_medio_combustivel"),
        merged_sum("litros_consumidos").alias("total_litros"),
        merged_sum("custo_combustivel").alias("total_custo_combustivel"),
        merged_sum("custo_total").alias("total_custo"),
        merged_share("custo_combustivel", "custo_total", 2).alias("pct_combustivel_no_custo"),
    )
    return (
        rows.transform(add_months, "ano", "mes")
        .join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .select(
            "ano", "mes", "sigla_estado", "tipo_veiculo", "preco_medio_combustivel", "total_litros",
            "total_custo_combustivel", "total_custo", "pct_combustivel_no_custo",
        )
    )


def vw_eficiencia_idade(fato: DataFrame) -> DataFrame:
    """By age band, dearest first. A missing age counts as the oldest band."""
    band = upper_bound_band("idade_veiculo", ref.AGE_BANDS, ref.AGE_BAND_ABOVE)
    return (
        fato.groupBy(band.alias("faixa_idade"))
        .agg(
            F.count_distinct("sk_veiculo").alias("total_veiculos"),
            mean("custo_por_km", 4).alias("custo_medio_por_km"),
            mean("custo_manutencao", 2).alias("custo_medio_manutencao"),
            mean("disponibilidade_pct", 1).alias("disponibilidade_media"),
            mean("km_por_litro_real", 2).alias("consumo_medio_real"),
        )
        .orderBy(F.col("custo_medio_por_km").desc_nulls_first(), "faixa_idade")
    )


def vw_ranking_margem(fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Vehicle and state rows from the lowest mean margin up."""
    rows = fato.groupBy("sk_veiculo", "sk_estado").agg(
        mean("margem_operacional", 4).alias("margem_media"),
        mean("custo_por_km", 4).alias("custo_por_km"),
        total("receita_estimada").alias("receita_total"),
        total("custo_total").alias("custo_total"),
    )
    return (
        rows.join(dim_veiculo.select("sk_veiculo", "id_veiculo", "tipo_veiculo", "marca"), "sk_veiculo")
        .join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .select(
            "id_veiculo", "tipo_veiculo", "marca", "sigla_estado", "margem_media", "custo_por_km",
            "receita_total", "custo_total",
        )
        .orderBy(F.col("margem_media").asc_nulls_last(), "id_veiculo", "sigla_estado")
    )


def register_views(star: Mapping[str, DataFrame]) -> list[str]:
    """Create the seven temp views over a star."""
    fato, estado, veiculo = star["fato_frota"], star["dim_estado"], star["dim_veiculo"]
    views = {
        "vw_resumo_mensal": vw_resumo_mensal(fato),
        "vw_kpi_estado": vw_kpi_estado(fato, estado),
        "vw_kpi_tipo_veiculo": vw_kpi_tipo_veiculo(fato, veiculo),
        "vw_veiculos_alto_custo": vw_veiculos_alto_custo(fato, veiculo, estado),
        "vw_impacto_combustivel": vw_impacto_combustivel(fato, estado, veiculo),
        "vw_eficiencia_idade": vw_eficiencia_idade(fato),
        "vw_ranking_margem": vw_ranking_margem(fato, veiculo, estado),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
