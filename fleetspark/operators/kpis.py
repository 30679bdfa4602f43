"""The five descriptive KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import (
    RATIO_DIGITS, mean, merged_exact, merged_mean, merged_share, merged_sum, partials, ratio, total,
)
from .star import add_months
from .views import active_vehicles, by_month_and_type, per_km


def _labelled(rows: DataFrame, kpi: str) -> DataFrame:
    return rows.select(F.lit(kpi).alias("kpi"), "*")


def kpi_custo_por_km(
    fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame,
) -> DataFrame:
    """Cost per km and its components by type, state and month."""
    parts = {
        "componente_combustivel": per_km("custo_combustivel"),
        "componente_manutencao": per_km("custo_manutencao"),
        "componente_fixo": per_km(F.col("custo_seguro") + F.col("custo_depreciacao")),
    }
    rows = by_month_and_type(
        fato, dim_veiculo, ["sk_estado", "sk_tempo"], partials(means=["custo_por_km"], ratios=parts)
    ).agg(
        merged_mean("custo_por_km", 4).alias("valor"),
        *(merged_mean(name, 4, RATIO_DIGITS).alias(name) for name in parts),
    )
    return (
        rows.join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .transform(add_months, "ano", "mes")
        .select(
            F.lit("Custo por Km").alias("kpi"), "tipo_veiculo", "sigla_estado", "ano", "mes",
            "valor", "componente_combustivel", "componente_manutencao", "componente_fixo",
        )
    )


def kpi_consumo_medio(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Mean consumption, distance and volume by type and fuel."""
    by_vehicle = fato.groupBy("sk_veiculo").agg(
        *partials(means=["km_por_litro_real", "km_rodado", "litros_consumidos"])
    )
    types = dim_veiculo.select("sk_veiculo", "tipo_veiculo", "combustivel")
    rows = by_vehicle.join(types, "sk_veiculo").groupBy("tipo_veiculo", "combustivel").agg(
        merged_mean("km_por_litro_real", 2).alias("km_por_litro"),
        merged_mean("km_rodado", 0).alias("km_medio_mensal"),
        merged_mean("litros_consumidos", 1).alias("litros_medio_mensal"),
    )
    return _labelled(rows, "Consumo Medio")


def kpi_utilizacao(fato: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Active vehicles, availability, trips and revenue per vehicle by state and month."""
    keys = ["sk_estado", "sk_tempo"]
    rows = fato.groupBy(*keys).agg(
        mean("disponibilidade_pct", 1).alias("disponibilidade_media"),
        total("viagens_realizadas").alias("total_viagens"),
        mean("km_rodado", 0).alias("km_medio_por_veiculo"),
        total("receita_estimada").alias("receita"),
    )
    return (
        rows.join(active_vehicles(fato, keys, "veiculos_ativos"), keys)
        .withColumn("receita_por_veiculo", F.round(ratio("receita", "veiculos_ativos"), 2))
        .join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .transform(add_months, "ano", "mes")
        .select(
            F.lit("Utilizacao Frota").alias("kpi"), "sigla_estado", "ano", "mes", "veiculos_ativos",
            "disponibilidade_media", "total_viagens", "km_medio_por_veiculo", "receita_por_veiculo",
        )
    )


def kpi_composicao_custos(fato: DataFrame) -> DataFrame:
    """Cost components and their shares by year."""
    parts = ["combustivel", "manutencao", "seguro", "ipva", "depreciacao"]
    costs = [f"custo_{p}" for p in parts]
    by_month = fato.groupBy("sk_tempo").agg(*partials([*costs, "custo_total"]))
    rows = by_month.transform(add_months, "ano").groupBy("ano").agg(
        *(merged_sum(c).alias(f"total_{p}") for c, p in zip(costs, parts)),
        merged_sum("custo_total").alias("total_geral"),
        merged_share("custo_combustivel", "custo_total", 1).alias("pct_combustivel"),
        merged_share("custo_manutencao", "custo_total", 1).alias("pct_manutencao"),
    )
    return _labelled(rows, "Composicao Custos")


def kpi_rentabilidade(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Revenue, cost, profit and mean margin by type, best margin first."""
    by_vehicle = fato.groupBy("sk_veiculo").agg(
        *partials(["receita_estimada", "custo_total"], ["margem_operacional"])
    )
    rows = (
        by_vehicle.join(dim_veiculo.select("sk_veiculo", "tipo_veiculo"), "sk_veiculo")
        .groupBy("tipo_veiculo")
        .agg(
            merged_sum("receita_estimada").alias("receita_total"),
            merged_sum("custo_total").alias("custo_total"),
            (merged_sum("receita_estimada") - merged_sum("custo_total")).alias("lucro"),
            F.round(merged_exact("margem_operacional") * 100, 1).alias("margem_pct"),
        )
        .orderBy(F.col("margem_pct").desc_nulls_first(), "tipo_veiculo")
    )
    return _labelled(rows, "Rentabilidade")
