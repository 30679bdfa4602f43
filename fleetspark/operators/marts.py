"""Aggregates behind the dashboard. Each aggregates the fact by key before dimensions join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import merged_exact, merged_mean, merged_sum, partials
from . import views
from .prescriptive import DECISION_ORDER
from .star import add_months
from .views import by_month_and_type

MEAN_DIGITS = 6


def _merged(c: str, digits: int = MEAN_DIGITS) -> Column:
    return merged_mean(c, digits)


def cards(fato: DataFrame) -> DataFrame:
    """The eleven headline figures, folded by vehicle first."""
    by_vehicle = fato.groupBy("sk_veiculo").agg(
        *partials(
            ["km_rodado", "viagens_realizadas", "receita_estimada", "custo_total", "custo_manutencao"],
            ["custo_por_km", "margem_operacional", "disponibilidade_pct", "km_por_litro_real"],
        )
    )
    margin = merged_exact("margem_operacional")
    return by_vehicle.agg(
        _merged("custo_por_km", 2).alias("custo_km"),
        F.round(margin * 100, 1).alias("margem"),
        _merged("disponibilidade_pct", 1).alias("disp"),
        F.count("sk_veiculo").alias("veiculos"),
        _merged("km_por_litro_real", 2).alias("consumo"),
        merged_sum("km_rodado").alias("km"),
        merged_sum("viagens_realizadas").alias("viagens"),
        F.round(merged_sum("receita_estimada"), 0).alias("receita"),
        F.round(merged_sum("custo_total"), 0).alias("custo_total"),
        F.round(merged_sum("receita_estimada") - merged_sum("custo_total"), 0).alias("lucro"),
        F.round(merged_sum("custo_manutencao"), 0).alias("manutencao"),
    )


def decision_counts(decided: DataFrame) -> DataFrame:
    def count_of(priority: int) -> Column:
        return F.count_if(F.col("prioridade") == priority)

    return decided.agg(
        count_of(1).alias("intervencao_imediata"),
        count_of(2).alias("monitorar_planejar"),
        count_of(3).alias("operacao_normal"),
    )


def high_cost_count(high_cost: DataFrame) -> DataFrame:
    return high_cost.agg(F.count(F.lit(1)).alias("veiculos_criticos"))


def monthly_cost_by_type(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Mean cost per km by month and type."""
    rows = by_month_and_type(fato, dim_veiculo, ["sk_tempo"], partials(means=["custo_por_km"])).agg(
        _merged("custo_por_km").alias("custo_km")
    )
    return rows.transform(add_months, "ano", "mes", "nome_mes").select(
        "ano", "mes", "nome_mes", "tipo_veiculo", "custo_km"
    )


def _yearly(fato: DataFrame, sums: dict[str, str]) -> DataFrame:
    by_month = fato.groupBy("sk_tempo").agg(*partials(sums))
    return by_month.transform(add_months, "ano").groupBy("ano").agg(
        *(merged_sum(c).alias(name) for c, name in sums.items())
    )


def revenue_and_cost_by_year(fato: DataFrame) -> DataFrame:
    return _yearly(fato, {"receita_estimada": "receita", "custo_total": "custo"})


def maintenance_and_fuel_by_year(fato: DataFrame) -> DataFrame:
    return _yearly(
        fato, {"custo_manutencao": "manutencao", "custo_combustivel": "combustivel"}
    )


def cost_by_region(fato: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """Mean cost per km by region, cheapest first."""
    by_state = fato.groupBy("sk_estado").agg(*partials(means=["custo_por_km"]))
    return (
        by_state.join(dim_estado.select("sk_estado", "regiao"), "sk_estado")
        .groupBy("regiao")
        .agg(_merged("custo_por_km").alias("custo_km"))
        .orderBy(F.col("custo_km").asc_nulls_last(), "regiao")
    )


def _by_type(fato: DataFrame, dim_veiculo: DataFrame, sums=(), means=()) -> DataFrame:
    by_vehicle = fato.groupBy("sk_veiculo").agg(*partials(sums, means))
    types = dim_veiculo.select("sk_veiculo", "tipo_veiculo", "consumo_medio_km_l")
    return by_vehicle.join(types, "sk_veiculo")


def cost_parts_by_type(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    parts = ["combustivel", "manutencao", "seguro", "depreciacao"]
    rows = _by_type(fato, dim_veiculo, sums=[f"custo_{p}" for p in parts])
    return rows.groupBy("tipo_veiculo").agg(*(merged_sum(f"custo_{p}").alias(p) for p in parts))


def cost_by_type(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Mean cost per km by type, cheapest first."""
    rows = _by_type(fato, dim_veiculo, means=["custo_por_km"])
    return (
        rows.groupBy("tipo_veiculo")
        .agg(_merged("custo_por_km").alias("custo_km"))
        .orderBy(F.col("custo_km").asc_nulls_last(), "tipo_veiculo")
    )


def consumption_by_type(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Real and expected consumption by type; the expected value counts once per fact row."""
    by_vehicle = fato.groupBy("sk_veiculo").agg(
        F.count(F.lit(1)).alias("linhas"), *partials(means=["km_por_litro_real"])
    )
    types = dim_veiculo.select("sk_veiculo", "tipo_veiculo", "consumo_medio_km_l")
    expected, rows = F.col("consumo_medio_km_l"), F.col("linhas").cast("decimal(18,0)")
    weight = F.sum(F.when(expected.isNotNull(), rows))
    return by_vehicle.join(types, "sk_veiculo").groupBy("tipo_veiculo").agg(
        _merged("km_por_litro_real").alias("real"),
        F.round(F.sum(expected * rows) / F.nullif(weight, F.lit(0)), MEAN_DIGITS).alias("esperado"),
    )


def states_by_cost(kpi_estado: DataFrame) -> DataFrame:
    return kpi_estado.orderBy(F.col("custo_medio_por_km").asc_nulls_last(), "sigla_estado")


def _vehicle_label() -> Column:
    return F.concat(F.col("id_veiculo").cast("string"), F.lit(" - "), F.col("tipo_veiculo"))


def lowest_margins(ranking: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` lowest margins (the head of the ranking view), with the margin in percent and a label."""
    return ranking.limit(n).withColumns(
        {"margem_pct": F.round(F.col("margem_media") * 100, 1), "label": _vehicle_label()}
    )


def cost_by_age_band(fato: DataFrame) -> DataFrame:
    return views.vw_eficiencia_idade(fato)


def dearest_vehicles(high_cost: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` dearest vehicle rows (the head of the high-cost view) with a label."""
    return high_cost.limit(n).withColumn("label", _vehicle_label())


def availability_by_type(fato: DataFrame, dim_veiculo: DataFrame) -> DataFrame:
    """Mean availability by type and its band (below 75, below 85, fine)."""
    rows = _by_type(fato, dim_veiculo, means=["disponibilidade_pct"])
    disp = merged_exact("disponibilidade_pct")
    band = F.when(disp < 75, "CRITICO").when(disp < 85, "ATENCAO").otherwise("NORMAL")
    return rows.groupBy("tipo_veiculo").agg(
        F.round(disp, MEAN_DIGITS).alias("disp"), band.alias("faixa")
    )


def decisions_by_type(decided: DataFrame) -> DataFrame:
    return decided.groupBy("tipo_veiculo", "decisao").agg(F.count(F.lit(1)).alias("qtd"))


def alerts_by_kpi(alert_rows: DataFrame) -> DataFrame:
    return alert_rows.groupBy("kpi").agg(F.count(F.lit(1)).alias("qtd"))


def history_and_forecast(resumo_mensal: DataFrame, forecast: DataFrame) -> DataFrame:
    """Monthly mean cost per km followed by its forecast, with axis labels."""
    past = resumo_mensal.select(
        F.lit("Historico").alias("serie"), "ano", "mes",
        F.concat_ws("/", "nome_mes", F.col("ano").cast("string")).alias("label"),
        F.col("custo_medio_por_km").cast("double").alias("custo_km"),
    )
    future = forecast.select(
        F.lit("Previsao").alias("serie"), "ano", "mes",
        F.concat_ws("/", F.col("mes").cast("string"), F.col("ano").cast("string")).alias("label"),
        F.col("custo_por_km_previsto").alias("custo_km"),
    )
    return past.unionByName(future).orderBy("ano", "mes", "serie")


def trend_by_type(trends: DataFrame) -> DataFrame:
    return trends.select("tipo_veiculo", "tendencia", "custo_atual", "custo_projecao_6m")


def priority_table(decided: DataFrame, n: int = 30) -> DataFrame:
    return decided.orderBy(*DECISION_ORDER).limit(n)
