"""Every table behind the dashboard, from a star and the newest result tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts, views
from ..sources import readers

# Result tables as they look before the first analytics run.
DECISIONS = (
    "veiculo_id string, tipo_veiculo string, marca string, estado string, custo_por_km decimal(12,4),"
    " margem_operacional decimal(12,4), idade_veiculo int, decisao string, prioridade int,"
    " recomendacao_idade string, num_alertas long"
)
ALERTS = (
    "veiculo_id string, tipo_veiculo string, marca string, estado string, kpi string,"
    " valor_atual decimal(18,4), limite decimal(12,4), classificacao string, acao_recomendada string"
)
REGRESSION = "serie string, ano int, mes int, custo_por_km_previsto double, modelo string"
TREND = (
    "tipo_veiculo string, tendencia string, `inclinação` double, custo_atual double,"
    " custo_projecao_6m double"
)


def dashboard(spark: SparkSession, star: dict[str, DataFrame], results: str) -> dict[str, DataFrame]:
    """Cards, sixteen charts and the priority table by name; nothing runs until one is read."""
    fato, estado, veiculo = star["fato_frota"], star["dim_estado"], star["dim_veiculo"]

    def result(folder: str, prefix: str, schema: str) -> DataFrame:
        return readers.read_results(spark, os.path.join(results, folder), prefix, schema)

    decided = result("prescriptive", "decisoes", DECISIONS)
    alert_rows = result("prescriptive", "alertas", ALERTS)
    regression = result("predictive", "forecast_regressao", REGRESSION)
    trends = result("predictive", "forecast_tendencia", TREND)
    high_cost = views.vw_veiculos_alto_custo(fato, veiculo, estado)
    return {
        "cards": marts.cards(fato),
        "decision_counts": marts.decision_counts(decided),
        "alto_custo_count": marts.high_cost_count(high_cost),
        "g1": marts.monthly_cost_by_type(fato, veiculo),
        "g2": marts.revenue_and_cost_by_year(fato),
        "g3": marts.cost_by_region(fato, estado),
        "g4": marts.cost_parts_by_type(fato, veiculo),
        "g5": marts.cost_by_type(fato, veiculo),
        "g6": marts.consumption_by_type(fato, veiculo),
        "g7": marts.states_by_cost(views.vw_kpi_estado(fato, estado)),
        "g8": marts.lowest_margins(views.vw_ranking_margem(fato, veiculo, estado)),
        "g9": marts.cost_by_age_band(fato),
        "g10": marts.maintenance_and_fuel_by_year(fato),
        "g11": marts.dearest_vehicles(high_cost),
        "g12": marts.availability_by_type(fato, veiculo),
        "g13": marts.decisions_by_type(decided),
        "g14": marts.alerts_by_kpi(alert_rows),
        "g15": marts.history_and_forecast(views.vw_resumo_mensal(fato), regression),
        "g16": marts.trend_by_type(trends),
        "tbl1": marts.priority_table(decided),
    }
