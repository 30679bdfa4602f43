"""The whole job in three steps with tables between them: ETL, star load, analytics."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, enrich, forecast, prescriptive, reference_tables, standardize, star, views
from ..session import stored, working_tables
from ..sources import readers, writers


def run_etl(spark: SparkSession, raw: str, staging: str, date: str) -> dict[str, str]:
    """Newest raw feeds to the five staging tables. The small tables are written before the
    enrichment reads them, so that operations, the large feed, are joined and written where they are read."""
    def feed(name: str) -> DataFrame:
        return readers.read_feed(spark, name, raw)

    prices = cleaning.clean_prices(feed("prices"))
    indicators = cleaning.clean_indicators(feed("indicators"))
    fleet = cleaning.clean_registered_fleet(feed("registered_fleet"))
    vehicles = cleaning.clean_vehicles(feed("vehicles"), "_ordem")
    # a pivot looks for its columns first: from the written monthly tables, not from the feeds again
    with working_tables(spark):
        small = writers.write_staging(
            {
                "anp_mensal": standardize.prices_wide(stored(standardize.monthly_prices(prices), "precos")),
                "ibge_wide": standardize.indicators_wide(stored(indicators, "indicadores")),
                "denatran_resumo": standardize.fleet_summary(fleet),
                "veiculos_clean": vehicles,
            },
            staging, date,
        )
        read = {name: spark.read.parquet(path) for name, path in small.items()}
        enriched = enrich.enrich(
            cleaning.clean_operations(feed("operations"), rare_copies=True), read["veiculos_clean"],
            read["anp_mensal"], read["ibge_wide"], read["denatran_resumo"],
        )
        return small | writers.write_staging({"frota_enriquecida": enriched}, staging, date)


def run_load(
    spark: SparkSession, staging: str, warehouse: str, blocks: int = 1024, hashed_vehicles: bool = False,
) -> dict[str, DataFrame]:
    """Newest staging tables to a fresh star and its reference tables; the star is read back, with its
    views registered. Vehicles are numbered, or have hashed keys (``star.vehicle_key``); the load stops before
    the fact if two ids share one."""
    with working_tables(spark):
        tables = readers.read_staging(spark, staging)
        enriched, vehicles = tables["frota_enriquecida"], tables["veiculos_clean"]
        dims = {
            "dim_tempo": star.dim_tempo(enriched),
            "dim_estado": star.dim_estado(enriched),
            "dim_veiculo": star.dim_veiculo(vehicles, blocks=blocks, hashed=hashed_vehicles),
        }
        written = {
            name: spark.read.parquet(writers.write_dimension(df, warehouse, name))
            for name, df in (dims | reference_tables.reference_rows(spark)).items()
        }
        if hashed_vehicles and (shared := star.key_collisions(written["dim_veiculo"]).first()):
            raise ValueError(f"vehicles {shared.primeiro_id} and {shared.ultimo_id} have one key; number them instead")
        fact = star.fato_frota(
            enriched, written["dim_tempo"], written["dim_estado"], written["dim_veiculo"], blocks
        )
        writers.write_fact(fact, warehouse)
    loaded = writers.read_star(spark, warehouse)
    views.register_views(loaded)
    return loaded


def predictive(loaded: dict[str, DataFrame], periods: int = 6) -> dict[str, DataFrame]:
    """Regression, series forecast and trend by type over a star; a series that ARIMA does not fit has its
    forecast in the table of moving averages instead.

    The fact is read once, into monthly sums by type; every series comes from that small table.
    """
    base = stored(forecast.monthly_base(loaded["fato_frota"], ["tipo_veiculo"], loaded["dim_veiculo"]), "meses")
    total = forecast.roll_up(base)
    fit, arima = forecast.fit_regression(total), forecast.fit_arima(total)
    return {
        "forecast_regressao_custo_km": forecast.forecast_regression(fit, periods=periods),
        "forecast_arima_custo_km": forecast.forecast_arima(arima, periods=periods),
        "forecast_media_movel": forecast.fallback(total, arima, periods=periods),
        "forecast_tendencia_tipo": forecast.trend(forecast.roll_up(base, ["tipo_veiculo"])),
    }


def prescriptive_tables(loaded: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Alerts, decisions and summary over a star, from KPIs that are computed once."""
    kpis = stored(
        prescriptive.vehicle_kpis(loaded["fato_frota"], loaded["dim_veiculo"], loaded["dim_estado"]), "kpis")
    return {
        "alertas": prescriptive.alerts(kpis),
        "decisoes": prescriptive.in_priority_order(prescriptive.decisions(kpis)),
        "resumo": prescriptive.summary(kpis),
    }


def run_analytics(loaded: dict[str, DataFrame], results: str, date: str) -> dict[str, str]:
    """Forecasts, alerts, decisions and summary as dated result tables."""
    with working_tables(loaded["fato_frota"].sparkSession):
        rules = prescriptive_tables(loaded)
        paths = writers.write_results(predictive(loaded), os.path.join(results, "predictive"), date)
        folder = os.path.join(results, "prescriptive")
        paths |= writers.write_results({k: rules[k] for k in ("alertas", "decisoes")}, folder, date)
        paths["resumo"] = writers.write_summary(rules["resumo"], folder, date)
    return paths
