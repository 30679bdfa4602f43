"""Operations joined with the vehicle registry and the state-level tables, plus derived KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import decimal_mean, ratio_or_zero, year_of_period

# Columns that an enriched operation takes from its vehicle.
VEHICLE_COLUMNS = [
    "veiculo_id", "marca", "ano_fabricacao", "km_atual", "status", "consumo_medio_km_l",
    "capacidade_carga_t",
]


# --- derived KPIs -----------------------------------------------------------------

def total_cost() -> Column:
    return (
        F.col("custo_combustivel") + F.col("custo_manutencao") + F.col("custo_seguro")
        + F.col("custo_ipva") + F.col("custo_depreciacao")
    )


def cost_per_km() -> Column:
    return ratio_or_zero("custo_total", "km_rodado")


def operating_margin() -> Column:
    return ratio_or_zero(F.col("receita_estimada") - F.col("custo_total"), "receita_estimada")


def km_per_litre() -> Column:
    return ratio_or_zero("km_rodado", "litros_consumidos")


def vehicle_age() -> Column:
    return F.col("ano") - F.col("ano_fabricacao")


def derive_kpis(df: DataFrame) -> DataFrame:
    return df.withColumn("custo_total", total_cost()).withColumns(
        {
            "custo_por_km": cost_per_km(),
            "margem_operacional": operating_margin(),
            "km_por_litro_real": km_per_litre(),
            "idade_veiculo": vehicle_age(),
        }
    )


# --- joins ------------------------------------------------------------------------

def add_vehicle(operations: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Left join on the vehicle. The registry grows with the fleet, so its join is left to the
    planner: broadcast while it is below the threshold, else sort-merge with hot keys split."""
    present = [c for c in VEHICLE_COLUMNS if c in vehicles.columns]
    return operations.join(vehicles.select(*present), "veiculo_id", "left")


def add_prices(operations: DataFrame, prices: DataFrame) -> DataFrame:
    return operations.join(prices, ["estado", "ano", "mes"], "left")


def add_indicators(operations: DataFrame, indicators: DataFrame) -> DataFrame:
    """Left join on state and year; the national form has no state and is not joined.

    The year is the first four digits of the period. Periods finer than a year are averaged into
    it first, so an operation never finds two rows.
    """
    if "estado" not in indicators.columns:
        return operations
    period = "ano" if "ano" in indicators.columns else "periodo"
    values = [c for c in indicators.columns if c not in ("estado", "ano", "periodo")]
    yearly = indicators.groupBy("estado", year_of_period(period).alias("ano")).agg(
        *(decimal_mean(f"`{c}`").alias(c) for c in values)
    )
    return operations.join(yearly, ["estado", "ano"], "left")


def add_registered_fleet(operations: DataFrame, fleet: DataFrame) -> DataFrame:
    slim = fleet.select("estado", "ano", "frota_total", "frota_operacional")
    return operations.join(slim, ["estado", "ano"], "left")


def enrich(
    operations: DataFrame, vehicles: DataFrame, prices: DataFrame, indicators: DataFrame,
    fleet: DataFrame,
) -> DataFrame:
    """All four joins and the derived KPIs."""
    return (
        operations.transform(add_vehicle, vehicles)
        .transform(add_prices, prices)
        .transform(add_indicators, indicators)
        .transform(add_registered_fleet, fleet)
        .transform(derive_kpis)
    )
