"""Threshold alerts, age advice and prioritised decisions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import reference_data as ref
from ..functions.columns import lookup, mean, range_band, total

KPIS = list(ref.LIMITS)
Limits = Mapping[str, tuple[float, float, str]]


def vehicle_kpis(fato: DataFrame, dim_veiculo: DataFrame, dim_estado: DataFrame) -> DataFrame:
    """The four KPIs and two totals by vehicle, state and age; dimensions join the aggregate."""
    rows = fato.groupBy("sk_veiculo", "sk_estado", "idade_veiculo").agg(
        mean("custo_por_km", 4).alias("custo_por_km"),
        mean("margem_operacional", 4).alias("margem_operacional"),
        mean("disponibilidade_pct", 1).alias("disponibilidade_pct"),
        mean("km_por_litro_real", 2).alias("km_por_litro_real"),
        total("custo_total").alias("custo_total"),
        total("receita_estimada").alias("receita_total"),
    )
    vehicle = dim_veiculo.select(
        "sk_veiculo", "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "status", "combustivel"
    )
    return (
        rows.join(vehicle, "sk_veiculo")
        .join(dim_estado.select("sk_estado", "sigla_estado"), "sk_estado")
        .select(
            "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "status", "combustivel",
            "sigla_estado", *KPIS, "idade_veiculo", "custo_total", "receita_total",
        )
    )


def _number(value: float) -> Column:
    return F.lit(str(value)).cast("decimal(12,4)")


def kpi_class(kpi: str, value: Column, limits: Limits = ref.LIMITS) -> Column:
    """CRITICO, ATENCAO or NORMAL by strict comparison; a missing value is NORMAL and a KPI
    without limits INDEFINIDO."""
    if kpi not in limits:
        return F.lit("INDEFINIDO")
    critical, attention, worse = limits[kpi]
    breaks = (lambda x: value > _number(x)) if worse == "higher" else (lambda x: value < _number(x))
    return F.when(breaks(critical), "CRITICO").when(breaks(attention), "ATENCAO").otherwise("NORMAL")


def breached_limit(kpi: str, class_: Column, limits: Limits = ref.LIMITS) -> Column:
    """The limit that the class stands for; NULL for NORMAL and INDEFINIDO."""
    if kpi not in limits:
        return F.lit(None).cast("decimal(12,4)")
    critical, attention, _ = limits[kpi]
    return F.when(class_ == "CRITICO", _number(critical)).when(class_ == "ATENCAO", _number(attention))


def classify(kpis: DataFrame, limits: Limits = ref.LIMITS, names: list[str] | None = None) -> DataFrame:
    """Long form: one row per input row and KPI with its class and the limit breached."""
    entries = []
    for kpi in names or KPIS:
        value = F.col(kpi).cast("decimal(18,4)")
        class_ = kpi_class(kpi, value, limits)
        entries.append(
            F.struct(
                F.lit(kpi).alias("kpi"), value.alias("valor_atual"),
                breached_limit(kpi, class_, limits).alias("limite"), class_.alias("classificacao"),
            )
        )
    return kpis.withColumn("_k", F.explode(F.array(*entries))).select("*", "_k.*").drop("_k")


def recommended_action(kpi: Column | str = "kpi", class_: Column | str = "classificacao") -> Column:
    return lookup(F.concat_ws("_", kpi, class_), ref.ACTIONS, ref.DEFAULT_ACTION)


def age_advice(age: Column | str = "idade_veiculo") -> Column:
    return range_band(age, ref.AGE_ADVICE, ref.DEFAULT_ADVICE)


def alerts(kpis: DataFrame, limits: Limits = ref.LIMITS) -> DataFrame:
    """One row per input row and KPI out of its normal range, with the action to take."""
    return classify(kpis, limits).filter(F.col("classificacao") != "NORMAL").select(
        F.col("id_veiculo").alias("veiculo_id"), "tipo_veiculo", "marca",
        F.col("sigla_estado").alias("estado"), "kpi", "valor_atual", "limite", "classificacao",
        recommended_action().alias("acao_recomendada"),
    )


def _count_class(wanted: str | None, limits: Limits) -> Column:
    """How many of a row's KPIs have a class (any class but NORMAL for ``None``)."""
    flags = []
    for kpi in KPIS:
        class_ = kpi_class(kpi, F.col(kpi).cast("decimal(18,4)"), limits)
        hit = class_ != "NORMAL" if wanted is None else class_ == wanted
        flags.append(F.when(hit, 1).otherwise(0))
    return reduce(Column.__add__, flags)


def decisions(kpis: DataFrame, limits: Limits = ref.LIMITS) -> DataFrame:
    """One decision per input row from all alerts of its vehicle.

    Alerts are counted in the row and added up over the rows of the vehicle (states x ages, a
    bounded group), so the alert table is neither built nor joined. Use ``in_priority_order`` to
    list the result.
    """
    same_vehicle = Window.partitionBy("id_veiculo")
    counted = kpis.withColumns(
        {
            "_criticos": F.sum(_count_class("CRITICO", limits)).over(same_vehicle),
            "_atencao": F.sum(_count_class("ATENCAO", limits)).over(same_vehicle),
            "num_alertas": F.sum(_count_class(None, limits)).over(same_vehicle),
        }
    )
    priority = F.when(F.col("_criticos") > 0, 1).when(F.col("_atencao") > 0, 2).otherwise(3)
    names = F.array(*(F.lit(d) for d in ref.DECISIONS))
    return counted.withColumn("prioridade", priority).select(
        F.col("id_veiculo").alias("veiculo_id"), "tipo_veiculo", "marca",
        F.col("sigla_estado").alias("estado"), "custo_por_km", "margem_operacional", "idade_veiculo",
        F.element_at(names, F.col("prioridade")).alias("decisao"), "prioridade",
        age_advice().alias("recomendacao_idade"), "num_alertas",
    )


DECISION_ORDER = ["prioridade", "veiculo_id", "estado", "idade_veiculo"]


def in_priority_order(decided: DataFrame) -> DataFrame:
    return decided.orderBy(*DECISION_ORDER)


def summary(kpis: DataFrame, limits: Limits = ref.LIMITS) -> DataFrame:
    """One row: analysed rows, vehicles, rows per decision and alerts by severity.

    Rows are folded by vehicle first (all rows of a vehicle share its decision), then once more
    into the totals; alerts are counted in place.
    """
    by_vehicle = kpis.groupBy("id_veiculo").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum(_count_class("CRITICO", limits)).alias("criticos"),
        F.sum(_count_class("ATENCAO", limits)).alias("atencao"),
        F.sum(_count_class(None, limits)).alias("alertas"),
    )
    critical, attention = F.col("criticos") > 0, F.col("atencao") > 0

    def rows_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("linhas"))), F.lit(0))

    def all_of(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return by_vehicle.agg(
        all_of("linhas").alias("total_linhas"),
        F.count(F.lit(1)).alias("total_veiculos"),
        rows_where(critical).alias("intervencao_imediata"),
        rows_where(~critical & attention).alias("monitorar_planejar"),
        rows_where(~critical & ~attention).alias("operacao_normal"),
        all_of("alertas").alias("total_alertas"),
        all_of("criticos").alias("alertas_criticos"),
        all_of("atencao").alias("alertas_atencao"),
    )


def top_decisions(decided: DataFrame, n: int = 10) -> DataFrame:
    return decided.orderBy(*DECISION_ORDER).limit(n)


def top_critical_alerts(alert_rows: DataFrame, n: int = 10) -> DataFrame:
    return (
        alert_rows.filter(F.col("classificacao") == "CRITICO")
        .orderBy("veiculo_id", "estado", "kpi", "valor_atual")
        .limit(n)
    )
