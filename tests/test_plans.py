"""Physical plans: what reaches the scan, what is shuffled, and what must never appear."""

import re

import pytest

from fleetspark.catalog.queries import QUERIES
from fleetspark.operators import star

STAR = [
    "vw_kpi_estado", "vw_kpi_tipo_veiculo", "vw_veiculos_alto_custo", "vw_impacto_combustivel",
    "vw_eficiencia_idade", "vw_ranking_margem", "kpi_custo_por_km", "kpi_consumo_medio",
    "kpi_composicao_custos", "kpi_rentabilidade", "diag_impacto_preco", "diag_ineficiencia", "diag_causa_raiz",
    "diag_anomalia_consumo", "presc_decisions", "presc_alerts", "presc_resumo", "dash_cards", "pred_arima",
    "pred_trend_by_type", "pred_linreg_fit", "pred_linreg_metrics", "pred_linreg_forecast",
]


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", STAR)
def test_star_queries_stay_in_the_jvm_and_read_the_fact_once(spark, sf, name):
    text = plan(spark, sf, name)
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem", text)) == 1


@pytest.mark.parametrize("name", ["vw_resumo_mensal", "kpi_utilizacao"])
def test_monthly_distinct_vehicles_shuffle_pairs_only(spark, sf, name):
    """Sums and distinct vehicles are read apart; the second read is two columns wide."""
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan(spark, sf, name))
    assert len(scans) == 2
    assert {"l_suppkey", "l_shipdate"} in [{c.split("#")[0] for c in s.split(",")} for s in scans]


def test_scan_reads_only_needed_columns(spark, sf):
    scan = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan(spark, sf, "kpi_consumo_medio")).group(1)
    assert {c.split("#")[0] for c in scan.split(",")} == {"l_suppkey", "l_quantity", "l_tax"}


def test_price_feed_reads_every_row(spark, sf):
    scan = re.search(r"lineitem[^\n]*", plan(spark, sf, "std_price_monthly")).group(0)
    assert "LessThan" not in scan


@pytest.mark.parametrize("name", [
    "vw_veiculos_alto_custo", "vw_ranking_margem", "presc_vehicle_kpis", "vw_kpi_tipo_veiculo", "vw_impacto_combustivel",
    "kpi_custo_por_km", "diag_impacto_preco", "dash_g1", "pred_monthly_series", "pred_trend_by_type",
])
def test_fact_folds_before_vehicles_join(spark, sf, name):
    """The vehicle table is joined above the aggregate of the fact, never to its rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, sf, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact = text.index("lineitem")
    joins = [m.start() for m in re.finditer("SortMergeJoin", text)]
    folds = [m.start() for m in re.finditer("partial_sum", text)]
    assert joins and folds
    between = text[max(j for j in joins if j < fact):fact]
    assert "partial_sum" in between


@pytest.mark.parametrize("name", [*STAR, "src_star_wide", "fact_project_cast", "dash_g15", "derive_margem"])
def test_generated_methods_stay_small_enough_to_compile(spark, sf, name):
    """HotSpot leaves a method of more than 8,000 bytes to the interpreter."""
    plan_ = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan()
    stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan_)
    assert all(stages.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(stages.size()))


def test_the_fact_is_derived_once_before_it_is_numbered(spark, sf):
    """What is left to read is the written fact: its few spread columns for the counts, then the rows."""
    text = plan(spark, sf, "fact_surrogate_key")
    assert "lineitem" not in text
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert len(scans) == 2 and min(len(s.split(",")) for s in scans) <= 6


def test_series_of_both_forecasts_are_summed_once(spark, sf):
    assert "lineitem" not in plan(spark, sf, "pred_series_forecast")


def test_constraints_read_each_column_of_the_fact_once(spark, sf):
    """What is left is the key column, folded to words, and a second look at those that repeat a value. No table
    that is written has a row per fact key."""
    text = plan(spark, sf, "dq_constraints")
    assert "lineitem" not in re.sub(r"(?s)collect_set.*", "", text)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/fato-", text)
    assert len(scans) == 2 and all(s.split("#")[0] == "sk_fato_frota" and "," not in s for s in scans)
    words = text[text.index("bit_or"):]
    assert "partial_bit_or" in words and "LeftSemi" in text


@pytest.mark.parametrize("hashed", [True, False])
def test_vehicles_are_read_once(spark, sf, hashed):
    """Hashed keys need no shuffle; numbers are given to the written registry."""
    vehicles = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("concat('V', s_suppkey) AS veiculo_id", "s_name AS marca")
    text = star.dim_veiculo(vehicles, blocks=4, hashed=hashed)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*supplier", text)) == (1 if hashed else 0)
    assert ("Exchange" not in text and "Window" not in text) if hashed else len(re.findall("FileScan parquet", text)) == 2


def test_first_row_of_a_key_is_ranked_before_the_shuffle(spark, sf):
    text = plan(spark, sf, "clean_dedup_key")
    assert "WindowGroupLimit" in text and "SortAggregate" not in text
    assert "SortAggregate" not in plan(spark, sf, "ref_upsert")


def test_top_n_does_not_sort_everything(spark, sf):
    assert "TakeOrderedAndProject" in plan(spark, sf, "presc_top_n")
    assert "TakeOrderedAndProject" in plan(spark, sf, "dash_g8")
