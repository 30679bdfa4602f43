"""Large tables stay in the tasks that read them: feeds, operations without copies, the numbered fact, years."""

import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetspark.catalog import feeds, queries
from fleetspark.functions.columns import to_number
from fleetspark.functions.keys import stored_number
from fleetspark.operators import cleaning, standardize, star
from fleetspark.sources import readers, writers

from .conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("feed", [feeds.raw_prices, feeds.raw_indicators, feeds.raw_fleet, feeds.raw_operations])
def test_feeds_are_not_dealt_out_by_state(spark, sf, feed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        assert "hashpartitioning" not in plan(feed(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


OPERATIONS = [("V1", "1.0", 2023), ("V1", "1.00", 2023), ("V1", "1.0", 2023), (None, None, 2024), (None, None, 2024), ("V2", None, 2022)]


@pytest.mark.parametrize("few", [0, 2_000_000])
def test_rare_copies_are_those_of_the_whole_rows(spark, monkeypatch, few):
    monkeypatch.setattr(cleaning, "FEW_COPIES", few)
    df = spark.createDataFrame(OPERATIONS * 3, "v string, t string, ano int").repartition(5)
    assert rows(cleaning.drop_rare_copies(df, "ano")) == rows(df.dropDuplicates())
    single = spark.createDataFrame(OPERATIONS[1:3], "v string, t string, ano int")
    assert rows(cleaning.drop_rare_copies(single, "ano")) == rows(single)
    assert cleaning.drop_rare_copies(df.limit(0), "ano").count() == 0


def test_rows_that_share_a_hash_are_compared(spark, monkeypatch):
    monkeypatch.setattr(cleaning.F, "xxhash64", lambda *_: F.lit(1).cast("long"))
    df = spark.createDataFrame(OPERATIONS, "v string, t string, ano int")
    assert rows(cleaning.drop_rare_copies(df, "ano")) == rows(df.dropDuplicates())


def test_rows_without_copies_are_not_shuffled(spark):
    df = spark.range(5000).selectExpr("id AS a", "id AS ano").unionByName(spark.range(3).selectExpr("id AS a", "id AS ano"))
    shuffled = [line for line in plan(cleaning.drop_rare_copies(df, "ano")).splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1  # of the copies, below the second branch
    assert "LeftAnti" in plan(cleaning.drop_rare_copies(df, "ano"))


def test_the_fact_is_numbered_where_it_lies(spark, sf):
    numbered = star.add_fact_number(feeds.fato(spark, sf).repartition(7))
    text = plan(numbered)
    assert "row_number" not in text and "SortMergeJoin" not in text
    assert all(keys.startswith("_block") for keys in re.findall(r"hashpartitioning\(([^)]*)", text))
    got = numbered.agg(F.min("sk_fato_frota"), F.max("sk_fato_frota"), F.count_distinct("sk_fato_frota"), F.count("*")).first()
    n = feeds.fato(spark, sf).count()
    assert tuple(got) == (1, n, n, n)
    order = numbered.groupBy("sk_tempo").agg(F.min("sk_fato_frota").alias("a"), F.max("sk_fato_frota").alias("b")).orderBy("sk_tempo").collect()
    assert all(x.b + 1 == y.a for x, y in zip(order, order[1:]))
    assert rows(numbered) == rows(numbered)
    without = numbered.drop("sk_fato_frota")
    assert rows(without) == rows(feeds.fato(spark, sf))


def test_numbers_follow_missing_blocks_first(spark):
    df = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 3 END AS b", "id").repartition(6)
    got = stored_number(df, "n", "b", "x").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 901))
    assert [r.b for r in got] == [None] * 300 + [1] * 300 + [2] * 300


def test_years_are_written_without_a_shuffle_or_a_sort(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "CAST(2000 + id % 7 AS INT) AS ano")
    path = writers.write_staging({"frota_enriquecida": df}, str(tmp_path), "20250101")["frota_enriquecida"]
    files = [f for year in os.listdir(path) if year.startswith("ano=") for f in os.listdir(f"{path}/{year}") if f.endswith(".parquet")]
    assert len(files) == 28  # each of four tasks wrote its part of each year
    assert rows(spark.read.parquet(path)) == rows(df)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_numbers_in_plain_and_other_text(spark):
    texts = ["12", " 7\t", "1e3", "1.005", "nan", "inf", "abc", "", None, "١٢", "12000.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(to_number("t", "decimal(18,2)")).collect()]
    assert got == [Decimal(x) if x else None for x in ("12", "7", "1000", "1.01", None, None, None, None, None, None, "12000")]


def test_the_columns_of_operations_are_read_in_code_that_the_jvm_compiles(spark, sf, tmp_path):
    path = queries.write_raw_csv(feeds.raw_operations(spark, sf), str(tmp_path / "feed"))
    df = readers.read_feed(spark, "operations", "", path)
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns)).sortWithinPartitions("ano")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", hashed._jdf.queryExecution().explainString(mode))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(map(int, sizes)) < 8000


def test_enriched_rows_are_not_sorted_to_be_counted(spark, sf):
    steps = [line for line in plan(queries.QUERIES["enrich_pipeline"](spark, sf)).splitlines() if "Aggregate(" in line]
    assert "HashAggregate(" in steps[-1]


def test_mean_prices_are_as_wide_as_prices(spark):
    df = spark.createDataFrame([("A", 2024, 1, "GNV", Decimal("1.2350"))], "estado string, ano int, mes int, produto string, valor_venda decimal(18,4)")
    wide = standardize.prices_wide(standardize.monthly_prices(df))
    assert dict(wide.dtypes)["preco_gnv"] == "decimal(18,2)"
    assert wide.first().preco_gnv == Decimal("1.24")


@pytest.mark.parametrize("type_, texts, numbers", [
    ("decimal(18,2)", ["\x0112", "12\n", ":1", "/1", "+4", ".5", "-.5e1", "é1", "\x7f12", "Infinity"], ["12", "12", None, None, "4", "0.5", "-5", None, None, None]),
    ("int", ["\x7f12", "12\x7f", "", " ", "12000.0", "+4", "é1", "1e3", "abc"], ["12", "12", None, None, "12000", "4", None, "1000", None]),
])
def test_text_that_starts_oddly(spark, type_, texts, numbers):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(to_number("t", type_)).collect()] == [Decimal(n) if n else None for n in numbers]
