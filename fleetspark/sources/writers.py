"""Writers of staging, star and result tables.

A table is written once as Parquet; later steps read it back, so they know its size and a lost
executor repeats a scan instead of the steps before it.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import remove

STAR_ORDER = ["dim_tempo", "dim_estado", "dim_veiculo", "fato_frota"]


# A task keeps the files of so many years open at once; beyond that it sorts its rows by year first.
OPEN_YEARS = 64


def _write_by_year(df: DataFrame, path: str, column: str) -> None:
    """Rows go into the files of their years as they come: no row leaves its task, and none is sorted."""
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(max(OPEN_YEARS, int(before))))
    try:
        # the histograms of sizes are for readers other than Spark, and counted value by value
        writer = df.write.options(**{"compression": "zstd", "parquet.size.statistics.enabled": "false"})
        writer.mode("overwrite").partitionBy(column).parquet(path)
    finally:
        conf.set(key, before)


def write_staging(tables: Mapping[str, DataFrame], folder: str, date: str) -> dict[str, str]:
    """Write ``<name>_<date>`` per table; the enriched operations are partitioned by year. Each task writes a file
    a year: to bring the years together would move the whole table."""
    paths = {}
    for name, df in tables.items():
        path = os.path.join(folder, f"{name}_{date}")
        if name == "frota_enriquecida":
            _write_by_year(df, path, "ano")
        else:
            df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def write_fact(fact: DataFrame, folder: str) -> str:
    """Replace the fact, partitioned by year so queries for some years read only those."""
    path = os.path.join(folder, "fato_frota")
    by_year = fact.withColumn("ano_particao", F.floor(F.col("sk_tempo") / 100).cast("int"))
    _write_by_year(by_year, path, "ano_particao")
    return path


def write_dimension(df: DataFrame, folder: str, name: str) -> str:
    path = os.path.join(folder, name)
    df.write.mode("overwrite").parquet(path)
    return path


def write_star(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Replace the star, dimensions before the fact."""
    paths = {n: write_dimension(tables[n], folder, n) for n in STAR_ORDER if n != "fato_frota"}
    paths["fato_frota"] = write_fact(tables["fato_frota"], folder)
    return paths


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four tables. The fact carries ``ano_particao``; filter on it to read some years only."""
    return {name: spark.read.parquet(os.path.join(folder, name)) for name in STAR_ORDER}


def write_results(
    tables: Mapping[str, DataFrame], folder: str, date: str, csv: bool = False,
) -> dict[str, str]:
    """Write ``<name>_<date>`` per non-empty result table, as Parquet or header CSV. A table is computed and
    written once; what turns out to be empty is removed again."""
    paths = {}
    for name, df in tables.items():
        path = os.path.join(folder, f"{name}_{date}")
        spark, writer = df.sparkSession, df.write.mode("overwrite")
        if csv:
            writer.option("header", True).csv(path)
            written = spark.read.schema(df.schema).option("header", True).csv(path)
        else:
            writer.parquet(path)
            written = spark.read.schema(df.schema).parquet(path)
        if written.isEmpty():
            remove(spark, path)
        else:
            paths[name] = path
    return paths


def write_summary(summary: DataFrame, folder: str, date: str) -> str:
    """The executive summary as a dated one-line text file."""
    path = os.path.join(folder, f"resumo_executivo_{date}")
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in summary.columns]
    summary.select(F.concat_ws("; ", F.lit(f"data={date}"), *parts)).write.mode("overwrite").text(path)
    return path
