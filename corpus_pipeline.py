"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists name and function of each stage; a function takes (spark, docs, sf_dir). Every stage
works on all its predecessor kept and returns the columns of ``documents``, the last one the packed
pieces. NULL ids, NULL or empty texts, repeated rows and further columns of any name are handled as the
operators' docstrings say; an empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetspark.llm import dart_minhash, decontaminate, line_dedup, packing, quality
from fleetspark.llm.common import small_batches, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one of them."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents the one with the smallest id stays."""
    return dart_minhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    small_batches(spark)
    return packing.packed_digests(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL has no tokenizer and no classifier
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each but the last written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
