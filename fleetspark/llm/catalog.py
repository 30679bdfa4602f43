"""One registered query per operator, over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from fleetspark.llm import (
    byte_bpe, dart_minhash, decontaminate, divergence, language_mix, lattice_lm, line_dedup, packing, quality, sharding, syncmers,
    templates, vector_codes,
)


def read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def on_documents(operator):
    return lambda spark, sf_dir: operator(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_closed_syncmers": on_documents(syncmers.fingerprint_documents),
    "op2_virtual_slots": on_documents(sharding.shard_documents),
    "op3_additive_quality": lambda spark, sf_dir: quality.score_documents(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    "op4_minimum_slack": on_documents(packing.packed_digests),
    "op5_template_classes": lambda spark, sf_dir: templates.extract_pages(read(spark, sf_dir, "pages")),
    "op6_lattice_score": on_documents(lattice_lm.score_documents),
    "op7_dart_minhash": on_documents(dart_minhash.classes),
    "op8_language_mixture": on_documents(language_mix.identify_documents),
    "op9_simhash_windows": lambda spark, sf_dir: decontaminate.leaked_pairs(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
    "op10_line_dedup": on_documents(line_dedup.line_digests),
    "op11_overlapping_bpe": on_documents(byte_bpe.round_trips),
    "op12_sequency_codes": lambda spark, sf_dir: vector_codes.compress(read(spark, sf_dir, "embeddings")),
    "op13_count_cells": on_documents(divergence.audit),
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op10_line_dedup": line_dedup.ORACLE, "op12_sequency_codes": vector_codes.ORACLE, "op13_count_cells": divergence.ORACLE,
}
