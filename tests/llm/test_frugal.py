"""Memory of Python workers: small batches where a stage's result is written by the caller, memory given back."""

import pyarrow as pa
import pytest

import corpus_pipeline
from fleetspark.llm import common, packing, quality

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("rows, kept", [("10000", common.BATCH), ("0", common.BATCH), ("7", 7)])
def test_stages_that_the_caller_writes_take_small_batches(spark, sf, rows, kept):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spark.conf.set(KEY, rows)
    try:
        corpus_pipeline.pack(spark, docs, sf)
        assert int(spark.conf.get(KEY)) == kept
    finally:
        spark.conf.unset(KEY)


def test_a_worker_gives_memory_back_when_its_task_ends(monkeypatch):
    called = []

    class Pool:
        def release_unused(self):
            called.append(1)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    batches = [pa.record_batch({"x": [i]}) for i in range(3)]
    running = common.frugal(iter)(batches)
    assert next(running) is batches[0] and not called
    assert list(running) == batches[1:] and called == [1]


def test_the_classifier_needs_no_pandas():
    assert not hasattr(quality, "pd") and not hasattr(packing, "pd")
