"""Session settings and the shared folder that jobs may write working tables to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# AQE picks broadcast joins from measured sizes, merges small shuffle partitions and
# splits skewed ones; the forced form also splits a hot join key when the aggregate
# above the join would otherwise have reused the join's partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # sums and casts that overflow fail; other sessions get wide sums and checked casts instead
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # a stack trace per column expression doubles the time to build a query
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "fleetspark", **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="fleetspark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one run's tables."""
    return os.path.join(_run_folder.get() or shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store the cluster uses."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[str]:
    """Working tables of the steps inside lie in one folder, which goes when they are through. What they
    return must be written, as nothing can be read from that folder afterwards."""
    folder = new_work_dir(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove(spark, folder)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and go on from the files: it is computed once, a
    lost executor repeats a read, and the planner knows its size."""
    path = new_work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
