"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetspark.session import new_work_dir

#: ASCII white space, the characters 0x09 to 0x0D and 0x20
WHITE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: stands for a NULL document id wherever ids are compared
NO_ID = -(2**63)


def ship(module: str) -> None:
    """Functions of ``module`` travel to the workers with their code, so executors need no copy of
    this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


#: rows that Python workers take at once while a working table is written: texts and shingles are long, and both sides
#: hold a batch in memory
BATCH = 1024


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers of the session take at most ``BATCH`` rows at once: for results that the caller
    writes, and not ``stored``."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    spark.conf.set(key, str(min(BATCH, before) if before > 0 else BATCH))


def frugal(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``; at the end of a task its worker, which lives on, returns free memory to the system."""

    def running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # only the GNU library has it
                pass

    return running


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and go on from the files: it is computed once,
    a lost executor repeats a read, and the planner knows its size."""
    path = new_work_dir(df.sparkSession, label)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(min(BATCH, int(before)) if int(before) > 0 else BATCH))
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_key(name: str = "doc_id") -> Column:
    """A document id that is never NULL; rows without an id share the smallest number."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; ``lower`` does just that to pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def digest(*cols: Column) -> list[Column]:
    """128 bits in two columns: 64 would collide over the lines of a large corpus."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)]


def in_class(name: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a NULL id."""
    crc = F.crc32(F.col(name).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


ship(__name__)
