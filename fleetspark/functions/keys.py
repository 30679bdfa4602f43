"""Dense 1..n row numbers without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored


def dense_number(
    df: DataFrame, name: str, order: Sequence[str], block: Column | None = None, blocks: int = 1024,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``name`` = 1..n.

    Rows are numbered inside many blocks and each block is shifted by the rows before it.
    The block of a row follows from its data only, so a task that is run again gives the same
    numbers. ``block`` is a coarse number the numbers should follow (a month, a key range); within
    one value rows are spread over ``blocks`` hash blocks of their ``order`` columns (or of the
    ``spread`` columns, cheaper when few of them tell rows apart), so no block holds a hot value
    alone. Rows equal in all ``order`` columns must be equal. Only the table of block counts meets
    in one task.

    With ``blocks=1`` numbers follow ``block`` and then ``order`` exactly.
    """
    order_cols = [F.col(c) for c in order]
    hashed = [F.col(c) for c in (spread or order)]
    coarse = F.lit(0) if block is None else block
    part = F.pmod(F.xxhash64(*hashed), F.lit(blocks)).cast("int") if blocks > 1 else F.lit(0)
    # never NULL: no row is lost in the join below, which then needs no filter on these expressions
    placed = df.withColumns(
        {
            "_block": F.coalesce(coarse.cast("long"), F.lit(-1).cast("long")),
            "_part": F.coalesce(part, F.lit(0)),
        }
    )
    counts = placed.groupBy("_block", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_block", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_block", "_part").orderBy(*order_cols)
    return (
        placed.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, ["_block", "_part"])
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .drop("_block", "_part", "_pos", "_before")
    )


def stored_number(df: DataFrame, name: str, block: str, label: str) -> DataFrame:
    """Add ``name`` = 1..n, following ``block`` (whole numbers), without moving a row.

    The table is written, each file in order of ``block``, and a number is the place of the row in its file, shifted
    by the rows of its block in files before and of the blocks before. It follows from the written files, so a
    task that is run again gives the same numbers; another run over the same rows may number those of one block
    in another order. Only one row per block and file meets in one task, and is sent to all.
    """
    place = F.coalesce(F.col(block).cast("long"), F.lit(-1).cast("long"))
    rows = stored(df.sortWithinPartitions(place), label)
    placed = rows.withColumns({"_block": place, "_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    runs = placed.groupBy("_block", "_file").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"), F.max("_row").alias("_last"))
    before = Window.orderBy("_block", "_file").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")
    torn = F.raise_error(F.lit(f"rows of {label} are not in order of {block}")).cast("long")
    shifts = runs.select("_block", "_file", F.when(F.col("_last") - F.col("_first") + 1 == F.col("_n"), shift).otherwise(torn).alias("_shift"))
    return (
        placed.join(F.broadcast(shifts), ["_block", "_file"])
        .withColumn(name, F.col("_shift") + F.col("_row"))
        .drop("_block", "_file", "_row", "_shift")
    )
