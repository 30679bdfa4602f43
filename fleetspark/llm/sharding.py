"""Sharding through fixed virtual slots.

Rows hash into thousands of slots, bytes are summed per slot, and a versioned map sends slots to
shards. Maps are kept under a path, each version beside the ones before. Rebalancing edits the newest map: only the
rows of edited slots move.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetspark.llm.common import id_key, stored, whole_text
from fleetspark.session import new_work_dir

#: rows hash into so many slots; the map and the sums per slot have at most that many rows, whatever
#: the input is, so they may pass through the driver
SLOTS = 8192
#: rows that are alike in id, size and text go to slots by so many
COPIES = 64
#: a stored map is edited when the heaviest shard has more than this share over the mean
SPREAD = 0.02


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]`` under ``version``; ``shards`` are numbered from 0."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def table(self, spark) -> DataFrame:
        rows = [(self.version, slot, shard) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, virtual_slot int, shard int")


def first_map(loads: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """The heaviest slot goes to the lightest shard, slot by slot; ties go by number."""
    heap = [(0, s) for s in range(shards)]
    shard_of = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        # an empty slot counts as one byte, so that empty slots spread too
        heapq.heappush(heap, (load + max(loads.get(slot, 0), 1), shard))
    return SlotMap(1, shards, tuple(shard_of))


def rebalanced(old: SlotMap, loads: dict[int, int], shards: int | None = None) -> SlotMap:
    """The next version of ``old``, for new loads or another number of shards.

    Slots of shards that are gone move to the lightest shard. Then the heaviest shard gives the
    lightest one the largest slot that narrows their distance, until none does. All other slots
    stay where they are.
    """
    shards = shards or old.shards
    shard_of = list(old.shard_of)
    load = [0] * shards
    homeless = []
    for slot, shard in enumerate(shard_of):
        if shard < shards:
            load[shard] += loads.get(slot, 0)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-loads.get(s, 0), s)):
        shard = min(range(shards), key=lambda s: (load[s], s))
        shard_of[slot] = shard
        load[shard] += loads.get(slot, 0)
    members: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        members[shard].append(slot)
    while True:
        high = max(range(shards), key=lambda s: (load[s], -s))
        low = min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        able = [s for s in members[high] if 0 < loads.get(s, 0) < gap]
        if not able:
            return SlotMap(old.version + 1, shards, tuple(shard_of))
        slot = max(able, key=lambda s: (min(loads[s], gap - loads[s]), -s))
        members[high].remove(slot)
        members[low].append(slot)
        shard_of[slot] = low
        load[high] -= loads[slot]
        load[low] += loads[slot]


# --- stored maps ------------------------------------------------------------------


def read_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap | None:
    """The stored map of a version, or the newest one; None if there is none."""
    try:
        maps = spark.read.schema("virtual_slot int, shard int, shards int, version int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    rows = sorted(maps.where(F.col("version") == version).collect()) if version is not None else []  # one row per slot
    return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows)) if rows else None


def write_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Store a map beside the other versions; the same version is replaced, so a repeated job leaves one."""
    rows = slot_map.table(spark).withColumn("shards", F.lit(slot_map.shards))
    rows.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={slot_map.version}")


def current_map(spark: SparkSession, path: str, loads: dict[int, int], shards: int, slots: int = SLOTS) -> SlotMap:
    """The map to use for these loads. The newest stored one stays as it is while it has as many shards and they are
    nearly equal; else its next version, or the first map of all, is stored and used."""
    old = read_map(spark, path)
    if old is None:
        new = first_map(loads, shards, slots)
    elif len(old.shard_of) != slots:
        raise ValueError(f"the map under {path} has {len(old.shard_of)} slots, not {slots}; the number of slots is fixed")
    else:
        held = [0] * max(old.shards, shards)
        for slot, shard in enumerate(old.shard_of):
            held[shard] += loads.get(slot, 0)
        if old.shards == shards and max(held) * shards <= (1 + SPREAD) * sum(held):
            return old
        new = rebalanced(old, loads, shards)
        if new.shard_of == old.shard_of and new.shards == old.shards:
            return old
    write_map(spark, new, path)
    return new


# --- rows -------------------------------------------------------------------------


def sized(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size`` (bytes plus one), ``text_crc32, block, copies, virtual_slot``: rows alike in the first three
    are one row for every COPIES of them, folded in the map task that reads them.

    The slot hashes all of these, so rows that share an id spread, and so do copies of one row. The result is stored: the
    texts are read once.
    """
    text = whole_text(text_col)
    alike = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    blocks = alike.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))).alias("block"))
    copies = F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("block") * COPIES)
    hashed = F.xxhash64(id_key("doc_id"), "size", "text_crc32", "block")
    return stored(
        blocks.select("doc_id", "size", "text_crc32", "block", copies.alias("copies"),
                      F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot")), "sized")


def slot_loads(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot: at most as many rows as there are slots."""
    return dict(rows.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies"))).collect())


def place(rows: DataFrame, slot_map: SlotMap) -> DataFrame:
    """The single rows behind ``sized`` with their ``shard`` and their place in it, ``slot`` = 0, 1, 2, ...

    Rows are numbered inside their virtual slot and shifted by the rows of the slots before it in
    the shard, so no task sees a whole shard. Rows alike in all columns get consecutive numbers.
    """
    table = F.broadcast(slot_map.table(rows.sparkSession))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy("virtual_slot").agg(F.sum("copies").alias("n")).join(table, "virtual_slot")
        .select("virtual_slot", "shard", "version", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    order = Window.partitionBy("virtual_slot").orderBy(id_key("doc_id"), "size", "text_crc32", "block")
    earlier = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("at", earlier)
        .join(F.broadcast(counts), "virtual_slot")  # one row per slot
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("slot", F.col("shift") + F.col("at") + F.col("copy"))
        .drop("at", "shift", "copy", "copies", "block")
    )


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """All rows in ``shards`` shards of nearly equal bytes (law ``bytes``).

    The map under ``map_path`` is used, edited if need be, or made (``current_map``); without a path it is stored
    in a folder of its own. NULL text counts as no bytes; a NULL id hashes like any other value. Rows that repeat are
    placed one by one. An empty table gives an empty table. Columns other than id and text are not read.
    """
    spark = docs.sparkSession
    rows = sized(docs, slots)
    slot_map = current_map(spark, map_path or new_work_dir(spark, "slot-map"), slot_loads(rows), shards, slots)
    return place(rows, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
    )
