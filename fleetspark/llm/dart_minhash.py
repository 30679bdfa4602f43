"""Near-duplicate classes by DartMinHash.

A document is a weighted set: its shingles of five words, each as often as it occurs. Hashed darts fall
on the plane of weight and rank above every shingle; those below the shingle's weight count. The
earliest dart of each coordinate is the signature: two documents agree in a coordinate with the
probability of their weighted Jaccard similarity. Bands of coordinates give candidates, and the exact
similarity of the texts decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetspark.llm.common import NO_ID, frugal, id_key, ship, stored, whole_text

SHINGLE, SIMILAR = 5, 0.8
#: of a million pairs of similarity 0.8, seven miss all bands: (1 - 0.8^5)^30
BANDS, ROWS = 30, 5
COORDINATES = BANDS * ROWS
#: buckets up to this size try all their pairs; larger ones try so many centres, then split by the next band
SMALL, CENTRES, LEVELS = 8, 3, 3
#: for documents whose large buckets mostly hold documents of another class: further partners per bucket
PARTNERS = 4
#: what is still apart is joined on its rarest shingles. Documents of one class and of sizes within this factor are a
#: unit, split where they have more than so many shingles; a shingle of many units is cut into blocks of about so many
SIZES, MASS, BLOCK = 1.03, 20_000, 256
UNIT = ["component", "size", "salt"]
#: coordinates that must agree before texts are compared: five standard deviations below 0.8
AGREE = int(COORDINATES * SIMILAR - 5 * (COORDINATES * SIMILAR * (1 - SIMILAR)) ** 0.5)
_WORD = re.compile(r"[^\W_]+")
_M = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall((text or "").lower())


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_weights(words: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles and how often each occurs; a text of fewer words is one shingle."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = _mix(total * _M + hashed[i : i + n])
    return np.unique(total, return_counts=True)


def numbered(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One hash for each unit of weight above each shingle."""
    cells = np.repeat(_mix(shingles * _M), weights)
    first = np.cumsum(weights) - weights
    return _mix(cells + (np.arange(len(cells)) - np.repeat(first, weights)).astype(np.uint64) * _M)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][at], b[1][bt]).sum()
    every = a[1].sum() + b[1].sum() - common
    return float(common / every) if every else 0.0


def darts(shingles: np.ndarray, weights: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The signature: a 64-bit mark of the earliest dart of each of ``k`` coordinates.

    Each unit of weight above a shingle is a cell. Darts hit a cell at the times of a Poisson process
    that depends on the cell alone. About k log k + 2k darts are thrown, and more while a
    coordinate is without one.
    """
    cells = numbered(shingles, weights)
    horizon = k * (np.log(k) + 2) / len(cells)

    def waits(rows: np.ndarray, start: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        marks = _mix(rows[:, None] + np.arange(start + 1, start + count + 1, dtype=np.uint64) * _M)
        return marks, -np.log(((marks >> np.uint64(11)) + np.uint64(1)) * 2.0**-53)

    while True:
        marks, times = waits(cells, 0, 1)
        hit = times[:, 0] <= horizon
        found = [(times[hit, 0], marks[hit, 0])]
        rows, clock, start = cells[hit], times[hit, 0], 1
        step = int(np.ceil(horizon + 4 * horizon**0.5)) + 2
        while len(rows):
            marks, gaps = waits(rows, start, step)
            times = clock[:, None] + np.cumsum(gaps, 1)
            inside = times <= horizon
            found.append((times[inside], marks[inside]))
            more = inside[:, -1]
            rows, clock, start = rows[more], times[more, -1], start + step
        times = np.concatenate([t for t, _ in found])
        marks = _mix(np.concatenate([m for _, m in found]))
        place = (marks % np.uint64(k)).astype(np.int64)
        order = np.lexsort((marks, times))[::-1]
        out, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[place[order]] = marks[order]  # the earliest is written last
        filled[place] = True
        if filled.all():
            return out
        horizon *= 2


def bands_of(signature: np.ndarray) -> np.ndarray:
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in signature.reshape(BANDS, ROWS).T:
        total = _mix(total * _M + column)
    return total.view(np.int64)


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, hash of the text, 128-bit digest of its words (of its text if it has none), hashes of the
    bands and one byte of each coordinate. A text without words has no bands."""

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py()
                words = words_of(text)
                raw = " ".join(words) if words else "\n" + text
                key = blake2b(raw.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                high, low = np.frombuffer(key, np.int64).tolist()
                signature = darts(*shingle_weights(words)) if words else None
                rows.append((
                    id_, th, high, low, bands_of(signature).tolist() if words else [],
                    (signature >> np.uint64(56)).astype(np.uint8).tobytes() if words else b""))
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["id", "th", "k1", "k2", "bands", "sig"])

    text = whole_text(text_col)
    rows = docs.select(id_key(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(frugal(signed), "id long, th long, k1 long, k2 long, bands array<long>, sig binary")


# --- candidates -------------------------------------------------------------------


def _ordered(*columns: str) -> list[Column]:
    """Both ends of a pair, the smaller one first."""
    return [F.least(*columns).alias("a"), F.greatest(*columns).alias("b")]


def _each_once(rows: DataFrame, others: str) -> DataFrame:
    """The pairs of ``node`` and each of ``others``. The bands of a node mostly name the same few, so they
    are put together per node (an array for each of its bands) before they become rows."""
    merged = rows.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set(others))).alias("others"))
    return merged.select("node", F.explode("others").alias("other")).where("node != other")


def _level_pairs(rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes that share a bucket, and the rows of the buckets too large to try all pairs, with
    the bucket's first ``centre``.

    ``rows`` has ``node``, ``band`` and ``h1`` .. ``h<LEVELS>``. In a large bucket each node is paired
    with the centres, the nodes with the most company over all bands, as an original has among its changed
    copies. Work grows with the number of nodes, not with its square.
    """
    key = ["band", f"h{level}"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(rows.join(stored(sizes, "sizes"), key), "buckets")
    small = shared.where(F.col("size") <= SMALL).select(*key, "node")
    tried = small.alias("x").join(small.withColumnRenamed("node", "other"), key).where("node < other")
    large = shared.where(F.col("size") > SMALL)
    company = large.groupBy("node").agg(F.sum("size").alias("company"))
    # the ranking is cut to a few rows per bucket in every task, before the shuffle
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("company"), "node"))
    ranked = large.select(*key, "node").join(company, "node").withColumn("rank", rank).where(F.col("rank") <= CENTRES)
    centres = ranked.groupBy(*key).agg(F.collect_list(F.struct("rank", "node")).alias("found"))  # CENTRES at most
    centres = stored(centres.select(*key, F.array_sort("found")["node"].alias("centres")), "centres")
    large = stored(large.drop("size").join(centres, key).withColumn("centre", F.get("centres", F.lit(0))), "large")
    starred = _each_once(large, "centres")
    pairs = tried.select("node", "other").unionByName(starred).select(*_ordered("node", "other"))
    return pairs, large.drop("centres")


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The distinct pairs that agree in enough coordinates, stored."""

    def agreeing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COORDINATES) for i in (2, 3))
            likely = (x == y).sum(1) >= AGREE
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(likely)) for i in (0, 1)], names=["a", "b"])

    sig = nodes.select("node", "sig")
    both = (
        pairs.distinct()
        .join(sig.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
        .join(sig.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b")
    )
    return stored(both.select("a", "b", "sig_a", "sig_b").mapInArrow(frugal(agreeing), "a long, b long"), "pairs")


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs ``a < b`` that share a band and agree in enough coordinates; and the rows of large
    buckets, ``node, band, level, bucket, centre``."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.struct(
            i.alias("band"),
            *[F.xxhash64(*[F.get(F.col("bands"), (i + j) % BANDS) for j in range(level)]).alias(f"h{level}")
              for level in range(1, LEVELS + 1)]),
    )
    rows = nodes.where(F.size("bands") > 0).select("node", F.inline(bands))
    found = large = None
    for level in range(1, LEVELS + 1):
        pairs, rows = _level_pairs(rows, level)
        part = rows.select("node", "band", F.lit(level).alias("level"), F.col(f"h{level}").alias("bucket"), "centre")
        rows = rows.drop("centre")
        found, large = (pairs, part) if found is None else (found.unionByName(pairs), large.unionByName(part))
    return _agreeing(found, nodes), large


def further_candidates(large: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """More pairs for the nodes of large buckets that are in another class (``node, component``) than
    the bucket's centre: with each other in turn, as far as their buckets are small, and with nodes that
    another order puts first in each bucket. The others need none: they are linked already."""
    own = classes.withColumnRenamed("component", "own")
    theirs = classes.withColumnsRenamed({"node": "centre", "component": "theirs"})
    key = ["band", "level", "bucket"]
    apart = stored(
        large.join(own, "node", "left").join(theirs, "centre", "left")
        .where(F.coalesce("own", "node") != F.coalesce("theirs", "centre")).select(*key, "node"),
        "apart")
    few = apart.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where((F.col("size") > 1) & (F.col("size") <= SMALL))
    among = apart.join(few, key).select(*key, "node")
    among = among.join(among.withColumnRenamed("node", "other"), key).where("node < other")
    # a mask orders the nodes another way, and gives the node back when applied again
    masks = [F.shiftright(F.xxhash64(*key, F.lit(i)), 1) for i in range(PARTNERS)]
    wanted = apart.select(*key).distinct()
    firsts = large.join(wanted, key).groupBy(*key).agg(
        *[F.min(F.col("node").bitwiseXOR(m)).alias(f"m{i}") for i, m in enumerate(masks)])
    partners = F.array_distinct(F.array(*[F.col(f"m{i}").bitwiseXOR(m) for i, m in enumerate(masks)]))
    partners = stored(firsts.select(*key, partners.alias("partners")), "partners")
    others = _each_once(apart.join(partners, key), "partners")
    return _agreeing(among.select("node", "other").unionByName(others).select(*_ordered("node", "other")), nodes)


def unresolved(large: DataFrame, classes: DataFrame) -> DataFrame:
    """``node`` and ``component`` of the nodes whose large buckets hold more than one class."""
    key = ["band", "bucket"]
    rows = stored(large.where("level = 1").join(classes, "node").select(*key, "node", "component"), "classed")
    several = rows.groupBy(*key).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    return stored(rows.join(stored(several.select(*key), "several"), key).select("node", "component").distinct(), "unresolved")


def _size_classes() -> np.ndarray:
    """The smallest size of each class of sizes."""
    out = [1]
    while out[-1] < 2**31:
        out.append(max(out[-1] + 1, int(out[-1] * SIZES)))
    return np.array(out)


def _least_common(n: int, m: int, similar: float) -> int:
    """How many shingles two documents of n and m of them must share to be as similar."""
    return int(np.ceil(similar / (1 + similar) * (n + m) - 1e-6))


def _units(rows: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents of ``rows`` (``node, component``) with ``tokens``, and the units they make up by
    ``component, size, salt``: ``unit, nodes, node`` (its first), ``least`` and ``most`` shingles, and the ``tokens`` of them all.

    A unit is part of one class, of documents of about one size. Its shingles are put together in the task that reads
    the texts, so a class of near copies is a few rows whatever their number.
    """
    lowest = _size_classes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 200):
                some = batch.slice(part, 200)
                found = [numbered(*shingle_weights(words_of(t.as_py()))).view(np.int64) for t in some.column(2)]
                lengths = np.array([len(f) for f in found], np.int64)
                size = np.searchsorted(lowest, lengths, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(size), pa.array(lengths), pa.array(found, pa.list_(pa.int64()))],
                    names=["node", "component", "size", "n", "tokens"])

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``component, size, salt, nodes, node, least, most, tokens`` of the units as far as this task has them."""
        held: dict = {}
        total = 0

        def table() -> pa.RecordBatch:
            rows = [(*key, *values[:4], np.fromiter(values[4], np.int64, len(values[4]))) for key, values in held.items()]
            columns = list(zip(*rows))
            types = [pa.int64()] * 7 + [pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["component", "size", "salt", "nodes", "node", "least", "most", "tokens"])

        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for (component, size, salt, node, n), tokens in zip(keys, batch.column(5)):
                unit = held.setdefault((component, size, salt), [0, node, n, n, set()])
                unit[:4] = unit[0] + 1, min(unit[1], node), min(unit[2], n), max(unit[3], n)
                before = len(unit[4])
                unit[4].update(tokens.values.to_numpy().tolist())
                total += len(unit[4]) - before
                if total > 200_000:
                    yield table()
                    held.clear()
                    total = 0
        if held:
            yield table()

    held = rows.join(texts, "node").select("node", "component", "text").mapInArrow(
        frugal(cut), "node long, component long, size long, n long, tokens array<long>")
    held = stored(held, "shingles")
    salts = held.groupBy("component", "size").agg(F.ceil(F.sum("n") / MASS).alias("salts"))
    salt = F.pmod(F.xxhash64("node"), F.greatest("salts", F.lit(1))).alias("salt")
    salted = held.join(stored(salts, "salts"), ["component", "size"]).select("component", "size", salt, "node", "n", "tokens")
    parts = salted.mapInArrow(
        frugal(merged), "component long, size long, salt long, nodes long, node long, least long, most long, tokens array<long>")
    # a unit has at most MASS shingles, or those of a few documents
    units = parts.groupBy(*UNIT).agg(
        F.sum("nodes").alias("nodes"), F.min("node").alias("node"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("tokens"))
    return salted, stored(units.select(F.monotonically_increasing_id().alias("unit"), "*"), "units")


def _unit_pairs(units: DataFrame, similar: float) -> DataFrame:
    """Pairs ``a < b`` of units of different classes that may hold documents as similar as asked for, by an exact
    prefix join.

    Two texts of n and m shingles have at least similar / (1 + similar) * (n + m) in common, so the first
    common one, in any order of all shingles, stands that near the front of both units. Shingles of one class need no
    join; of the others the rare ones come first: what a whole template shares comes last. The place
    depends on both sizes, so a shingle is joined per pair of size classes.
    """
    lowest = _size_classes()

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(found: list) -> pa.RecordBatch:
            lengths = [len(f[0]) for f in found]
            rest = [pa.array(np.repeat(np.array([f[i] for f in found], np.int64), lengths)) for i in (1, 2, 3)]
            keys = np.concatenate([f[0] for f in found]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys), *rest], names=["key", "side", "unit", "component"])

        found, total = [], 0
        for batch in batches:
            for unit, component, low, high, tokens in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                tokens = tokens.values.to_numpy().view(np.uint64)
                least, most = int(np.ceil(similar * low - 1e-6)), int(high / similar + 1e-6)
                own, first, last = np.searchsorted(lowest, [low, max(least, 1), most], "right") - 1
                for other in range(first, last + 1):
                    common = _least_common(low, max(least, int(lowest[other])), similar)
                    front = tokens[: max(0, len(tokens) + 1 - common)]
                    if not len(front):
                        continue
                    pair = np.uint64(min(own, other) * len(lowest) + max(own, other))
                    keys = _mix(front * _M + pair)
                    for side in (0, 1) if own == other else (int(own > other),):
                        found.append((keys, side, unit, component))
                        total += len(keys)
                if total > 200_000:
                    yield table(found)
                    found, total = [], 0
        if found:
            yield table(found)

    def crossed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                (a, of_a), (b, of_b) = ([s.values.field(i).to_numpy() for i in (0, 1)] for s in (x, y))
                i, j = np.nonzero(of_a[:, None] != of_b[None, :])
                first, second = np.minimum(a[i], b[j]), np.maximum(a[i], b[j])
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second)], names=["a", "b"])

    each = units.select("unit", "component", "least", "most", F.explode("tokens").alias("token"))
    spread = [F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("holders")]
    shared = stored(each.groupBy("token").agg(*spread).where("x != y").select("token", "holders"), "shared")
    ranked = each.join(shared, "token").groupBy("unit", "component", "least", "most").agg(
        F.array_sort(F.collect_list(F.struct("holders", "token")))["token"].alias("tokens"))
    fronts = stored(ranked.mapInArrow(frugal(prefixes), "key long, side long, unit long, component long"), "fronts")
    sides = [F.min("side").alias("s"), F.max("side").alias("t")]
    keys = fronts.groupBy("key").agg(*spread, *sides).where("x != y and s != t").select("key", "holders")
    salt = F.pmod(F.xxhash64("unit"), F.ceil(F.col("holders") / BLOCK)).alias("salt")
    blocks = fronts.join(stored(keys, "keys"), "key").groupBy("key", "side", salt).agg(
        F.collect_list(F.struct("unit", "component")).alias("held"))
    blocks = stored(blocks, "blocks")
    left = blocks.where("side = 0").select("key", F.col("held").alias("x"))
    right = blocks.where("side = 1").select("key", F.col("held").alias("y"))
    return left.join(right, "key").select("x", "y").mapInArrow(frugal(crossed), "a long, b long").distinct()


def _first_link(x: list[np.ndarray], y: list[np.ndarray], similar: float) -> tuple[int, int] | None:
    """Places of two documents, shingles of each given, that are as similar as asked for; one such pair is
    enough. Counts what one of the smaller side has in common with all of the other at once."""
    swapped = len(x) > len(y)
    few, many = (y, x) if swapped else (x, y)
    lengths = np.array([len(m) for m in many])
    tokens, owner = np.concatenate(many), np.repeat(np.arange(len(many)), lengths)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    for i, own in enumerate(few):
        start, end = np.searchsorted(tokens, own), np.searchsorted(tokens, own, "right")
        reach = end - start
        at = np.repeat(start - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
        common = np.bincount(owner[at], minlength=len(many))
        found = np.flatnonzero(common / (lengths + len(own) - common) >= similar)
        if len(found):
            return (int(found[0]), i) if swapped else (i, int(found[0]))
    return None


def _unit_links(pairs: DataFrame, documents: DataFrame, units: DataFrame, similar: float) -> DataFrame:
    """One link ``a, b`` between nodes for each pair of units that has any. Members are brought together only for
    pairs whose shingles, all taken together, have enough in common."""

    def enough(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                common = len(np.intersect1d(x.values.to_numpy(), y.values.to_numpy(), assume_unique=True))
                keep.append(common >= _least_common(n, m, similar))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"])

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for pair in zip(batch.column(0), batch.column(1)):
                (x, of_x), (y, of_y) = ([side.values.field(i) for i in (0, 1)] for side in pair)
                sides = [[tokens.values.to_numpy() for tokens in side] for side in (of_x, of_y)]
                if place := _first_link(*sides, similar):
                    found.append((x[place[0]].as_py(), y[place[1]].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    kept = units.select("unit", "least", "tokens")
    both = (
        pairs.join(kept.withColumnsRenamed({"unit": "a", "least": "n", "tokens": "x"}), "a")
        .join(kept.withColumnsRenamed({"unit": "b", "least": "m", "tokens": "y"}), "b")
    )
    near = stored(both.select("a", "b", "n", "m", "x", "y").mapInArrow(frugal(enough), "a long, b long"), "near-units")
    wanted = near.select(F.col("a").alias("unit")).unionByName(near.select(F.col("b").alias("unit"))).distinct()
    wanted = stored(units.select("unit", *UNIT).join(wanted, "unit"), "wanted-units")
    held = documents.join(wanted, UNIT).groupBy("unit").agg(F.collect_list(F.struct("node", "tokens")).alias("held"))
    held = stored(held, "unit-members")
    both = (
        near.join(held.withColumnsRenamed({"unit": "a", "held": "x"}), "a")
        .join(held.withColumnsRenamed({"unit": "b", "held": "y"}), "b")
    )
    return both.select("x", "y").mapInArrow(frugal(linked), "a long, b long")


def remaining_links(rows: DataFrame, texts: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """Links between different classes of ``rows`` (``node, component``) that connect all of them that any link
    of the similarity does. Work goes by units of a class; only what may be linked comes back as documents."""
    documents, units = _units(rows, texts)
    pairs = stored(_unit_pairs(units, similar), "unit-pairs")
    single = units.where("nodes = 1").select("unit", "node")
    alone = (
        pairs.join(single.withColumnsRenamed({"unit": "a", "node": "x"}), "a", "left")
        .join(single.withColumnsRenamed({"unit": "b", "node": "y"}), "b", "left")
    )
    alone = stored(alone, "unit-pairs")
    singles = alone.where("x IS NOT NULL AND y IS NOT NULL").select(*_ordered("x", "y"))
    links = verify(_agreeing(singles, nodes), texts, similar).select("a", "b")
    several = alone.where("x IS NULL OR y IS NULL").select("a", "b")
    return links.unionByName(_unit_links(several, documents, units, similar))


def verify(pairs: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The pairs whose texts have at least the weighted Jaccard similarity ``similar``."""

    def alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = {}, {}  # shingles of the texts of the batch before and of this one
        for batch in batches:
            last, kept = kept, {}

            def weights(node, text):
                if node not in kept:
                    kept[node] = last[node] if node in last else shingle_weights(words_of(text.as_py()))
                return kept[node]

            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [
                weighted_jaccard(weights(x, tx), weights(y, ty))
                for x, y, tx, ty in zip(a, b, batch.column(2), batch.column(3))
            ]
            kept = dict(list(kept.items())[-2000:])
            value = np.array(found, float)
            keep = pa.array(value >= similar)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(value).filter(keep)],
                names=["a", "b", "similarity"])

    both = (
        pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(frugal(alike), "a long, b long, similarity double")


def _relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The distinct edges between the labels of both ends; a node without a label is its own."""
    of_a = labels.withColumnsRenamed({"node": "a", "component": "to_a"})
    of_b = labels.withColumnsRenamed({"node": "b", "component": "to_b"})
    ends = edges.join(of_a, "a", "left").join(of_b, "b", "left").select(
        F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"))
    return ends.where("x != y").select(*_ordered("x", "y")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable from it, for the nodes of ``edges``.

    Every node points to its smallest neighbour if that is smaller; pointers are followed, twice as far
    each time, to the nodes that point nowhere. Then only edges between these are left, few after
    the first round. Each step is written to the shared folder.
    """
    edges = stored(edges.where("a != b").select(*_ordered("a", "b")).distinct(), "edges")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = F.least("node", F.min("b")).alias("component")
        labels = stored(both.groupBy(F.col("a").alias("node")).agg(smallest), "labels")
        while True:
            jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
            moved = stored(labels.join(jump, "component"), "labels")
            labels = moved.select("node", F.col("further").alias("component"))
            if moved.where("component != further").isEmpty():
                break
        if found is None:
            found = labels
        else:
            jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
            found = stored(found.join(jump, "component", "left").select(
                "node", F.coalesce("further", "component").alias("component")), "labels")
        edges = stored(_relabelled(edges, labels), "edges")
        if edges.isEmpty():
            return found


def _followed(labels: DataFrame, further: DataFrame) -> DataFrame:
    """``labels`` with each component replaced by what ``further`` makes of it."""
    jump = further.select(F.col("node").alias("component"), F.col("component").alias("further"))
    return labels.join(jump, "component", "left").select("node", F.coalesce("further", "component").alias("component"))


def _classes(docs: DataFrame, id_col: str, text_col: str, similar: float) -> DataFrame:
    """``id, th, class_id, first``, once for every row of ``docs``: the smallest id of its class, NO_ID
    if none has an id, and whether the row stands for its class (copies of it under the same id do, too)."""
    signed = stored(sign(docs, id_col, text_col), "signatures")
    # rows without an id come last, so they name a class only among themselves
    place = F.struct(F.col("id") == NO_ID, "id", "th")
    own = stored(
        signed.groupBy("k1", "k2").agg(
            F.min(place).alias("source"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "source.id", "source.th", "bands", "sig"),
        "nodes")
    pairs, large = candidates(own)
    involved = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    involved = stored(involved.unionByName(large.select("node")).distinct(), "involved")
    rows = docs.select(id_key(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    texts = rows.join(own.select("node", "id", "th").join(involved, "node"), ["id", "th"]).select("node", "text")
    texts = stored(texts.groupBy("node").agg(F.min("text").alias("text")), "texts")
    edges = stored(verify(pairs, texts, similar).select("a", "b"), "links")
    first = components(edges)
    more = verify(further_candidates(large, own, first), texts, similar).select("a", "b")
    labels = own.select("node").join(first, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    labels = stored(_followed(labels, components(_relabelled(more, first))), "labels")
    left = unresolved(large, labels)
    if not left.isEmpty():
        last = remaining_links(left, texts, own, similar)
        labels = _followed(labels, components(_relabelled(last, labels)))
    labels = stored(labels.join(own.select("node", "id", "th"), "node"), "labels")
    named = labels.groupBy("component").agg(F.min(place).alias("named"))
    named = labels.join(stored(named, "named"), "component").select("node", "named")
    named = stored(named.join(own.select("node", "k1", "k2"), "node").drop("node"), "classes")
    of_row = signed.select("id", "th", "k1", "k2").join(named, ["k1", "k2"])
    is_first = (F.col("id") == F.col("named.id")) & (F.col("th") == F.col("named.th"))
    return of_row.select("id", "th", F.col("named.id").alias("class_id"), is_first.alias("first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``id`` and ``class_id``, the smallest id of its class, once for every row of ``docs``.

    A class is what links of similarity ``similar`` or more connect. Each distinct text is a node of the
    graph, whatever its ids: documents with the same words cost one row each. Texts without words are alike only if equal;
    NULL counts as empty. Rows without an id, or that repeat one, are documents of their own, each in the class of its
    text; a class of rows without ids only has the id NO_ID. An empty table gives an empty table. Other columns are not read.
    """
    return _classes(docs, id_col, text_col, similar).select("id", "class_id")


def classes(docs: DataFrame) -> DataFrame:
    """What the registered query returns: each document and the smallest id of its class."""
    shown = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("id", "doc_id"), ("class_id", "class_id"))]
    return near_duplicates(docs).select(*shown)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, all columns, of each class: that of the smallest id, and the first by its other
    columns' hash of rows that repeat both id and text."""
    found = stored(_classes(docs, id_col, text_col, SIMILAR), "keepers")
    lost = stored(found.where("NOT first").select("id", "th").distinct(), "lost")
    copies = found.where("first").groupBy("id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "th")
    copies = stored(copies, "copies")
    rows = docs.select(F.struct("*").alias("row"), id_key(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("th"))
    kept = rows.join(lost, ["id", "th"], "left_anti")
    if copies.isEmpty():
        return kept.select("row.*")
    # Spark cuts the ranking to one row per key in every task, before the shuffle
    order = Window.partitionBy("id", "th").orderBy(F.xxhash64(F.to_json(F.struct("row"))))
    again = kept.join(copies, ["id", "th"], "left_semi").withColumn("rank", F.row_number().over(order)).where("rank = 1")
    return kept.join(copies, ["id", "th"], "left_anti").select("row.*").unionByName(again.select("row.*"))


ship(__name__)
