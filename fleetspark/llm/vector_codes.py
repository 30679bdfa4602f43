"""Vectors as short codes: one nearest codebook entry for each of their parts, in whole numbers.

Parts and entries go through an integer Walsh-Hadamard transform, which keeps squared distances up to the factor of
its length and gathers most of a difference in the coefficients of few sign changes. Squared differences add up
in that order (sequency), and an entry whose sum passes the whole distance of another one is out. No floating
point decides anything, so the result does not depend on how the rows are spread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import ship, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: vectors that are compared at once in a worker
ROWS = 4096
#: a component times SCALE lies below this, either sign
RANGE = 2**31


# --- transform and search ----------------------------------------------------------


def sequency_order(size: int) -> np.ndarray:
    """Places of the coefficients of ``transformed`` by the sign changes of their rows."""
    rows = transformed(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=0) != 0).sum(0), kind="stable")


def transformed(parts: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    out, size, half = parts, parts.shape[-1], 1
    while half < size:
        pairs = out.reshape(*out.shape[:-1], size // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        out = np.stack([a + b, a - b], axis=-2).reshape(parts.shape)
        half *= 2
    return out


def padded(parts: np.ndarray) -> np.ndarray:
    """Zeros behind each part up to a power of two."""
    size = 1 << max(parts.shape[-1] - 1, 0).bit_length()
    out = np.zeros((*parts.shape[:-1], size), parts.dtype)
    out[..., : parts.shape[-1]] = parts
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``x`` the nearest of ``entries``, ties to the lower one, and the scaled squared distance.

    Both are transformed and in sequency order. The entry nearest by the first coefficient gives a bound;
    entries whose sum so far is larger can't be nearest and take no part in further coefficients.
    """
    sums = (x[:, None, 0] - entries[None, :, 0]) ** 2
    bound = ((x - entries[sums.argmin(1)]) ** 2).sum(1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for place in range(1, x.shape[1]):
        sums = sums + (x[row, place] - entries[entry, place]) ** 2
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    whole = np.repeat((bound + 1)[:, None], len(entries), 1)
    whole[row, entry] = sums
    best = whole.argmin(1)
    return best, whole[np.arange(len(x)), best]


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` are whole numbers; vectors have ``width`` components, parts ``size``."""

    entries: list[list[list[int]]]
    width: int
    size: int
    scale: int

    def sha256(self) -> str:
        numbers = (str(c) for part in self.entries for entry in part for c in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


class _Search:
    """Codes of rows of whole numbers, by codebooks that are transformed once."""

    def __init__(self, books: Codebooks):
        self.books = books
        self.own = np.array(books.entries, np.int64)
        self.order = sequency_order(padded(self.own).shape[-1])
        self.entries = transformed(padded(self.own))[..., self.order]

    def parts(self, column: pa.Array) -> np.ndarray:
        """(rows, parts, size) of a column of lists; short vectors end in zeros."""
        books, values = self.books, column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = column.value_lengths().to_numpy()
        out = np.zeros((len(column), len(books.entries) * books.size), np.int64)
        out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = values
        return out.reshape(len(column), len(books.entries), books.size)

    def codes(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance per row and part."""
        size = self.entries.shape[-1]
        highest = max(int(np.abs(parts).max(initial=0)), int(np.abs(self.own).max(initial=0)))
        # size squared times (2 highest) squared bounds a scaled distance; beyond 64 bits Python's numbers take over
        kind = np.int64 if size * highest < 2**30 else object
        x = transformed(padded(parts.astype(kind)))[..., self.order]
        found = [nearest(x[:, p], self.entries[p].astype(kind)) for p in range(parts.shape[1])]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] // size for f in found], 1)


# --- tables -----------------------------------------------------------------------


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v``: the vectors that are not NULL and hold no NULL, NaN or infinite component, each component
    as the largest whole number not above ``scale`` times it. One outside 32 bits raises."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    times = lambda x: x.cast("double") * scale
    whole = lambda x: F.when(F.abs(times(x)) < RANGE, F.floor(times(x)).cast("int")).otherwise(
        F.raise_error(F.lit("a component is too large for codes in whole numbers")).cast("int"))
    rows = vectors.where(F.col("embedding").isNotNull()).where(usable)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("embedding", whole).alias("v"))


def _first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """The parts of the vectors with the smallest ids; there are fewer entries if the table has fewer rows."""
    width = rows.agg(F.max(F.size("v")).alias("n")).first().n or 0
    size = max(-(-width // parts), 1)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()  # so many rows at most
    whole = [[*r.v, *[0] * (parts * size - len(r.v))] for r in first]
    return Codebooks([[v[p * size : (p + 1) * size] for v in whole] for p in range(parts)], width, size, scale)


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the floor of the mean of the parts that are nearest to it. A task sends one row for
    each component of an entry in use, whatever the rows it has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(books)
        total, count = np.zeros(search.own.shape, np.int64), np.zeros(search.own.shape[:2], np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                parts = search.parts(batch.column(0).slice(at, ROWS))
                best, _ = search.codes(parts)
                for p in range(parts.shape[1]):
                    np.add.at(total[p], best[:, p], parts[:, p])
                    count[p] += np.bincount(best[:, p], minlength=count.shape[1])
        p, e, c = np.nonzero(np.repeat((count > 0)[..., None], total.shape[2], 2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (p, e, c, total[p, e, c], count[p, e])], names=["p", "e", "c", "s", "n"])

    summed = rows.select("v").mapInArrow(run, "p long, e long, c long, s long, n long")
    exact = [F.sum(F.col(x).cast("decimal(20,0)")).alias(x) for x in ("s", "n")]
    entries = [[list(entry) for entry in part] for part in books.entries]
    for r in summed.groupBy("p", "e", "c").agg(*exact).collect():  # one number per component of an entry
        entries[r.p][r.e][r.c] = int(r.s) // int(r.n)
    return Codebooks(entries, books.width, books.size, books.scale)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of all ``rows`` (see ``whole_numbers``): they start as the parts of the vectors with the smallest
    ids, and in each round every entry moves to the mean of its parts; an unused one stays.

    Vectors are taken as long as the longest one, or the next multiple of ``parts``, by zeros at their end.
    Rows alike in id start in the order of their components, rows without an id after all others. Without rows, all codebooks are empty.
    """
    books = _first_books(rows, parts, entries, scale)
    if books.entries[0]:
        for _ in range(rounds):
            books = _moved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error``: two hexadecimal digits per part, and the squared distance of all parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(books)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                best, distance = search.codes(search.parts(some.column(2)))
                code = [bytes(b).hex() for b in best.astype(np.uint8)]
                error = [int(e) for e in distance.sum(1)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with a column ``embedding``: the entries that the column ``code`` names, one after the other."""
    per_part = F.array(*[F.array(*[F.array(*[F.lit(c / books.scale) for c in e]) for e in part]) for part in books.entries])
    places = F.sequence(F.lit(0), F.lit(len(books.entries) - 1))
    entry = lambda p: F.conv(F.substring("code", p * 2 + 1, F.lit(2)), 16, 10).cast("int")
    whole = F.flatten(F.transform(places, lambda p: F.get(F.get(per_part, p), entry(p))))
    return codes.withColumn("embedding", F.slice(whole, 1, max(books.width, 1)))


def compress(vectors: DataFrame) -> DataFrame:
    """What the registered query returns: per usable vector its code and error, the error of all vectors of its
    label and the digest of the codebooks.

    Unusable vectors go (``whole_numbers``). Repeated rows and ids stay, one row each; rows without a label
    count as one label; an empty vector is all zeros; an empty table gives an empty table. Further columns are not read.
    """
    rows = stored(whole_numbers(vectors), "whole-numbers")
    books = fit(rows)
    coded = stored(encode(rows, books), "codes")
    total = F.sum(F.col("error").cast("decimal(20,0)")).cast("long").alias("label_error")
    labels = stored(coded.groupBy(F.col("label").alias("of")).agg(total), "label-errors")
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


# --- SQL counterpart ----------------------------------------------------------------


def _oracle() -> str:
    """All rounds spelt out, squared distances by their definition."""
    ctes = [f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""", f"""
parts AS MATERIALIZED (
    SELECT rid, p, list_slice(v, CAST(p * len(v) // {PARTS} + 1 AS BIGINT), CAST((p + 1) * len(v) // {PARTS} AS BIGINT)) AS x
    FROM kept, range({PARTS}) AS r(p))""", f"""
book0 AS MATERIALIZED (
    SELECT p, CAST(e AS BIGINT) AS e, x AS c FROM parts JOIN (
        SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept) USING (rid) WHERE e < {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        ctes.append(f"""
near{r} AS MATERIALIZED (
    SELECT rid, p, any_value(x) AS x, min(d * {ENTRIES} + e) AS best FROM (
        SELECT rid, p, x, e, CAST(list_sum([(t[1] - t[2]) * (t[1] - t[2]) FOR t IN list_zip(x, c)]) AS BIGINT) AS d
        FROM parts JOIN book{r} USING (p)) GROUP BY rid, p)""")
        if r < ROUNDS:
            ctes.append(f"""
book{r + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
        SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
            SELECT p, best % {ENTRIES} AS e, i, sum(x[i]) AS s, count(*) AS n
            FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{r}) GROUP BY p, best % {ENTRIES}, i)
        GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)""")
    return f"""WITH {",".join(ctes)},
coded AS MATERIALIZED (
    SELECT rid, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY rid),
digest AS (
    SELECT sha256(string_agg(c[i], ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, c, unnest(range(1, len(c) + 1)) AS i FROM book{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest"""


ORACLE = _oracle()

ship(__name__)
