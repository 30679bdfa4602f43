"""How far the words of each source stand from those of its language.

Documents are counted once: how often each term occurs in a group (language and source) and in how many of its documents.
Terms of a group with equal counts there and in the language form a cell; what a term is worth depends on its cell
alone. So cells are valued and ranked by how many terms stand before them, and only those
among the first ranks are expanded into terms. Sources are compared pair by pair over blocks of terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetspark.llm.common import LOWER, UPPER, ship, stored

#: documents of a language that must hold a term, pseudocount of every term, parts of a whole probability
LEAST, PRIOR, UNIT = 30, 5, 1_000_000_000
#: ranks of terms that are reported for a group
TOP = 50
#: about so many terms, and at most so many sources of either side, are compared in one task at a time
TERMS, SOURCES = 1024, 128
#: entries a worker counts before it hands them on
HELD = 500_000
#: each byte of a text as it stands in terms: A-Z in lower case, other ASCII but a-z as a blank. All bytes of a
#: character beyond ASCII stay, so terms are the same as by code points
_BYTES = bytes(
    b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


# --- counts -----------------------------------------------------------------------


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of these rows; a NULL term stands for the group itself."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    seen: Counter = Counter()

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                some = terms[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                     pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some], pa.int64()),
                     pa.array([docs[t] for t in some], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2).cast(pa.binary())):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words, before = terms_of(text.as_py()), len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n) - before
            seen[lang, source] += 1
            if size > HELD:
                yield from flushed()
                held.clear()
                size = 0
    yield from flushed()
    groups = list(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string()),
         pa.array([None] * len(groups), pa.string()), pa.array([0] * len(groups), pa.int64()),
         pa.array([seen[g] for g in groups], pa.int64())],
        names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term in each group; the row with a NULL
    term counts the documents of the group. NULL language, source or text is read as an empty string."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    part = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    return stored(part.groupBy("lang", "source", "term").agg(*sums), "term-counts")


def share(count: str, total: str, terms: str, prior: int = PRIOR) -> Column:
    """The smoothed probability in whole parts of UNIT, rounded down, plus one; exact beyond 64 bits."""
    return F.expr(
        f"1 + (CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + {prior} AS DECIMAL(20,0)))"
        f" div CAST({total} + {prior} * {terms} AS DECIMAL(20,0))")


class Audit:
    """The kept terms of each language and their counts by group, written once for both rankings."""

    def __init__(self, docs: DataFrame, least: int = LEAST, prior: int = PRIOR):
        counts = term_counts(docs)
        kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
            F.sum("n").alias("of_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        kept = stored(kept.select("lang", "term", "of_lang"), "kept-terms")
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("n_lang"))
        rows = stored(counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "kept-counts")
        groups = rows.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
        every = counts.where("term IS NULL").select("lang", "source")
        order = Window.partitionBy("lang").orderBy("source")
        #: ``lang, source, v, n_lang, n_group, place``: every group, kept terms of its language, occurrences, its place there
        self.groups = stored(
            every.join(langs, "lang", "left").join(groups, ["lang", "source"], "left").na.fill(0)
            .withColumn("place", F.row_number().over(order) - 1), "groups")
        #: ``lang, term, source, n, of_lang``: counts above 0
        self.counts = rows
        self.prior = prior

    def terms(self, top: int = TOP) -> DataFrame:
        """``lang, source, item, value, rank``: terms that are more probable in the group than in its language, up to
        rank ``top``, the largest difference first, ties in the order of their bytes."""
        cell = ["lang", "source", "n", "of_lang"]
        cells = self.counts.groupBy(*cell).agg(F.count(F.lit(1)).alias("times")).join(self.groups, ["lang", "source"])
        value = share("n", "n_group", "v", self.prior) - share("of_lang", "n_lang", "v", self.prior)
        cells = stored(cells.withColumn("value", value).where("value > 0").select(*cell, "times", "value"), "cells")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        values = cells.groupBy("lang", "source", "value").agg(F.sum("times").alias("times"))
        # a value has a term at least, so the first ``top`` values are enough; that limit holds before the shuffle
        values = values.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top)
        before = F.coalesce(F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        values = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
        wanted = stored(cells.drop("times").join(values, ["lang", "source", "value"]), "first-cells")
        inside = F.row_number().over(Window.partitionBy("lang", "source", "value").orderBy("item"))
        terms = self.counts.withColumnRenamed("term", "item").join(wanted, cell)
        return (
            terms.withColumn("inside", inside).where(F.col("inside") <= top)
            .withColumn("rank", (F.col("before") + F.col("inside")).cast("int")).where(F.col("rank") <= top)
            .select("lang", "source", "item", "value", "rank"))

    def _distances(self) -> DataFrame:
        """``lang, a, b, value`` for places a < b of sources: how much the sum of differences over all kept terms
        surpasses what it were if neither source had any."""
        blocks = F.greatest(F.ceil(F.col("v") / TERMS), F.lit(1)).cast("long")
        sides = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / SOURCES).cast("int")
        groups = stored(self.groups.where("v > 0").withColumns({"blocks": blocks, "sides": sides}), "sources")
        rows = self.counts.join(groups, ["lang", "source"]).select(
            "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "place", "sides", "term",
            share("n", "n_group", "v", self.prior).alias("p"))
        # in every block each source tells what it gives a term it doesn't have
        none = groups.withColumn("n", F.lit(0)).select(
            "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "place", "sides",
            F.lit(None).cast("string").alias("term"), share("n", "n_group", "v", self.prior).alias("p"))
        own = (F.col("place") / SOURCES).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("sides") - 1), lambda s: F.struct(F.least(s, own).alias("x"), F.greatest(s, own).alias("y")))
        spread = rows.unionByName(none).select("lang", "block", "place", "term", "p", F.inline(pairs))
        parts = spread.groupBy("lang", "block", "x", "y").applyInPandas(_block, "lang string, a int, b int, value long")
        return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    def pairs(self) -> DataFrame:
        """``lang, source, item, value, rank``: every other source of the language, the most distant first."""
        found = self._distances()
        both = stored(found.unionByName(found.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")), "distances")
        p = F.when(F.col("v") > 0, share("0", "n_group", "v", self.prior)).otherwise(0)
        own = self.groups.select("lang", "source", "v", F.col("place").alias("a"), p.alias("p"))
        other = self.groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), p.alias("q"))
        rows = own.join(other, "lang").where("a != b").join(both, ["lang", "a", "b"], "left")
        rows = rows.withColumn("value", F.coalesce("value", F.lit(0)) + F.col("v") * F.abs(F.col("p") - F.col("q")))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", "item", "value", "rank")


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """Between the sources of two blocks, or within one, and over one block of terms: by how much their differences
    surpass those of terms that neither has."""
    lang, x, y = rows["lang"].iloc[0], rows["x"].iloc[0], rows["y"].iloc[0]
    zero = rows[rows["term"].isna()].sort_values("place")
    held = rows[rows["term"].notna()]
    places = zero["place"].to_numpy()
    codes, terms = pd.factorize(held["term"])
    unheld = zero["p"].to_numpy(np.int64)
    p = np.repeat(unheld[:, None], len(terms), 1)
    p[np.searchsorted(places, held["place"].to_numpy()), codes] = held["p"].to_numpy(np.int64)
    side = places // SOURCES
    found = {"a": [], "b": [], "value": []}
    for k in np.flatnonzero(side == x):
        later = np.flatnonzero((side == y) & (places > places[k]))
        found["a"].append(np.full(len(later), places[k]))
        found["b"].append(places[later])
        none = np.abs(unheld[later] - unheld[k])
        found["value"].append((np.abs(p[later] - p[k]) - none[:, None]).sum(1))
    return pd.DataFrame({"lang": lang} | {name: np.concatenate(c).astype(np.int64) for name, c in found.items()})


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """What the registered query returns: ``lang, source, part, item, value, rank``, the part ``pair`` for
    other sources and ``term`` for terms.

    A group without terms, with texts that are NULL or empty, still has its pairs; so have all groups of a language without kept terms, at
    value 0 in the order of their names. Ids are not read, so repeated rows count as often as they occur. An
    empty table gives an empty table. Further columns are not read.
    """
    found = Audit(docs, least)
    parts = [(found.pairs(), "pair"), (found.terms(top), "term")]
    pair, term = (rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for rows, name in parts)
    return pair.unionByName(term)


# --- SQL counterpart ----------------------------------------------------------------

ORACLE = f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
words AS MATERIALIZED (
    SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS MATERIALIZED (
    SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST}),
langs AS MATERIALIZED (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
shares AS MATERIALIZED (
    SELECT lang, source, term, c, q,
           1 + CAST({UNIT} AS HUGEINT) * (c + {PRIOR}) // (sum(c) OVER (PARTITION BY lang, source) + {PRIOR} * v) AS p
    FROM (SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c, l.v,
                 1 + CAST({UNIT} AS HUGEINT) * (k.c + {PRIOR}) // (l.n + {PRIOR} * l.v) AS q
          FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
          LEFT JOIN counts n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term)),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(d.value, 0) AS value
    FROM groups g JOIN groups o ON o.lang = g.lang AND o.source <> g.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
               FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
               GROUP BY a.lang, a.source, b.source) d ON d.lang = g.lang AND d.source = g.source AND d.item = o.source),
every AS (
    SELECT * FROM pairs UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= {TOP}"""

ship(__name__)
