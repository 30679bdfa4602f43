import hashlib
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from fleetspark.llm import syncmers
from tests.llm.conftest import prose

WHITE = " \t\n\x0b\x0c\r"


def chained(values, seed=42):
    """The hash of Spark's xxhash64 over long columns."""
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed -= 2**64 if seed >= 2**63 else 0
        seed &= 2**64 - 1
    return seed - 2**64 if seed >= 2**63 else seed


def word_hash(word):
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def sketch(text):
    import re

    trimmed = text.strip(WHITE)
    if not trimmed:
        return []
    h = [word_hash(w) for w in re.split("[\x20\x09-\x0d]+", trimmed)]
    inner = [chained(h[i : i + 2]) for i in range(len(h) - 1)]
    mask = (1 << 48) - 1
    found = []
    for i in range(len(h) - 4):
        at = inner[i : i + 4]
        if min(at) in (at[0], at[-1]):  # the smallest stands at an edge
            found.append(chained([at[0], at[2], h[i + 4]]) & mask)
    found = found or [chained(h) & mask]
    kept = set(sorted(set(found))[:64])
    return [x for x in dict.fromkeys(found) if x in kept]


def longest_run(places):
    best = []
    for k, p in enumerate(places):
        best.append(1 + max((best[j] for j in range(k) if places[j] < p), default=0))
    return max(best, default=0)


def likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    top = sorted(set(a) | set(b))[:64]
    return longest_run([b.index(x) for x in a if x in b and x in top]) / len(top)


def brute(rows):
    number = lambda i: float("-inf") if i is None else i
    of_id = {}
    for i, text in rows:  # the row with the smallest hash stands for its id
        of_id.setdefault(number(i), []).append((word_hash(text or ""), text or ""))
    ids = sorted(of_id)
    out = []
    for i, text in rows:
        text, after = text or "", min(of_id[ids[(ids.index(number(i)) + 1) % len(ids)]])[1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = sketch(text), sketch(edited), sketch(after)
        show = lambda s: "".join(f"{x:012x}" for x in s)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), likeness(a, b), likeness(a, c)))
    return out


@pytest.mark.parametrize("range_docs", [2048, 3])
def test_fingerprints_equal_brute_force(odd_docs, odd_rows, monkeypatch, range_docs):
    monkeypatch.setattr(syncmers, "RANGE_DOCS", range_docs)
    got = [tuple(r) for r in syncmers.fingerprint_documents(odd_docs).collect()]
    assert Counter(got) == Counter(brute(odd_rows))


def test_many_ranges_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_DOCS", 7)
    rows = [(i * i * 31, prose(i, 5)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted(tuple(r) for r in syncmers.with_next(docs, "doc_id", "text", {"text": F.col("text")}).collect())
    order = sorted(rows)
    assert got == sorted((*r, order[(k + 1) % len(order)][1]) for k, r in enumerate(order))


def test_a_hot_id_is_dealt_to_many_tasks(spark, monkeypatch):
    """A third of the rows share one id, another third have none: they stay where they were read."""
    monkeypatch.setattr(syncmers, "RANGE_DOCS", 100)
    ids = [None if i % 3 == 0 else 500 if i % 3 == 1 else 1000 + i for i in range(1800)]
    rows = [(i, f"text {k % 700} of many") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = syncmers.fingerprint_documents(docs)
    assert Counter(tuple(r) for r in out.collect()) == Counter(brute(rows))
    hot = out.where("doc_id IS NULL OR doc_id = 500").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    assert max(r["n"] for r in hot.collect()) <= 2 * 1200 / 8


def test_order_counts(spark):
    a, b = prose(81, 60), prose(82, 60)
    frame = spark.createDataFrame([(f"{a} {b}", f"{b} {a}", f"{a} {b} {b}")], "x string, y string, z string")
    x, y, z = (syncmers.sketch(F.col(c)) for c in "xyz")
    row = frame.select(syncmers.likeness(x, y).alias("swapped"), syncmers.likeness(x, z).alias("longer"), syncmers.likeness(y, y).alias("same")).first()
    want = [likeness(sketch(f"{a} {b}"), sketch(t)) for t in (f"{b} {a}", f"{a} {b} {b}")]
    assert [row.swapped, row.longer] == want and row.swapped < 0.6 < row.longer and row.same == 1.0


def test_one_row_follows_itself(spark):
    row = syncmers.fingerprint_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a a").hexdigest()


def test_empty_table(no_docs):
    assert syncmers.fingerprint_documents(no_docs).collect() == []


def test_half_a_text_is_like_it_and_others_are_not(spark, sf):
    rows = syncmers.fingerprint_documents(spark.read.parquet(f"{sf}/documents.parquet")).where("n_chars > 300").collect()
    assert sum(r.near_edited > 0.1 for r in rows) > 0.97 * len(rows)
    assert sum(r.near_next < 0.05 for r in rows) > 0.97 * len(rows)


def test_no_python_in_the_plan(odd_docs):
    plan = syncmers.fingerprint_documents(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
