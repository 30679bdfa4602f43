import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetspark.llm import decontaminate as dc
from tests.llm.conftest import prose

WORD = re.compile(r"[^\W_]+")


def shingles(words, k):
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(docs, items, similar=0.8):
    """Best window of each item in each document, over windows at every word."""
    out = {}
    for i, text in docs:
        words = WORD.findall((text or "").lower())
        for j, item in items:
            own = WORD.findall((item or "").lower())
            if not own or not words:
                continue
            k, n = min(5, len(own)), len(own)
            want = shingles(own, k)
            for at in range(max(1, len(words) - n + 1)):
                got = shingles(words[at : at + n], k)
                value = (got & want).total() / (got | want).total()
                if value >= similar and value > out.get((i, j), (0, 0))[0]:
                    out[i, j] = value, at
    return {(i, j, round(v, 9), at) for (i, j), (v, at) in out.items()}


def found(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id, round(r.similarity, 9), r.start_word) for r in dc.leaked_pairs(docs, items).collect()}


ITEMS = [
    (1, prose(101, 40)), (2, prose(102, 25)), (3, "Three short words"), (4, "one"), (5, None), (6, " ?! "), (7, prose(107, 6)),
    (8, "again again again again again again again again"), (9, prose(102, 25)), (10, prose(110, 90)),
]


def edited(text, at, word="edit"):
    words = text.split()
    words[at] = word
    return " ".join(words)


DOCS = [
    (1, prose(1, 50) + "\n" + prose(101, 40) + "\n" + prose(2, 30)), (2, prose(102, 25).upper()), (3, prose(3, 80)),
    (4, "these, three; SHORT words! end"), (5, None), (6, ""), (7, "x one y"), (8, prose(101, 40).replace(" ", " - ")),
    (9, edited(prose(101, 40), 0) + " tail"), (10, edited(prose(101, 40), 20)), (11, " ".join(prose(101, 40).split()[:20])),
    (12, "so again again again again again again again again so"), (13, edited(prose(110, 90), 44) + " " + prose(13, 40)),
    (14, prose(14, 300) + " " + edited(edited(prose(110, 90), 3), 80)), (15, prose(107, 6)),
]


def test_leaks_equal_brute_force(spark):
    assert found(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_pairs_do_not_depend_on_the_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, prose(1)), (None, prose(9)), (2, None), (3, "one"), (1, prose(1))], "item_id long, text string")
    rows = sorted(map(tuple, dc.leaked_pairs(odd_docs, items).collect()), key=repr)
    assert rows == sorted([(1, 1, 1.0, 0), (6, 1, 1.0, 0), (None, None, 1.0, 0), (10, 3, 1.0, 0), (8, 1, 1.0, 200), (8, None, 1.0, 1800)], key=repr)
    kept = dc.drop_leaked(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 5
    assert dc.leaked_pairs(no_docs, items).collect() == []
    none = items.limit(0)
    assert dc.leaked_pairs(odd_docs, none).collect() == [] and dc.drop_leaked(odd_docs, none).count() == odd_docs.count()


def test_blocks_miss_nothing_within_the_radius(spark):
    import random

    random.seed(4)
    rows = []
    for _ in range(300):
        a = random.getrandbits(64) - 2**63
        flips = random.sample(range(64), random.randint(0, dc.RADIUS))
        b = a
        for f in flips:
            b ^= -(2**63) if f == 63 else 1 << f
        rows.append((a, b))
    both = spark.createDataFrame(rows, "a long, b long").select(
        F.arrays_overlap(dc.blocks(F.col("a")), dc.blocks(F.col("b"))).alias("hit"))
    assert both.where("hit").count() == 300


def test_simhash_is_the_sign_of_the_sums(spark):
    hashes = [5, -7, 123456789, -(2**62), 5]
    want = 0
    for b in range(64):
        if sum(1 if (h >> b) & 1 else -1 for h in hashes) > 0:
            want |= 1 << b
    want -= 2**64 if want >= 2**63 else 0
    frame = spark.createDataFrame([(hashes,)], "h array<bigint>")
    assert frame.select(dc.simhash(F.col("h")).alias("c")).first().c == want


def test_no_python_in_the_plan(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = dc.leaked_pairs(odd_docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_insertions_with_cut_ends_equal_brute_force(spark):
    """Passages with words cut at both ends and others put in the middle: no shingle's shift is the best start."""
    items, docs = [], []
    for j, (n, cut, added) in enumerate([(100, 2, 5), (150, 2, 11), (300, 2, 27), (100, 1, 7), (150, 3, 8), (60, 2, 2)]):
        item = " ".join(f"{w}{j}n{i}" for i, w in enumerate(prose(400 + j, n).split()))
        words = item.split()[cut : n - cut]
        middle = len(words) // 2
        words[middle:middle] = [f"new{i}" for i in range(added)]
        items.append((j, item))
        docs.append((j, prose(500 + j, 37) + " " + " ".join(words) + " " + prose(600 + j, 41)))
    assert len(brute(docs, items)) >= 3
    assert found(spark, docs, items) == brute(docs, items)


def test_benchmark_with_columns_of_clashing_names(spark):
    items = spark.createDataFrame([(*r, "x", 1, 2, "h") for r in ITEMS], "item_id long, text string, words string, n int, id int, hash string")
    docs = spark.createDataFrame([(*r, 3, "y", 4) for r in DOCS], "doc_id long, text string, item int, code string, start int")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9), r.start_word) for r in dc.leaked_pairs(docs, items).collect()}
    assert got == brute(DOCS, ITEMS)
    assert dc.drop_leaked(docs, items).columns == docs.columns
