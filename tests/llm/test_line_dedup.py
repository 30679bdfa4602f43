import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

from fleetspark.llm import line_dedup
from fleetspark.llm.catalog import ORACLE, QUERIES

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
REPEATED = "A line that stands in many of the documents"


def key(line):
    return line.strip(WHITE).translate(LOWER)


def brute(rows):
    """(id, lines, dropped, kept text) of every row."""
    holders = defaultdict(set)
    rank = lambda i: float("-inf") if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def rows(odd_rows):
    more = [
        (20, REPEATED), (21, f"  {REPEATED.upper()}\t\nown line of this document"), (22, f"{REPEATED}\n{REPEATED}\nend"),
        (23, f"a\n{REPEATED} \nb\n"), (24, "short\nshort"), (25, "short"), (26, "short"),
        (27, "ÀLINE with letters beyond ascii x"), (28, "àline with letters beyond ascii x"), (29, "ÀLINE with letters beyond ascii x"),
        (30, "Two holders only of this line"), (31, "Two holders only of this line"), (31, "Two holders only of this line"),
    ]
    return odd_rows + more


def test_digests_equal_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, line_dedup.line_digests(docs).collect()))
    assert got == Counter(brute(rows))


def test_texts_and_other_columns(spark, odd_docs, rows):
    assert line_dedup.dedup_lines(odd_docs).columns == odd_docs.columns
    docs = spark.createDataFrame([(i, t, -1) for i, t in rows], "doc_id long, text string, n_chars int")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert out[2].text is None and out[2].n_chars == -1
    assert (out[20].text, out[20].n_chars) == ("", 0)
    assert (out[21].text, out[21].n_chars) == ("own line of this document", 25)
    assert out[22].text == f"{REPEATED}\n{REPEATED}\nend"  # the largest id keeps all of them


def test_empty_table(no_docs):
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_query_equals_its_sql(spark, sf):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = duck.sql(ORACLE["op10_line_dedup"])
    got = QUERIES["op10_line_dedup"](spark, sf).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_no_python_in_the_plan(spark, odd_docs):
    plan = line_dedup.line_digests(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
