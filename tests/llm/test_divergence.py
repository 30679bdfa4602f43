import random
import re
from collections import Counter

import duckdb
import pytest

from fleetspark.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top=50):
    """The same by loops: ``rows`` of (text, lang, source)."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(ASCII))) for text, lang, source in rows]
    out = Counter()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in held.items() if n >= least}
        count = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        whole = sum(count.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))  # noqa: B023, E731
        for s, c in count.items():
            pairs = [(-sum(abs(p(c, t) - p(o, t)) for t in kept), x.encode(), x) for x, o in count.items() if x != s]
            terms = [(-(p(c, t) - p(whole, t)), t.encode(), t) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, _, item) in enumerate(sorted(found)[:limit], 1):
                    out[lang, s, part, item, -value, rank] += 1
    return out


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return Counter(map(tuple, df.collect()))


def table(spark, rows):
    return spark.createDataFrame(
        [(k % 7 or None, *r, 0, "t", 1, 2) for k, r in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long, term string, n long, value long").repartition(3)


@pytest.fixture(scope="module")
def odd():
    make = random.Random(3)
    words = ["Alpha", "beta", "É", "über", "汉字", "😀", "x", "߿z", "ﬀ", "b`c", "d\x7fe", "GAMMA", "gamma", "Ä"] + [f"w{c}" for c in "abcdefghijklmnop"]
    rows = []
    for _ in range(160):
        text = make.choice([" ", "\n", "7", ", "]).join(make.choices(words, weights=range(len(words), 0, -1), k=make.randrange(0, 30)))
        rows.append((make.choice([text, text, text, None, "", "?!"]), make.choice(["en", "de", None]), make.choice(["s1", "s2", "ſ", None, "s10"])))
    rows += [rows[5]] * 9 + [("one two " * 2000, "en", "s1"), ("x y", "fr", "only"), (None, "it", "a"), ("", "it", "b"), ("q", "it", "c")]
    return rows


@pytest.mark.parametrize("least, top", [(30, 50), (4, 50), (4, 3), (1, 5)])
def test_equals_loops(spark, odd, least, top):
    assert got(divergence.audit(table(spark, odd), least, top)) == plain(odd, least, top)


def test_many_blocks_of_terms_and_sources(spark, odd, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 5)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    assert got(divergence.audit(table(spark, odd), 4)) == plain(odd, 4)


def test_a_worker_hands_counts_on_when_they_are_many(spark, odd, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    assert got(divergence.audit(table(spark, odd), 4)) == plain(odd, 4)


def test_counts_beyond_64_bits(spark):
    c, total, v = 4 * 10**15, 9 * 10**15, 10**7
    row = spark.createDataFrame([(c, total, v)], "c long, t long, v long").select(divergence.share("c", "t", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (c + 5) // (total + 5 * v)


def test_equals_sql(spark, sf):
    sf = sf.replace("0.001", "0.01")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = Counter(con.execute(divergence.ORACLE).fetchall())
    assert want and got(divergence.audit(spark.read.parquet(f"{sf}/documents.parquet"))) == want


def test_empty_table(spark):
    assert got(divergence.audit(table(spark, [("x", "en", "s")]).limit(0))) == Counter()
