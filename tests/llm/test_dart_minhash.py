import numpy as np
import pytest

from fleetspark.llm import dart_minhash as dm
from tests.llm.conftest import prose


def exact_classes(rows, similar=0.8):
    """Smallest id in the class of each row, by comparing all pairs of rows; ids link nothing."""
    sets = [(t or "", dm.shingle_weights(dm.words_of(t))) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (s, x) in enumerate(sets):
        for j, (t, y) in enumerate(sets[:i]):
            if s == t or (len(x[0]) and len(y[0]) and dm.weighted_jaccard(x, y) >= similar):
                parent[root(i)] = root(j)
    named = {}
    for i, (id_, _) in enumerate(rows):
        named[root(i)] = min(named.get(root(i), (True, 0)), (id_ == dm.NO_ID, id_))
    return sorted((id_, named[root(i)][1]) for i, (id_, _) in enumerate(rows))


def changed(text, places, word="changed"):
    words = text.split()
    for p in places:
        words[p] = word
    return " ".join(words)


def found(docs):
    return sorted((r.id, r.class_id) for r in dm.near_duplicates(docs).collect())


def test_classes_equal_comparing_all_pairs(spark):
    rows, n = [], 0
    for seed in range(12):
        base = prose(seed, 150)
        variants = [base, base.upper(), changed(base, [3]), changed(base, [3, 70]), changed(base, [10, 60, 110]),
                    base + " " + prose(seed + 50, 20), prose(seed + 100, 150), changed(base, range(0, 150, 6))]
        for text in variants:
            rows.append((n, text))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == exact_classes(rows)


def test_a_large_group_and_chains(spark, monkeypatch):
    """One original with many changed copies, two thirds of all rows, and chains that link far ends."""
    base = prose(1, 120)
    rows = [(i, changed(base, [i % 113], f"w{i}")) for i in range(160)]
    rows += [(1000 + i, base) for i in range(60)]
    words = prose(5, 200).split()
    rows += [(2000 + i, " ".join(words[4 * i : 4 * i + 100])) for i in range(12)]
    rows += [(3000 + i, prose(300 + i, 80)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs) == exact_classes(rows)


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = [(dm.NO_ID if i is None else i, t) for i, t in odd_rows]
    assert found(odd_docs) == exact_classes(rows)
    assert dm.near_duplicates(no_docs).collect() == []
    shown = {r.doc_id: r.class_id for r in dm.classes(odd_docs).collect()}
    assert shown[6] == 1 and shown[2] == shown[3] == 2 and shown[5] == 5 and None in shown


def test_one_row_of_each_class_stays(odd_docs, odd_rows, no_docs):
    kept = dm.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 4, 5, 7, 8, None, 9, 10, 11, 13], key=str)
    assert dm.keep_one(no_docs).collect() == []


def test_copies_under_one_id_or_none_leave_one_row(spark):
    a, b = prose(61, 90), prose(62, 90)
    rows = [(None, a, k) for k in range(9)] + [(5, b, k) for k in range(7)] + [(None, b, 7), (5, prose(63), 0), (None, prose(64), 0), (4, changed(b, [40]), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    runs = [sorted(map(repr, dm.keep_one(docs.repartition(n)).collect())) for n in (3, 5)]
    kept = dm.keep_one(docs).collect()
    assert runs[0] == runs[1] == sorted(map(repr, kept))
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, a), (4, changed(b, [40])), (5, prose(63)), (0, prose(64))])


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rows = [(1, prose(1)), (1, prose(2)), (2, prose(2)), (3, prose(3)), (3, prose(1))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 3)]


@pytest.mark.parametrize("overlap", [0.5, 0.8, 0.95])
def test_agreement_estimates_the_weighted_similarity(overlap):
    rng = np.random.default_rng(int(overlap * 100))
    agree, exact = [], []
    for _ in range(60):
        items = rng.integers(0, 2**63, 200).astype(np.uint64)
        w = rng.integers(1, 4, 200)
        both = rng.random(200) < overlap
        x = (items, w)
        y = (np.where(both, items, items + np.uint64(1)), np.where(rng.random(200) < 0.9, w, w + 1))
        x, y = ((i[np.argsort(i)], v[np.argsort(i)]) for i, v in (x, y))
        agree.append((dm.darts(*x) == dm.darts(*y)).mean())
        exact.append(dm.weighted_jaccard(x, y))
    assert np.mean(agree) == pytest.approx(np.mean(exact), abs=0.015)


def test_small_sets_fill_all_coordinates():
    for n in (1, 2, 7):
        assert (dm.darts(np.arange(1, n + 1, dtype=np.uint64), np.ones(n, np.int64)) > 0).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 600)], "a long, b long")
    got = dict(map(tuple, dm.components(edges).collect()))
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 600: 500}


def template_group(groups, background, pair, words=400, seed=3):
    """Texts of one template, two by two: all alike by about ``background``, the two of a pair by ``pair``.

    Words changed at the end break as many shingles as words, so a share of u changed words of n leaves
    a similarity of (1 - u) / (1 + u)."""
    rng = np.random.default_rng(seed)
    base = prose(seed, words).split()
    own, both = ((1 - s) / (1 + s) for s in (pair, background))
    rows = []
    for g in range(groups):
        for k in range(2):
            tail = [f"g{g}x{i}" for i in range(int(words * (both - own)))] + [f"g{g}k{k}y{i}" for i in range(int(words * own) - 4)]
            rows.append((len(rows), " ".join(base[: words - len(tail)] + tail)))
    return [rows[i] for i in rng.permutation(len(rows))]


def test_pairs_in_large_buckets_of_a_template(spark):
    rows = template_group(150, 0.75, 0.81)
    sets = dict((i, dm.shingle_weights(dm.words_of(t))) for i, t in rows)
    assert 0.7 < dm.weighted_jaccard(sets[0], sets[2]) < 0.8 <= dm.weighted_jaccard(sets[0], sets[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs) == sorted((i, i - i % 2) for i, _ in rows)


def test_texts_of_repeated_and_null_ids_keep_their_links(spark):
    a, b, c = "aaa " + prose(21, 120), prose(22, 120), prose(23, 120)
    rows = [(1, a), (1, b), (2, b), (3, changed(b, [60]))]
    rows += [(10, prose(24, 120)), (10, c), (11, changed(c, [50])), (12, changed(c, [90]))]
    assert a < b
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == exact_classes(rows)
    rows = [(None, prose(30 + i, 100)) for i in range(6)] + [(20 + i, changed(prose(30 + i, 100), [40])) for i in range(6)] + [(40, prose(40, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs) == exact_classes([(dm.NO_ID if i is None else i, t) for i, t in rows])


def mixed_group():
    """A settled group of near copies with outsiders: far ones, ones just below and just above the similarity, and a
    second group that only one of its members links to."""
    base = prose(70, 300).split()
    cut = lambda n, mark: " ".join(base[: 300 - n] + [f"{mark}{i}" for i in range(n)])
    rows = [(i, " ".join(base[: 290] + [f"n{i}x{j}" for j in range(10)])) for i in range(80)]
    rows += [(200, cut(60, "far")), (201, cut(45, "below")), (202, cut(24, "above")), (203, prose(71, 300))]
    rows += [(300 + i, " ".join(base[: 230] + [f"h{j}" for j in range(60)] + [f"m{i}x{j}" for j in range(10)])) for i in range(20)]
    rows += [(400, " ".join(base[: 262] + [f"h{j}" for j in range(38)]))]
    return rows


def test_outsiders_of_a_settled_group(spark, monkeypatch):
    rows = mixed_group()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = exact_classes(rows)
    assert len({c for _, c in want}) >= 3
    assert found(docs) == want
    monkeypatch.setattr(dm, "MASS", 900)  # units of three documents
    monkeypatch.setattr(dm, "BLOCK", 4)
    assert found(docs) == want


def test_unit_links_are_those_of_all_pairs(spark):
    rows = mixed_group()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = docs.selectExpr("doc_id AS node", "text")
    signed = dm.sign(docs).selectExpr("id AS node", "sig")
    labels = nodes.selectExpr("node", "CASE WHEN node < 200 THEN 0 WHEN node BETWEEN 300 AND 399 THEN 300 ELSE node END AS component")
    got = dm.remaining_links(labels, nodes, signed, 0.8).collect()
    sets = {i: dm.shingle_weights(dm.words_of(t)) for i, t in rows}
    part = {r.node: r.component for r in labels.collect()}
    want = {tuple(sorted((part[i], part[j]))) for i in sets for j in sets
            if part[i] < part[j] and dm.weighted_jaccard(sets[i], sets[j]) >= 0.8}
    assert want and {tuple(sorted((part[r.a], part[r.b]))) for r in got} == want
    assert all(dm.weighted_jaccard(sets[r.a], sets[r.b]) >= 0.8 for r in got)
