import numpy as np

from fleetspark.llm import quality


def test_held_out_accuracy(spark, sf):
    d = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97  # area under the curve


def test_odd_rows(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 0), (3, 1), (4, 0), (5, 0), (6, 1), (7, 1), (8, None), (None, 0), (99, 1), (9, 7)], "doc_id long, quality int")
    rows = quality.score_documents(odd_docs, labels).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    score = {}
    for r in rows:
        assert score.setdefault(r.doc_id, r.score) == r.score or r.doc_id is None  # repeated rows score alike
    assert score[1] == score[6] and not any(r.held_out for r in rows if r.doc_id is None)


def test_held_out_labels_teach_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    a, b = (sorted(quality.score_documents(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_no_labels_and_no_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_documents(odd_docs, none).collect()} == {0.5}
    assert quality.score_documents(no_docs, none).collect() == []


def test_kept_rows_are_whole(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_good(odd_docs, none, threshold=0.5)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert quality.keep_good(odd_docs, none, threshold=0.6).count() == 0


def test_tables_add_up_to_the_boosted_model():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no feature alone, only the pair
    model = quality.fit(x, y)
    assert {0, 1} in [set(p) for p in model.pairs]
    assert np.mean((model.score(x) > 0.5) == y) > 0.95


def test_scores_equal_looking_up_every_table(spark, sf):
    """The query against loops: features, fit on the rows that may teach, one table after the other."""
    import math
    import zlib

    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    text = {r.doc_id: r.text for r in docs.collect()}
    taught = [(i, q) for i, q, _ in labels.collect() if zlib.crc32(str(i).encode()) % 4 != 2 and i in text and q in (0, 1)]
    x = np.array([quality.text_features(text[i]) for i, _ in taught])
    y = np.array([q for _, q in taught], float)
    order = np.lexsort([*x.T, y])
    model = quality.fit(x[order], y[order])
    for r in quality.score_documents(docs, labels).collect():
        row = quality.text_features(text[r.doc_id])
        total = model.base
        for value, edges, table in zip(row, model.edges, model.tables):
            total += table[sum(e <= value for e in edges)]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(e <= row[a] for e in model.pair_edges[a]), sum(e <= row[b] for e in model.pair_edges[b])]
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_labels_with_columns_of_clashing_names(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    more = labels.selectExpr("*", "'t' AS text", "0.5 AS score", "1 AS x", "'en' AS lang")
    a, b = (sorted(quality.score_documents(docs, x).collect()) for x in (labels, more))
    assert a == b
