import numpy as np

from fleetspark.llm import language_mix


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = language_mix.identify_documents(docs).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 150 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 and abs(sum(r.shares) - 1) < 1e-6 for r in rows)


def test_a_text_in_two_languages(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    names, like = language_mix.train(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) BETWEEN 900 AND 1500").collect()}
    mixed = texts["de"][:800] + "\n" + texts["fr"][:400]
    chosen, shares = language_mix.identify(like, mixed)
    assert [names[i] for i in chosen] == ["de", "fr"]
    assert abs(shares[0] - 2 / 3) < 0.1


def test_mixture_finds_the_best_likelihood():
    rng = np.random.default_rng(2)
    like = rng.dirichlet(np.full(40, 0.3), 2).T + 1e-6
    counts = rng.multinomial(3000, like @ [0.7, 0.3] / (like @ [0.7, 0.3]).sum()).astype(float)
    shares, value = language_mix.mixture(like, counts)
    grid = [float(counts @ np.log(like @ [p, 1 - p])) for p in np.linspace(0.01, 0.99, 99)]
    assert value > max(grid) - 0.5 and abs(shares[0] - 0.7) < 0.05


def test_odd_rows(odd_docs, odd_rows, no_docs, spark):
    rows = language_mix.identify_documents(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    none = {i for i, t in odd_rows if not any(c.isalpha() for c in t or "")} - {None}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} - {None} == none
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language_mix.identify_documents(no_docs).collect() == []
    nothing = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_mix.identify_documents(nothing).first().lang_pred == "und"


def test_held_out_languages_teach_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lied = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS string)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    run = lambda d: sorted((r.doc_id, r.lang_pred, r.score) for r in language_mix.identify_documents(d).collect())
    assert run(docs) == run(lied)


def penalised(like, text):
    """The best set of languages by trying all, each with shares fitted to the end."""
    from itertools import combinations

    bins, counts = language_mix.trigram_counts(text)
    rows, found = like[bins], []
    for size in range(1, like.shape[1] + 1):
        for chosen in combinations(range(like.shape[1]), size):
            share = np.full(size, 1 / size)
            for _ in range(400):
                joint = rows[:, chosen] * share
                share = (counts / joint.sum(1)) @ joint / counts.sum()
            value = float(counts @ np.log(rows[:, chosen] @ share)) / language_mix.OVERLAP
            found.append((value - (size - 1) * (language_mix.PENALTY + 0.5 * np.log(counts.sum())), chosen, share))
    return max(found, key=lambda f: f[0])[1:]


def test_the_chosen_set_is_the_best_of_all_sets(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    names, like = language_mix.train(docs)
    rows = docs.where("length(text) BETWEEN 700 AND 4000").orderBy("doc_id").limit(40).collect()
    texts = [r.text for r in rows]
    texts += [a.text[:600] + " " + b.text[:700] for a, b in zip(rows[::2], rows[1::2])]
    texts += [" ".join(r.text[:500] for r in rows[k : k + 3]) for k in range(8)]
    sizes = set()
    for text in texts:
        chosen, shares = language_mix.identify(like, text)
        want, share = penalised(like, text)
        assert set(chosen) == set(want)
        assert np.allclose(sorted(shares), sorted(share), atol=0.03)
        sizes.add(len(chosen))
    assert {1, 2} <= sizes
