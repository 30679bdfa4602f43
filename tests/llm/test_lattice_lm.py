import math
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetspark.llm import lattice_lm

PIECES = [b"a", b"b", b"ab", b"ba", b"abab", b"ababbaabab", b"ababbaababb", b"babbaabab"]


def every_cut(word):
    """All ways to cut a word in pieces."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in PIECES:
            for rest in every_cut(word[n:]):
                yield [word[:n], *rest]


def weight(lattice, cut):
    places = [lattice.INNER] * len(cut)
    places[0], places[-1] = lattice.FIRST, lattice.LAST
    places = [lattice.WHOLE] if len(cut) == 1 else places
    return math.exp(sum(lattice.logp[0, k, PIECES.index(p)] for k, p in zip(places, cut)))


@pytest.fixture
def lattice():
    made = lattice_lm.Lattice(PIECES, 1)
    made.learn(np.random.default_rng(3).random((1, 4, len(PIECES))))
    return made


@pytest.mark.parametrize("word", [b"a", b"ab", b"abab", b"ababbaab", b"bbbbbbbbbbb", b"ababbaabab", b"ababbaababbab", b"bababbaababb"])
def test_score_is_the_sum_over_all_cuts(lattice, word):
    rows = np.frombuffer(word, np.uint8)[None]
    assert math.exp(lattice.scores(rows)[0, 0]) == pytest.approx(sum(weight(lattice, c) for c in every_cut(word)))


def test_expected_counts_are_those_of_all_cuts(lattice):
    word = b"ababbaababba"
    total = np.zeros((4, len(PIECES)))
    lattice.expected(np.frombuffer(word, np.uint8)[None], 0, total)
    cuts = list(every_cut(word))
    share = np.array([weight(lattice, c) for c in cuts])
    share /= share.sum()
    want = np.zeros(len(PIECES))
    for s, cut in zip(share, cuts):
        for piece in cut:
            want[PIECES.index(piece)] += s
    assert total.sum(0) == pytest.approx(want)


def test_every_piece_of_the_vocabulary_is_an_arc():
    import json

    path = lattice_lm.public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        names = {n.removesuffix("</w>") for n in json.load(file)["model"]["vocab"]}
    pieces = lattice_lm.read_pieces(path)
    assert len(pieces) == len(names) == 40_986 and max(map(len, pieces)) > 20
    made = lattice_lm.Lattice(pieces, 1)
    for rows, at in lattice_lm.by_length(pieces):  # each piece is an arc from end to end of itself as a word
        whole, kind = made.edges(rows)[rows.shape[1]]
        assert (whole[:, 0] == at).all() and (kind == [made.WHOLE]).all()


def test_probabilities_of_words_add_up_to_one():
    made = lattice_lm.Lattice([b"a", b"b", b"ab"], 1)
    made.learn(np.array([[[2, 1, 1], [0.2, 0.1, 0.1], [2, 2, 1], [5, 5, 9]]], float))
    words = [format(i, f"0{n}b").replace("0", "a").replace("1", "b").encode() for n in range(1, 13) for i in range(2**n)]
    total = sum(np.exp(made.scores(rows)).sum() for rows, _ in lattice_lm.by_length(words))
    assert total == pytest.approx(1, abs=1e-3)


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def test_counts_and_base_equal_brute_force(odd_docs, odd_rows, no_docs):
    taught = Counter(t for i, text in odd_rows if not held_out(i) for t in tokens(text))
    n, v = taught.total(), len(taught)
    want = sorted(
        (str(i), held_out(i), len(tokens(x)), sum(t in taught for t in tokens(x)), n,
         round(sum(math.log10((taught[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 6))
        for i, x in odd_rows)
    rows = lattice_lm.score_documents(odd_docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(-math.inf < r.score < 0 for r in rows)
    assert lattice_lm.score_documents(no_docs).collect() == []


def test_rare_words_by_join_score_like_frequent_ones(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    run = lambda: {r.doc_id: r for r in lattice_lm.score_documents(docs).collect()}
    many = run()
    monkeypatch.setattr(lattice_lm.frequent_words, "__defaults__", (30,))
    few = run()
    assert many.keys() == few.keys()
    for k, r in many.items():
        assert r.n_known == few[k].n_known
        assert r.score == pytest.approx(few[k].score) and r.base_score == pytest.approx(few[k].base_score)


def test_texts_left_out_score_better_than_by_words(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = [r for r in lattice_lm.score_documents(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
