import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fleetspark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def tokens_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, window=2048):
    """Every id of every document lies in one piece, and every sequence is gapless."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, bytes(r.ids)))
    got = Counter()
    for (doc_id, total), parts in pieces.items():
        whole = b"".join(p[2] for p in sorted(parts))
        assert sum(p[1] for p in parts) % total == 0
        got[doc_id, whole] += 1
    want = Counter()
    for doc_id, text in texts:
        want[doc_id, np.array(tokens_of(text), "<u4").tobytes()] += 1
    sequences = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= window and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return got, want, sequences


def test_round_trip(spark):
    texts = [(i, t) for i, t in enumerate(["one two", None, "", "naïve café " * 700, "x" * 30000, "汉字 😀 <|endoftext|> end", "  \n\n a\t b \x0b"])]
    rows = packing.pack_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got, want, _ = check(rows, texts)
    assert got == want


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert sum(r.start == 0 for r in rows) == odd_docs.count()
    assert packing.pack_documents(no_docs).collect() == []


def test_little_padding_and_whole_sequences(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").coalesce(1)
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    pieces = packing.pack_documents(docs)
    got, want, sequences = check(pieces.collect(), texts)
    assert got == want
    filled = [sum(n for _, n in parts) for parts in sequences.values()]
    assert len(filled) <= -(-sum(filled) // 2048) + 1 and filled.count(2048) > 0.8 * len(filled)
    for r in packing.sequences(pieces, pad=7).limit(5).collect():
        assert len(r.ids) == 2048 * 4
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.packed_digests(docs).collect()}
    doc_id, text = texts[0]
    assert crc[doc_id, 0] == zlib.crc32(np.array(tokens_of(text)[:2048], "<u4").tobytes())


def test_fast_and_plain_tokenizer_agree():
    with open(PATH, encoding="utf-8") as file:
        encode = packing.Encoder(file.read(), public_tokenizers.PATTERN)
    assert encode.fast is not None
    plain = Tokenizer.from_file(PATH)
    points = [c for c in range(1, 0x590)]
    texts = ["".join(map(chr, points[i : i + 40])) for i in range(0, len(points), 17)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 '{chr(c)}s  {chr(c)} \n{chr(c)}\n" for c in points]
    texts += ["<|endoftext|> a <|endoftext|><|endoftext|>b", "汉字 and “quotes” …", "֐  　x"]
    for text in texts:
        assert encode(text) == plain.encode(text, add_special_tokens=False).ids, repr(text)


@given(st.lists(st.integers(1, 30), min_size=1, max_size=9), st.integers(30, 40))
@settings(max_examples=200, deadline=None)
def test_fullest_is_the_best_subset(lengths, capacity):
    counts = Counter(lengths)
    chosen = packing.fullest(dict(counts), capacity)
    assert all(n <= counts[k] for k, n in chosen.items()) and chosen[max(lengths)] >= 1
    rest = sorted(lengths)[:-1]
    best = max(
        max(lengths) + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k) if max(lengths) + sum(c) <= capacity)
    assert sum(k * n for k, n in chosen.items()) == best


@given(st.lists(st.integers(1, 100), max_size=60))
@settings(max_examples=100, deadline=None)
def test_plan_uses_every_length_once(lengths):
    used = Counter()
    for chosen, times in packing.pack_lengths(dict(Counter(lengths)), 100):
        assert sum(k * n for k, n in chosen.items()) <= 100 and times > 0
        for k, n in chosen.items():
            used[k] += n * times
    assert used == Counter(lengths)
