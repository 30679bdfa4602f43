import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from fleetspark.llm import byte_bpe


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, rows):
    out = Counter()
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest()] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


@pytest.mark.parametrize("chunk, overlap", [(byte_bpe.CHUNK, byte_bpe.OVERLAP), (40, 16), (7, 5)])
def test_odd_rows_equal_the_library(odd_docs, odd_rows, library, chunk, overlap):
    assert got(byte_bpe.round_trips(odd_docs, chunk=chunk, overlap=overlap)) == wanted(library, odd_rows)


def test_any_characters_in_small_chunks(spark, library):
    make = random.Random(11)
    parts = ["a", "é", "'s", "'", "'re", " ", "  ", "\n", "\t \n", "7", "½", "!", "...", "汉字", "😀", "ʼ", "\x1c", " ", "ſ", "՘", "<|endoftext|>"]
    rows = [(i, "".join(make.choices(parts, k=make.randrange(1, 90)))) for i in range(300)]
    rows += [(1000, "x" * 90 + " y"), (1001, " " * 90 + "z"), (1002, "'" * 70 + "s" * 70), (1003, "՘'st" * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(byte_bpe.round_trips(docs, chunk=12, overlap=8)) == wanted(library, rows)


def test_ids_and_bytes_themselves(spark, library):
    rows = [(1, "Ein Text, it's " * 40), (2, None), (1, "Ein Text, it's " * 40)]
    out = byte_bpe.decode(byte_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), chunk=50, overlap=20)).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.raw)) for r in out) == Counter(
        (i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


def test_long_white_space(library):
    codec = byte_bpe.Codec(byte_bpe._content(None), public_tokenizers.PATTERN)
    for text in ("a" + " " * 30000 + "b", "\n" * 25000, "a\n" + "\n" * 25000 + " b" + " " * 40000 + "!" + "\t" * 20000):
        assert codec.encode(text) == library.encode_ordinary(text)
    more = " " * 2_000_000  # more than the library's pattern engine can take
    assert codec.decode(codec.encode(more + "b")) == more.encode() + b"b"


def test_one_pretoken_over_many_chunks(spark, library):
    rows = [(1, "ab " * 30 + "w" * 1000 + " cd" * 30 + "v" * 500), (2, "9" * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(byte_bpe.round_trips(docs, chunk=64, overlap=16)) == wanted(library, rows)


def test_settled_characters_have_one_class():
    """Both pattern engines put each character of ``_SETTLED`` into the same class."""
    import regex

    settled = [c for c in map(chr, range(0x80, 0xE000 - 0x800)) if byte_bpe._SETTLED.fullmatch("a" + c)]
    known = sorted({c.encode()[:k] for c in settled for k in range(2, 4) if k <= len(c.encode())}, key=lambda x: (len(x), x))
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {x: 256 + k for k, x in enumerate(known)}
    leads = "a1!\t"
    ranks |= {(lead + c).encode(): len(ranks) + k for k, (lead, c) in enumerate((x, c) for x in leads for c in settled)}
    joined = tiktoken.Encoding("joined", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = regex.compile(public_tokenizers.PATTERN)
    for lead in leads:
        for c in settled:
            assert (len(joined.encode_ordinary(lead + c)) == 1) == (len(own.findall(lead + c)) == 1), (lead, hex(ord(c)))


def test_empty_table(no_docs):
    df = byte_bpe.round_trips(no_docs)
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and df.collect() == []
