"""Byte-level BPE encoding and decoding of whole texts by a rank file.

A text of more than one chunk is cut into overlapping chunks that are split into pre-tokens apart from
each other, in tasks of their own. Where two neighbours have a pre-token boundary in common in their
overlap they have resynchronised; there they are stitched, and the pieces between stitches are encoded. Shorter texts
are one piece. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from fleetspark.llm.common import digest, ship, stored, whole_text

RANKS = "byte_bpe_multi_50k.tiktoken"
#: code points of a chunk, and how far it reaches into the next one
CHUNK, OVERLAP = 16_384, 256
#: encoded rows that leave a worker at once
ROWS = 512
#: the library's pattern engine overflows its stack on some hundred thousand white-space characters in a row
_BLANKS = re.compile(r"\s{20000,}")
#: two characters that every version of Unicode puts into the same classes, the first neither white space nor an
#: apostrophe, as what follows those decides how the match before ends
_SETTLED = re.compile(
    "(?![\\s'])[\x00-ԯぁ-ゖァ-ヺ一-龥가-힣]{2}")


# --- one text ---------------------------------------------------------------------


class Codec:
    """Ids and bytes by a rank file's content, as the ``tiktoken`` library gives them."""

    def __init__(self, content: bytes, pattern: str):
        import regex
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pretokens = regex.compile(pattern)
        self.library = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, piece: str) -> list[int]:
        """A run of white space before something else is one pre-token without its last character; long ones
        are taken out and encoded as such."""
        ids, done = [], 0
        for blank in _BLANKS.finditer(piece):
            end = blank.end() if blank.end() == len(piece) else blank.end() - 1
            ids += self.library.encode_ordinary(piece[done : blank.start()])
            ids += self.library._encode_single_piece(piece[blank.start() : end])
            done = end
        return ids + self.library.encode_ordinary(piece[done:])

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def boundaries(self, text: str) -> list[int]:
        """Where a pre-token of ``text`` starts, its first place among them."""
        return [match.start() for match in self.pretokens.finditer(text)]


def _codec(content: bytes, pattern: str) -> Codec:
    """One per worker process; it outlives the task on ``sys``."""
    kept = sys.__dict__.setdefault("_llm_codecs", {})
    if (content, pattern) not in kept:
        kept[content, pattern] = Codec(content, pattern)
    return kept[content, pattern]


def cut(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    """Start and text of the overlapping chunks; the last one reaches the end."""
    start = 0
    while start + chunk + overlap < len(text):
        yield start, text[start : start + chunk + overlap]
        start += chunk
    yield start, text[start:]


def _settled(text: str, place: int) -> bool:
    """Whether a boundary at ``place`` is one in every version of Unicode. Between two letters it stands only after
    a contraction, which may hang on the class of a character further left."""
    before, after = text[place - 1], text[place]
    return bool(_SETTLED.fullmatch(before + after)) and not (before.isalpha() and after.isalpha())


def joints(codec: Codec, start: int, text: str, following: int | None, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk in its overlap with the one before, and those in its overlap with the one that
    starts at ``following`` where it may be stitched. The last two characters of a chunk decide nothing, as
    what comes after them may."""
    places = codec.boundaries(text)
    head = [start + p for p in places if p <= overlap]
    tail = []
    if following is not None:
        tail = [start + p for p in places
                if following - start <= p <= len(text) - 2 and _settled(text, p)]
    return head, tail


# --- tables -----------------------------------------------------------------------


def _content(path: str | None) -> bytes:
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return file.read()


def _encoded(content: bytes, pattern: str, keys: list[tuple[str, pa.DataType]]):
    """The function that encodes rows of ``keys`` and a text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [codec.encode(text.as_py()) for text in part.column(len(keys))]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k).cast(t) for k, (_, t) in enumerate(keys)), pa.array(ids, pa.list_(pa.int32()))],
                    names=[*(name for name, _ in keys), "ids"])

    return run


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``k1, k2, i, start, following, text``: the chunks of each text, dealt out one by one. ``following`` is
    where the next one starts, NULL for the last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                found = list(cut(text.as_py(), chunk, overlap))
                n = len(found)
                starts = [start for start, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k1.as_py()] * n, pa.int64()), pa.array([k2.as_py()] * n, pa.int64()), pa.array(range(n), pa.int64()),
                     pa.array(starts, pa.int64()), pa.array([*starts[1:], None], pa.int64()), pa.array([t for _, t in found], pa.string())],
                    names=["k1", "k2", "i", "start", "following", "text"])

    rows = texts.select("k1", "k2", "text").mapInArrow(
        run, "k1 long, k2 long, i long, start long, following long, text string")
    return stored(rows.repartition("k1", "k2", "i"), "chunks")


def _ends(chunks: DataFrame, content: bytes, pattern: str, overlap: int) -> DataFrame:
    """``chunks`` without texts, with their boundaries in both overlaps."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content, pattern)
        for batch in batches:
            found = [joints(codec, s.as_py(), t.as_py(), f.as_py(), overlap)
                     for s, f, t in zip(batch.column(3), batch.column(4), batch.column(5))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *(pa.array([x[side] for x in found], pa.list_(pa.int64())) for side in (0, 1))],
                names=["k1", "k2", "i", "start", "following", "head", "tail"])

    rows = chunks.select("k1", "k2", "i", "start", "following", "text").mapInArrow(
        run, "k1 long, k2 long, i long, start long, following long, head array<long>, tail array<long>")
    return stored(rows, "ends")


def _stitched(ends: DataFrame) -> DataFrame:
    """``k1, k2, i, start, following, stitch``: the first boundary that a chunk and the next one share; NULL
    for the last chunk and where they have none."""
    following = ends.select("k1", "k2", F.col("start").alias("following"), F.col("head").alias("next_head"))
    stitch = F.array_min(F.array_intersect("tail", "next_head"))
    return stored(
        ends.join(following, ["k1", "k2", "following"], "left")
        .select("k1", "k2", "i", "start", "following", stitch.alias("stitch")), "stitches")


def _merged(chunks: DataFrame, stitches: DataFrame) -> DataFrame:
    """Chunks between which nothing could be stitched as one."""
    order = Window.partitionBy("k1", "k2").orderBy("i")
    open_end = (F.col("following").isNotNull() & F.col("stitch").isNull()).cast("long")
    # chunks of one run have the same number: how many closed ends come before
    run = (F.row_number().over(order) - 1 - F.coalesce(F.sum(open_end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    runs = stitches.select("k1", "k2", "i", run.alias("run"))
    step = F.coalesce(F.col("following") - F.col("start"), F.char_length("text"))
    held = F.array_sort(F.collect_list(F.struct("i", "start", "following", "text", step.alias("step"))))
    whole = chunks.join(runs, ["k1", "k2", "i"]).groupBy("k1", "k2", "run").agg(held.alias("held"))
    last = F.element_at("held", -1)
    front = F.transform(F.slice("held", 1, F.size("held") - 1), lambda c: F.substring(c["text"], F.lit(1), c["step"].cast("int")))
    return stored(whole.select(
        "k1", "k2", F.col("held")[0]["i"].alias("i"), F.col("held")[0]["start"].alias("start"),
        last["following"].alias("following"), F.concat(F.array_join(front, ""), last["text"]).alias("text")), "chunks")


def encode_long(texts: DataFrame, content: bytes, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``k1, k2, ids`` of the distinct texts ``k1, k2, text``, by overlapping chunks."""
    chunks = _chunks(texts, chunk, overlap)
    while True:
        stitches = _stitched(_ends(chunks, content, pattern, overlap))
        if stitches.where("following IS NOT NULL AND stitch IS NULL").isEmpty():
            break
        # a pre-token longer than the overlap: its chunks become one, at most as long as the text
        chunks = _merged(chunks, stitches)
    before = stitches.select("k1", "k2", F.col("following").alias("start"), F.col("stitch").alias("begin"))
    places = stitches.join(before, ["k1", "k2", "start"], "left").select(
        "k1", "k2", "i", F.coalesce("begin", "start").alias("begin"), F.col("stitch").alias("end"))
    first = (F.col("begin") - F.col("start") + 1).cast("int")
    length = F.coalesce(F.col("end") - F.col("begin"), F.char_length("text").cast("long")).cast("int")
    pieces = chunks.join(places, ["k1", "k2", "i"]).select("k1", "k2", "i", F.substring("text", first, length).alias("text"))
    keys = [(name, pa.int64()) for name in ("k1", "k2", "i")]
    encoded = pieces.mapInArrow(_encoded(content, pattern, keys), "k1 long, k2 long, i long, ids array<int>")
    return encoded.groupBy("k1", "k2").agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("i", "ids")))["ids"]).alias("ids"))


def _parts(docs: DataFrame, path: str | None, pattern: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Short documents with ids; the others with the digest of their text; the ids of each such text."""
    content = _content(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # code points are at most bytes, so most rows need no count
    long_text = (F.octet_length("text") > chunk) & (F.char_length("text") > chunk)
    short = rows.where(~long_text).mapInArrow(_encoded(content, pattern, [("doc_id", pa.int64())]), "doc_id long, ids array<int>")
    k1, k2 = digest(F.col("text"))
    keyed = rows.where(long_text).select("doc_id", k1.alias("k1"), k2.alias("k2"), "text")
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    return short, keyed.select("doc_id", "k1", "k2"), encode_long(texts, content, pattern, chunk, overlap)


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id`` and ``ids`` of every row of ``docs``, whole texts, no special tokens.

    Each match of ``pattern`` is encoded by itself by the ranks of the file ``path``, which the driver reads and tasks
    carry with them. Texts of more than ``chunk`` code points are encoded once for all their copies. NULL text
    counts as empty and has no ids; a NULL or repeated id keeps its rows, each with the ids of its own
    text; repeated rows repeat. An empty table gives an empty table. Other columns are not read.
    """
    short, rows, texts = _parts(docs, path, pattern, chunk, overlap)
    return short.unionByName(rows.join(texts, ["k1", "k2"]).select("doc_id", "ids"))


def decode(rows: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``rows`` with a further column ``raw``, the bytes of the column ``ids``; NULL ids have none."""
    content = _content(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content, pattern)
        for batch in batches:
            place = batch.schema.names.index("ids")
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                raw = [codec.decode(ids.as_py() or []) for ids in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, "raw"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("raw", BinaryType())]))


def round_trips(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """What the registered query returns: per row of ``docs`` number and digest of its ids, and the digest of
    the bytes they decode to. Copies of a long text share its digests."""

    def digested(rows: DataFrame, *keys: str) -> DataFrame:
        listed = F.array_join(F.col("ids").cast("array<string>"), ",")
        return decode(rows, path, pattern).select(
            *keys, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
            F.sha2("raw", 256).alias("decoded_sha256"))

    short, rows, texts = _parts(docs, path, pattern, chunk, overlap)
    found = stored(digested(texts, "k1", "k2"), "digests")
    return digested(short, "doc_id").unionByName(rows.join(found, ["k1", "k2"]).drop("k1", "k2"))


ship(__name__)
