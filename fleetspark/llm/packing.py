"""Packing token sequences by minimum bin slack.

Documents are cut at multiples of the window. What remains of each is packed: subset sums of the
remaining lengths, kept as a bitset, show the multiset that fills a window closest to its capacity;
it is traced back and used as often as the counts allow.
"""

from __future__ import annotations

import json
import re
import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import frugal, ship

WINDOW, END = 2048, 1
#: so many remaining pieces are packed together; a task holds no more of them
BLOCK = 8192
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
)
#: letters and white space up to here are alike in all Unicode versions
_NEWER = re.compile("[^\x00-֏]")


# --- tokens -----------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary of a byte-level tokenizer."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of a byte-level tokenizer file, as the ``tokenizers`` library gives them.

    Texts of long-standing letters go through the faster ``tiktoken`` with the same merges (``pattern``
    is how byte-level files without one of their own split a text); the others, and all if the file's ids don't follow its merges, through ``tokenizers``.
    """

    def __init__(self, content: str, pattern: str):
        self.content = content
        self.slow = None
        self.fast = None
        file = json.loads(content)
        model, pre = file["model"], file["pre_tokenizer"]
        letters = _byte_letters()
        vocab = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        plain = file["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        if plain and len(vocab) == len(model["vocab"]) and made == sorted(made) and not model.get("ignore_merges"):
            import tiktoken

            self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
            self.fast = tiktoken.Encoding(
                "file", pat_str=pattern, mergeable_ranks=vocab, special_tokens=self.specials)

    def __call__(self, text: str) -> list[int]:
        if self.fast and not _NEWER.search(text):
            return self.fast.encode(text, allowed_special="all", disallowed_special=())
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.content)
        return self.slow.encode(text, add_special_tokens=False).ids


def _encoder(content: str, pattern: str) -> Encoder:
    """One per worker process; it outlives the task on ``sys``."""
    kept = sys.__dict__.setdefault("_llm_encoders", {})
    if content not in kept:
        kept[content] = Encoder(content, pattern)
    return kept[content]


# --- minimum bin slack ------------------------------------------------------------


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, the largest one among them, whose sum comes closest to ``capacity``.

    Bit s of ``sums`` is set when some multiset adds up to s. Copies join in powers of two, and each
    step keeps the bits before it, by which the way back finds what was used.
    """
    first = max(counts)
    room = capacity - first
    sums, full = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        able = min(counts[length] - (length == first), room // length)
        copies = 1
        while able > 0:
            use = min(copies, able)
            steps.append((length, use, sums))
            sums |= (sums << (length * use)) & full
            able -= use
            copies *= 2
        if sums >> room:
            break
    left = sums.bit_length() - 1
    chosen = defaultdict(int, {first: 1})
    for length, use, before in reversed(steps):
        if not before >> left & 1:
            chosen[length] += use
            left -= length * use
    return dict(chosen)


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Multisets and how often each is used, until all lengths are packed."""
    counts = {k: n for k, n in counts.items() if n}
    plan = []
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[k] // n for k, n in chosen.items())
        plan.append((chosen, times))
        for k, n in chosen.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return plan


class _Packer:
    """Gives pieces a sequence and an offset, in a stream that holds at most two blocks."""

    def __init__(self, first_sequence: int, window: int, block: int):
        self.next, self.window, self.block = first_sequence, window, block
        self.waiting: dict[int, list[tuple]] = defaultdict(list)
        self.n = 0

    def whole(self, piece: tuple) -> tuple:
        self.next += 1
        return (*piece, self.next - 1, 0)

    def add(self, piece: tuple) -> Iterator[tuple]:
        self.waiting[piece[2]].append(piece)
        self.n += 1
        if self.n >= self.block:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Pack what waits; before the end, pieces of windows with room to spare wait for the next
        block, unless they fill half of it."""
        plan = pack_lengths({k: len(v) for k, v in self.waiting.items()}, self.window)
        loose = {k for k, (m, _) in enumerate(plan) if sum(a * b for a, b in m.items()) < self.window}
        keep = not last and sum(sum(plan[k][0].values()) * plan[k][1] for k in loose) <= self.block // 2
        for k, (chosen, times) in enumerate(plan):
            if keep and k in loose:
                continue
            for _ in range(times):
                offset = 0
                for length, n in chosen.items():
                    for _ in range(n):
                        yield (*self.waiting[length].pop(), self.next, offset)
                        offset += length
                self.next += 1
        self.n = sum(map(len, self.waiting.values()))


def packer(content: str, pattern: str, window: int, end: int, block: int):
    """The function that packs one partition of documents."""
    names = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
    types = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 2

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def pieces(doc_id: int, ids: np.ndarray) -> Iterator[tuple]:
        for start in range(0, len(ids), window):
            part = ids[start : start + window]
            yield doc_id, start, len(part), len(ids), part.tobytes()

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        encode = _encoder(content, pattern)
        # partitions have sequences of their own, numbered apart; a repeated task repeats its numbers
        pack = _Packer(TaskContext.get().partitionId() << 33, window, block)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end], "<u4")
                for piece in pieces(doc_id.as_py(), ids):
                    if piece[2] == window:
                        yield pack.whole(piece)
                    else:
                        yield from pack.add(piece)
        yield from pack.flush(last=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in placed(batches):
            rows.append(row)
            if len(rows) == 2048:
                yield table(rows)
                rows = []
        if rows:
            yield table(rows)

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, end: int = END, block: int = BLOCK
) -> DataFrame:
    """The pieces of all documents with their place: ``doc_id``, ``start`` (ids of the document before
    the piece), ``length``, ``doc_tokens``, ``ids`` (little-endian, 32 bits each), ``sequence_id`` and
    ``offset``.

    A document is its tokens and then the id ``end``; NULL text has that id alone. The tokenizer file
    is read by the driver and travels with the tasks. A partition packs its own documents in one
    pass without a shuffle, so at most a few of its windows have room to spare. Rows without an id or with
    a repeated one are packed like others; an empty table gives no pieces. Other columns are not read.
    """
    with open(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(frugal(packer(content, public_tokenizers.PATTERN, window, end, block)), PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """The packed sequences: ``sequence_id`` and ``ids``, padded to ``window`` with the id ``pad``."""
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: F.hex(p["ids"])), "")
    fill = F.hex(F.lit(int(pad).to_bytes(4, "little")))
    return pieces.groupBy("sequence_id").agg(joined.alias("hex")).select(
        "sequence_id", F.unhex(F.rpad("hex", window * 8, fill)).alias("ids"))


def packed_digests(docs: DataFrame) -> DataFrame:
    """What the registered query returns of each piece."""
    return pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


ship(__name__)
