"""Language-model scores from a lattice of subwords.

The pieces of an existing vocabulary, each with a unigram probability, span a lattice over every word:
one path per way to cut the word into pieces. A forward recursion in log space adds up all paths, so a
word's score is the logarithm of its probability whatever the segmentation. A piece has one probability
for each place in a word (first, inner, last, whole). They are learned from the training documents by
expectation maximisation over the same lattice.

A word that the training documents hold is an arc of its own beside the paths of its pieces, and each
language of the training documents has its own probabilities: a text's score is the logarithm of
its probability summed over the languages.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import NO_ID, id_key, in_class, ship, stored, whole_text
from fleetspark.llm.packing import _byte_letters

#: stands for the end of a text among the words; no word holds white space
END = b"\n"
#: a piece of so many bytes is looked up as a 64-bit number; longer ones begin with such a number
SHORT = 8
ROUNDS, SMOOTHING = 2, 0.01
#: what a word's own arc gives of each count to the paths of its pieces
DISCOUNT = 0.75
#: so many languages, those of most training documents, have probabilities of their own; the others
#: share one set. A language takes 1.3 MB in every task
LANGUAGES = 32
#: scores of at most so many frequent words, of at most so many bytes, go to every task; the scores
#: of all other words reach the documents by a join
FREQUENT, FREQUENT_BYTES = 250_000, 64
#: words that a task counts before it hands them on; words that it takes at once; words of one length
#: among them that numpy works on at once
COUNTED, GATHERED, TOGETHER = 150_000, 50_000, 4096
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_NEVER = -1e300


# --- vocabulary -------------------------------------------------------------------


def read_pieces(path: str) -> list[bytes]:
    """The distinct pieces of a byte-level vocabulary, without the mark of a word's end, in its order."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, suffix = _byte_letters(), model.get("end_of_word_suffix") or ""
    found = {}
    for name in sorted(model["vocab"], key=model["vocab"].get):
        name = name.removesuffix(suffix)
        if name and all(c in letters for c in name):
            piece = bytes(letters[c] for c in name)
            if piece.split() == [piece]:
                found[piece] = None
    return list(dict.fromkeys([*found, *(bytes([b]) for b in range(256))]))  # every word can be spelled


class Lookup:
    """Piece numbers by (bytes as a 64-bit number), for one length: two hash tables, the second for
    what collides in the first."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(len(keys) * 4 + 1)))))
        self.tables = []
        for mult in (_A, _B):
            slots = np.zeros(1 << (64 - int(self.shift)), np.uint64)
            ids = np.full(len(slots), -1, np.int32)
            at = (keys * mult) >> self.shift
            slots[at], ids[at] = keys, values
            self.tables.append((mult, slots, ids))
            lost = ids[at] != values
            keys, values = keys[lost], values[lost]
        self.rest = dict(zip(keys.tolist(), values.tolist()))  # collided twice

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers, -1 for a string that is no piece."""
        out = np.full(keys.shape, -1, np.int32)
        for mult, slots, ids in self.tables:
            at = (keys * mult) >> self.shift
            np.copyto(out, ids[at], where=(slots[at] == keys) & (out < 0))
        for key, value in self.rest.items():
            out[keys == np.uint64(key)] = value
        return out


class Lattice:
    """Pieces and, per language and place, their log probabilities (natural logarithm)."""

    FIRST, INNER, LAST, WHOLE = range(4)

    def __init__(self, pieces: list[bytes], languages: int):
        self.n = len(pieces)
        self.long = {p: i for i, p in enumerate(pieces) if len(p) > SHORT}
        self.tables = {}
        for length in range(1, SHORT + 1):
            own = [(int.from_bytes(p, "little"), i) for i, p in enumerate(pieces) if len(p) == length]
            if own:
                keys, values = zip(*own)
                self.tables[length] = Lookup(np.array(keys, np.uint64), np.array(values, np.int32))
        #: by the number a long piece begins with, the lengths of such pieces
        starts: dict[int, set[int]] = {}
        for p in self.long:
            starts.setdefault(int.from_bytes(p[:SHORT], "little"), set()).add(len(p))
        self.lengths = [sorted(found) for found in starts.values()]
        if starts:
            self.starts = Lookup(np.array(list(starts), np.uint64), np.arange(len(starts), dtype=np.int32))
        # before training all pieces are alike, but single bytes, of which any word can be made, are rare
        weight = np.array([1e-6 if len(p) == 1 else 1.0 for p in pieces])
        self.learn(np.tile(weight, (languages, 4, 1)))

    def learn(self, counts: np.ndarray) -> None:
        """Take over counts (language, place, piece). A word begins with a first or a whole piece, and
        goes on with an inner or a last one: the probabilities of either choice add up to 1."""
        logp = np.log(counts)
        for pair in ([self.FIRST, self.WHOLE], [self.INNER, self.LAST]):
            logp[:, pair] -= np.logaddexp.reduce(logp[:, pair], axis=(1, 2))[:, None, None]
        self.logp = np.concatenate([logp, np.full((*logp.shape[:2], 1), _NEVER)], 2)

    def _kind(self, places: int, last: int) -> np.ndarray:
        kind = np.full(places, self.INNER)
        kind[0], kind[-1] = self.FIRST, last
        return kind

    def edges(self, words: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each length that any word has a piece of, the number of the piece that starts at each place of
        each word (rows), -1 for none, and the kind of place."""
        width = words.shape[1]
        wide = words.astype(np.uint64)
        keys = np.zeros_like(wide)
        out = {}
        for length in range(1, min(SHORT, width) + 1):
            keys = keys[:, : width - length + 1] | (wide[:, length - 1 :] << np.uint64(8 * (length - 1)))
            if length in self.tables:
                kind = self._kind(keys.shape[1], self.LAST if length < width else self.WHOLE)
                out[length] = self.tables[length].find(keys), kind
        if width > SHORT and self.long:
            begin = self.starts.find(keys)
            for row, place in zip(*(x.tolist() for x in np.nonzero(begin >= 0))):
                for length in self.lengths[begin[row, place]]:
                    found = self.long.get(words[row, place : place + length].tobytes(), -1) if place + length <= width else -1
                    if found >= 0:
                        if length not in out:
                            places = width - length + 1
                            out[length] = np.full((len(words), places), -1, np.int32), self._kind(
                                places, self.LAST if length < width else self.WHOLE)
                        out[length][0][row, place] = found
        return out

    def _weights(self, edges: dict, language: int) -> dict[int, np.ndarray]:
        return {length: self.logp[language][kind, ids] for length, (ids, kind) in edges.items()}

    @staticmethod
    def _add(terms: np.ndarray) -> np.ndarray:
        top = terms.max(0)
        return top + np.log(np.exp(terms - top).sum(0))

    def _forward(self, weights: dict[int, np.ndarray], rows: int, width: int) -> np.ndarray:
        alpha = np.zeros((width + 1, rows))
        for j in range(1, width + 1):
            alpha[j] = self._add(np.stack([alpha[j - k] + w[:, j - k] for k, w in weights.items() if k <= j]))
        return alpha

    def scores(self, words: np.ndarray) -> np.ndarray:
        """Log probability of each word (rows of bytes, all of one length) in each language (columns)."""
        edges = self.edges(words)
        return np.stack([
            self._forward(self._weights(edges, k), *words.shape)[-1] for k in range(len(self.logp))], 1)

    def expected(self, words: np.ndarray, language: int, total: np.ndarray) -> None:
        """Add to ``total`` (place, piece) how often each piece is expected in the words, one of each."""
        edges = self.edges(words)
        weights = self._weights(edges, language)
        rows, width = words.shape
        alpha = self._forward(weights, rows, width)
        beta = np.zeros((width + 1, rows))
        for i in range(width - 1, -1, -1):
            beta[i] = self._add(np.stack([beta[i + k] + w[:, i] for k, w in weights.items() if k <= width - i]))
        for length, (ids, kind) in edges.items():
            share = np.exp(alpha[: width - length + 1].T + weights[length] + beta[length:].T - alpha[-1][:, None])
            able = ids >= 0
            cell = (kind * self.n + ids)[able]
            total += np.bincount(cell, share[able], minlength=total.size).reshape(total.shape)


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length as rows of bytes, and their places in the list."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        # long words make large tables, so fewer of them at once
        step = max(1, min(TOGETHER, TOGETHER * 16 // max(int(lengths[part[0]]), 1))) if len(part) else 1
        for i in range(0, len(part), step):
            some = part[i : i + step]
            raw = np.frombuffer(b"".join(words[k] for k in some), np.uint8)
            yield raw.reshape(len(some), -1), some


def gathered(batches: Iterable[pa.RecordBatch], rows: int = GATHERED) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, so that many words have the same length."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= rows:
            yield pa.concat_batches(waiting)
            waiting = []
    if waiting:
        yield pa.concat_batches(waiting)


# --- the passes over the corpus ---------------------------------------------------


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case (both are what ``bytes`` methods do)."""
    return (text or b"").lower().split()


def language_class(docs: DataFrame, learns: Column, most: int = LANGUAGES) -> tuple[Column, int]:
    """The number of a row's language, -1 for a row that teaches nothing, and how many there are. NULL
    counts as a language."""
    name = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    found = docs.where(learns).groupBy(name.alias("lang")).count().orderBy(F.desc("count"), "lang").limit(most + 1).collect()
    names = [r["lang"] for r in found[:most]]
    number = F.lit(len(names))  # the languages beyond
    for i, known in enumerate(names):
        number = F.when(name == known, F.lit(i)).otherwise(number)
    return F.when(learns, number).otherwise(F.lit(-1)).cast("int"), max(len(found), 1)


def count_words(docs: DataFrame, number: Column, languages: int) -> DataFrame:
    """``word``, ``n`` (how often in all documents) and ``c0``, ``c1``, ... (in those that teach each
    language), stored."""
    columns = ["n", *[f"c{i}" for i in range(languages)]]

    def table(seen: list[Counter]) -> pa.RecordBatch:
        words = list(set().union(*seen))
        counts = [np.fromiter(map(c.get, words, repeat(0)), np.int64, len(words)) for c in seen]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), *map(pa.array, (sum(counts), *counts[:-1]))], names=["word", *columns])

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(languages + 1)]  # the last one: of the texts that teach nothing
        for batch in batches:
            for text, k in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[k].update(words_of(text.as_py()))
                seen[k][END] += 1
                if sum(map(len, seen)) >= COUNTED:
                    yield table(seen)
                    seen = [Counter() for _ in range(languages + 1)]
        if any(seen):
            yield table(seen)

    shape = "word binary, " + ", ".join(f"{c} long" for c in columns)
    parts = docs.select(whole_text().cast("binary"), number).mapInArrow(counted, shape)
    return stored(parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in columns]), "words")


def train(words: DataFrame, languages: int, pieces: list[bytes], rounds: int = ROUNDS) -> Lattice:
    """The trained lattice.

    Every round spreads each language's distinct words over the lattice, task by task; what comes back
    is one number for each language, place and piece of the vocabulary.
    """
    lattice = Lattice(pieces, languages)
    for _ in range(rounds):
        def spread(batches, lattice=lattice):
            total = np.zeros((languages, 4, lattice.n))
            for batch in gathered(batches):
                raw = batch.column(0).to_pylist()
                for k in range(languages):
                    taught = batch.column(k + 1).to_numpy() > 0
                    for rows, _ in by_length(list(compress(raw, taught))):
                        lattice.expected(rows, k, total[k])
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total.ravel()[found])], names=["cell", "n"])

        counts = (
            words.where(F.col("word") != END).select("word", *[f"c{k}" for k in range(languages)])
            .mapInArrow(spread, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        )
        total = np.full((languages, 4, lattice.n), SMOOTHING)
        total.ravel()[counts["cell"]] += counts["n"]
        lattice.learn(total)
    return lattice


def score_words(words: DataFrame, lattice: Lattice, tokens: list[int], kinds: list[int]) -> DataFrame:
    """``words`` with ``lp0``, ``lp1``, ..., each word's log10 probability per language, stored.

    ``tokens`` and ``kinds`` are each language's tokens and distinct words. A word's own arc has its
    count less the discount; what the discounts leave goes to the pieces.
    """
    languages = len(tokens)
    names = ["word", "n", *[f"c{k}" for k in range(languages)], *[f"lp{k}" for k in range(languages)]]

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            raw = batch.column(0).to_pylist()
            spelled = np.empty((len(raw), languages))
            for rows, at in by_length(raw):
                spelled[at] = lattice.scores(rows)
            ends = [i for i, w in enumerate(raw) if w == END]
            out = []
            for k in range(languages):
                count = batch.column(k + 2).to_numpy().astype(float)
                if not tokens[k]:  # nothing was learned: half of all tokens are ends
                    p = spelled[:, k] + np.log(0.5)
                    p[ends] = np.log(0.5)
                else:
                    with np.errstate(divide="ignore"):
                        own = np.log(np.maximum(count - DISCOUNT, 0) / tokens[k])
                        left = np.log(max(DISCOUNT * kinds[k], 1.0) / tokens[k])
                        p = np.logaddexp(own, spelled[:, k] + left)
                        p[ends] = np.log(count[ends] / tokens[k])
                out.append(pa.array(p / np.log(10)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=names)

    shape = "word binary, " + ", ".join(f"{c} {'double' if c.startswith('lp') else 'long'}" for c in names[1:])
    return stored(words.mapInArrow(scored, shape), "scored-words")


def frequent_words(words: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The words above a bound of the count that at most ``most`` words pass. The bound comes from
    counts of words per power of 1.1, a few hundred rows at most."""
    able = words.where(F.octet_length("word") <= FREQUENT_BYTES)
    level = F.floor(F.log(1.1, F.col("n").cast("double"))).cast("int")
    sizes = able.groupBy(level.alias("level")).count().collect()
    bound, passed = 2**31 - 1, 0
    for row in sorted(sizes, reverse=True):
        passed += row["count"]
        if passed > most:
            break
        bound = row["level"]
    return able.where(level >= bound)


def score_documents(docs: DataFrame, vocabulary_path: str | None = None, modulus: int = 5, remainder: int = 1) -> DataFrame:
    """Every document with its token counts, the score of a word model and that of the lattice.

    Tokens are the words, A-Z in lower case, and one end per text. Learns from the rows whose
    crc32(id) mod ``modulus`` is not ``remainder``; a NULL id teaches, and a NULL language is one more
    language. NULL text is empty: its only token is the end. Repeated rows are counted and scored one by one; an empty table
    gives an empty table; if nothing teaches, all tokens are unknown.
    """
    held_out = in_class("doc_id", modulus, remainder)
    number, languages = language_class(docs, ~held_out)
    words = count_words(docs, number, languages)
    taught = [f"c{k}" for k in range(languages)]
    count = sum(F.col(c) for c in taught)
    found = words.agg(
        F.sum(count).alias("tokens"), F.count_if(count > 0).alias("known"),
        *[F.sum(c).alias(f"tokens_{c}") for c in taught],
        *[F.count_if((F.col(c) > 0) & (F.col("word") != END)).alias(f"kinds_{c}") for c in taught],
        *[F.max(F.when(F.col("word") == END, F.col(c))).alias(f"documents_{c}") for c in taught],
    ).first().asDict()
    found = {k: v or 0 for k, v in found.items()}
    tokens, known = found["tokens"], found["known"]
    pieces = read_pieces(vocabulary_path or public_tokenizers.path("word_bpe_49k.json"))
    lattice = train(words, languages, pieces)
    scored = score_words(words, lattice, [found[f"tokens_{c}"] for c in taught], [found[f"kinds_{c}"] for c in taught])

    base = F.log10((count + 0.5) / F.lit(tokens + 0.5 * (known + 1)))
    scores = ["base", *[f"lp{k}" for k in range(languages)]]
    scored = scored.select("word", "n", (count > 0).cast("long").alias("known"), base.alias("base"), *scores[1:])
    often = frequent_words(scored).select("word", "known", *scores).toArrow()  # at most FREQUENT rows
    shared = docs.sparkSession.sparkContext.broadcast(
        (often.column(0).to_pylist(), np.stack([often.column(i).to_numpy() for i in range(1, often.num_columns)], 1)))
    sums = ["total", "known", *scores]

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each of a text's other words, and one with the sums of its frequent words under
        a key of its own that is no word."""
        names, values = shared.value
        place = dict(zip(names, range(len(names)))).get
        for batch in batches:
            words, times, lengths, sums_of, totals = [], [], [], [], []
            hashes = batch.column(1).to_pylist()
            for hash_, text in zip(hashes, batch.column(2)):
                raw = words_of(text.as_py())
                counts = Counter(raw)
                counts[END] = 1
                at = np.fromiter(map(place, counts, repeat(-1)), np.int64, len(counts))
                n = np.fromiter(counts.values(), np.int64, len(counts))
                other = at < 0
                words += compress(counts, other)
                words.append(END + hash_.to_bytes(8, "little", signed=True))
                times += [n[other], [1]]
                lengths.append(int(other.sum()) + 1)
                totals.append(len(raw) + 1)
                sums_of.append(n[~other] @ values[at[~other]])
            last = np.cumsum(lengths) - 1
            place_of = np.full(len(words), -1)
            place_of[last] = np.arange(len(last))
            known, *columns = np.stack(sums_of, 1)
            fields = [pa.array(totals, pa.int64()), pa.array(known.astype(np.int64)), *map(pa.array, columns)]
            own = pa.StructArray.from_arrays(fields, sums).take(pa.array(place_of, mask=place_of < 0))
            whole = pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column(0).to_numpy(), lengths)), pa.array(np.repeat(batch.column(1).to_numpy(), lengths)),
                pa.array(words, pa.binary()), pa.array(np.concatenate(times)), own,
            ], names=["id", "th", "word", "times", "own"])
            for start in range(0, whole.num_rows, 20_000):
                yield whole.slice(start, 20_000)

    inner = "total long, known long, " + ", ".join(f"{c} double" for c in scores)
    parts = docs.select(
        id_key().alias("id"), F.xxhash64(whole_text()).alias("th"), whole_text().cast("binary").alias("text")
    ).mapInArrow(summed, f"id long, th long, word binary, times long, own struct<{inner.replace(' long', ': long').replace(' double', ': double')}>")
    joined = parts.join(scored, "word", "left")
    is_own = F.col("own").isNotNull()
    shared_sums = [
        F.when(is_own, F.col(f"own.{c}")).otherwise(F.col("times") * F.col(c) if c != "total" else F.lit(0)).alias(c) for c in sums]
    joined = joined.select("id", "th", F.when(is_own, 1).otherwise(0).cast("long").alias("copies"), *shared_sums)
    # rows that repeat an id and its text are added up as one, in the map task first, divided and written out again
    each = joined.groupBy("id", "th").agg(*[F.sum(c).alias(c) for c in ["copies", *sums]])
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    every = max(sum(found[f"documents_{c}"] for c in taught), 1)
    joint = [  # a language is as likely as its share of the training documents
        F.col(f"lp{k}") / F.col("copies") + float(np.log10((found[f"documents_{c}"] or 1) / every)) for k, c in enumerate(taught)]
    top = F.greatest(*joint) if len(joint) > 1 else joint[0]
    each = each.withColumn("doc_id", F.when(F.col("id") != NO_ID, F.col("id"))).withColumn("top", top)
    return each.select(
        "doc_id", held_out.alias("held_out"), F.expr("total div copies").alias("n_tokens"),
        F.expr("known div copies").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("top") + F.log10(sum(F.pow(F.lit(10.0), j - F.col("top")) for j in joint))).alias("score"),
    )


ship(__name__)
