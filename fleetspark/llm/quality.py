"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in cycles, one feature at a time, then one pair of features at a time. The
trees of a feature add up to one lookup table over its bins, so a score is a sum of table entries.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import in_class, ship

#: most labelled rows that the model is fitted on; they pass through the driver as features
SAMPLE = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAF, RIDGE = 200, 60, 0.1, 20, 5.0

FEATURES = [
    "log_chars", "upper", "digits", "marks", "symbols", "stops", "spaces", "lines", "word_length",
    "distinct_words", "repeated_next", "distinct_lines", "compressed", "long_words",
]
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!?\"'();:-"]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "!?\"'();:-.,"]] = True


def text_features(text: str | None) -> list[float]:
    """Numbers that describe a whole text: shares of character classes, repetition, lengths."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = seen[65:91].sum(), seen[97:123].sum()
    words = raw.split()
    count = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    again = sum(map(bytes.__eq__, words, words[1:]))
    return [
        float(np.log1p(len(raw))), upper / max(upper + lower, 1), seen[48:58].sum() / n, seen[_MARK].sum() / n,
        seen[_SYMBOL].sum() / n, (seen[44] + seen[46]) / n, seen[32] / n, seen[10] / count,
        sum(map(len, words)) / count, len(set(words)) / count, again / count,
        len(set(lines)) / max(len(lines), 1), len(zlib.compress(raw, 1)) / (n + 16),
        sum(len(w) > 20 for w in words) / count,
    ]


def feature_matrix(texts) -> np.ndarray:
    return np.array([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))


@dataclass
class AdditiveModel:
    """log odds = ``base`` + the table entry of each feature's bin + one of each pair's two bins."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _cut(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """Best place to split a row of bins in two, and the gain."""
    g, h, n = grad.cumsum(), hess.cumsum(), rows.cumsum()
    able = (n[:-1] >= LEAF) & (n[-1] - n[:-1] >= LEAF)
    if not able.any():
        return 0.0, 0
    left, right = g[:-1], g[-1] - g[:-1]
    gain = left**2 / (h[:-1] + RIDGE) + right**2 / (h[-1] - h[:-1] + RIDGE) - g[-1] ** 2 / (h[-1] + RIDGE)
    gain[~able] = 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Values per bin of a tree with at most four leaves."""
    parts = [(0, len(grad))]
    for _ in range(2):
        deeper = []
        for lo, hi in parts:
            gain, at = _cut(grad[lo:hi], hess[lo:hi], rows[lo:hi])
            deeper += [(lo, lo + at), (lo + at, hi)] if gain > 0 else [(lo, hi)]
        parts = deeper
    out = np.zeros(len(grad))
    for lo, hi in parts:
        out[lo:hi] = grad[lo:hi].sum() / (hess[lo:hi].sum() + RIDGE)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a tree that splits one axis of a grid, then the other in each half."""
    best_gain, best = 0.0, np.zeros_like(grad)
    for axis in (0, 1):
        g, h, n = (m if axis == 0 else m.T for m in (grad, hess, rows))
        for at in range(1, g.shape[0]):
            gain, out = 0.0, np.zeros_like(g)
            for lo, hi in ((0, at), (at, g.shape[0])):
                part = [m[lo:hi].sum(0) for m in (g, h, n)]
                _, cut = _cut(*part)
                for a, b in ((0, cut), (cut, g.shape[1])):
                    if b > a and n[lo:hi, a:b].sum() >= LEAF:
                        sums = g[lo:hi, a:b].sum(), h[lo:hi, a:b].sum() + RIDGE
                        gain += sums[0] ** 2 / sums[1]
                        out[lo:hi, a:b] = sums[0] / sums[1]
            if gain > best_gain:
                best_gain, best = gain, out if axis == 0 else out.T
    return best_gain, best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit to features and 0/1 labels. Without rows, or with one label only, the score is constant."""
    n, ones = len(y), float(y.sum())
    rate = (ones + 1) / (n + 2)
    width = x.shape[1]
    edges = [_edges(x[:, j], BINS) if n else np.empty(0) for j in range(width)]
    model = AdditiveModel(float(np.log(rate / (1 - rate))), edges, [np.zeros(len(e) + 1) for e in edges])
    if ones in (0, n):
        return model
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    total = np.full(n, model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, at in enumerate(binned):
            grad, hess = slopes()
            size = len(edges[j]) + 1
            sums = [np.bincount(at, v, minlength=size) for v in (grad, hess, np.ones(n))]
            step = RATE * _tree(*sums)
            model.tables[j] += step
            total += step[at]

    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]

    def grid(a: int, b: int) -> list[np.ndarray]:
        shape = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        cell = coarse[a] * shape[1] + coarse[b]
        grad, hess = slopes()
        return [np.bincount(cell, v, minlength=shape[0] * shape[1]).reshape(shape) for v in (grad, hess, np.ones(n))]

    gains = sorted(((_pair_tree(*grid(a, b))[0], a, b) for a in range(width) for b in range(a)), reverse=True)
    model.pairs = [(a, b) for _, a, b in gains[:PAIRS]]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            step = RATE * _pair_tree(*grid(a, b))[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fit on at most ``sample`` labelled documents, those with the smallest hash of the id among the
    rows whose crc32(id) mod 4 is not 2. Rows without id, or whose label is neither 0 nor 1, teach
    nothing; a document with several labels teaches each."""
    able = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~in_class("doc_id", 4, 2))
    chosen = able.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    features = F.arrow_udf(lambda texts: pa.array(list(feature_matrix(texts.to_pylist())), pa.list_(pa.float64())), "array<double>")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
    fitted = rows.select("quality", features("text").alias("x")).toPandas()
    x = np.array(fitted["x"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, fitted["quality"]])  # the sums do not depend on the order of arrival
    return fit(x[order], fitted["quality"].to_numpy(float)[order])


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """Score of a text, 0 to 1; NULL counts as empty."""
    return F.arrow_udf(lambda texts: pa.array(model.score(feature_matrix(texts.to_pylist()))), "double")(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its score, and whether it is in the part kept out of training.

    NULL text scores as empty text; a NULL id is not held out and never teaches; repeated rows score
    alike; an empty table gives an empty table. Nothing but the text is an input of the score.
    """
    model = train(docs, labels)
    scored = docs.select("doc_id", in_class("doc_id", 4, 2).alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    model = train(docs, labels)
    return docs.where(quality_score(model, F.col("text")) >= threshold)


ship(__name__)
