"""Language identification for texts in several languages.

A text is a mixture of languages. Expectation maximisation estimates each language's share from the
likelihoods of the text's character trigrams; of the nested sets of languages, the one with the best
penalised likelihood is chosen.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import in_class, ship

#: about so many documents of each language teach it, whole, chosen by a hash of the id
PER_LANGUAGE = 2000
#: trigrams hash into so many bins
BINS = 1 << 15
SMOOTHING, STEPS = 0.5, 12
#: trigrams overlap, so three of them count as one observation; what a further language must gain
OVERLAP, PENALTY = 3.0, 6.0
UNKNOWN = "und"
_NO_LETTER = re.compile(r"[\W\d_]+")


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the text's letter trigrams and how often each occurs; none without a letter."""
    words = _NO_LETTER.sub(" ", (text or "").lower()).strip()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    # a lone surrogate cannot be encoded; it becomes a question mark
    points = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    mixed = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)
    seen = np.bincount(((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64), minlength=BINS)
    bins = np.flatnonzero(seen)
    return bins, seen[bins].astype(float)


def mixture(like: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the languages (columns of ``like``) and the log likelihood under them."""
    n = counts.sum()
    share = np.full(like.shape[1], 1 / like.shape[1])
    if like.shape[1] > 1:
        for _ in range(STEPS):
            joint = like * share
            share = (counts / joint.sum(1)) @ joint / n
    return share, float(counts @ np.log(like @ share))


def identify(like: np.ndarray, text: str | None) -> tuple[list[int], np.ndarray]:
    """Languages of the chosen set, the largest share first, and their shares; none without letter."""
    bins, counts = trigram_counts(text)
    if not len(bins) or not like.shape[1]:
        return [], np.empty(0)
    rows = like[bins]
    shares, _ = mixture(rows, counts)
    order = np.argsort(-shares, kind="stable")
    best = int((counts @ np.log(rows)).argmax())  # the best single language opens the nested sets
    order = [best, *[int(j) for j in order if j != best]]
    chosen, kept, value = order[:1], np.ones(1), float(counts @ np.log(rows[:, best]))
    for size in range(2, len(order) + 1):
        share, after = mixture(rows[:, order[:size]], counts)
        if (after - value) / OVERLAP < PENALTY + 0.5 * np.log(counts.sum()):
            break
        chosen, kept, value = order[:size], share, after
    rank = np.argsort(-kept, kind="stable")
    return [chosen[i] for i in rank], kept[rank]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Names of the languages and, per trigram bin, its probability in each.

    Learns from text and ``lang`` of the rows whose crc32(id) mod 4 is not 2, from about
    ``per_language`` documents of each language: those whose hash of the id is below a bound set by
    the language's number of documents. The sums, one row per language and bin, meet in the driver.
    """
    able = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~in_class("doc_id", 4, 2)
    )
    sizes = dict(able.groupBy("lang").count().collect())
    if not sizes:
        return [], np.empty((BINS, 0))
    part = F.create_map(*[F.lit(v) for k, n in sorted(sizes.items()) for v in (k, min(1.0, per_language / n))])
    dice = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)

    def counted(batches):
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                total = np.zeros(BINS)
                for text in texts:
                    bins, counts = trigram_counts(text)
                    total[bins] += counts
                bins = np.flatnonzero(total)
                yield pd.DataFrame({"lang": lang, "bin": bins, "n": total[bins].astype(np.int64)})

    chosen = able.where(dice < F.element_at(part, F.col("lang"))).select("lang", "text")
    counts = (
        chosen.mapInPandas(counted, "lang string, bin int, n long")
        .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    )
    names = sorted(counts["lang"].unique())
    table = np.full((BINS, len(names)), SMOOTHING)
    table[counts["bin"], np.searchsorted(names, counts["lang"]) if names else []] += counts["n"]
    return names, table / table.sum(0)


def language_of(model: tuple[list[str], np.ndarray], text: Column) -> Column:
    """Struct of ``lang_pred``, ``score`` (its share of the text), ``languages`` and ``shares``."""
    names, like = model

    @F.pandas_udf("lang_pred string, score double, languages array<string>, shares array<double>")
    def found(texts: pd.Series) -> pd.DataFrame:
        out = [identify(like, t) for t in texts]
        return pd.DataFrame({
            "lang_pred": [names[c[0]] if c else UNKNOWN for c, _ in out],
            "score": [min(1.0, float(s[0])) if c else 0.0 for c, s in out],
            "languages": [[names[i] for i in c] for c, _ in out],
            "shares": [[float(v) for v in s] for _, s in out],
        })

    return found(text)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Every document with its largest language, that language's share, and the whole set.

    Text that is NULL or has no letter is ``und`` with score 0, and so is every text if nothing was
    learned. A NULL id is not held out and never teaches. Repeated rows get the same result; an empty
    table gives an empty table. Nothing but the text is an input of a prediction.
    """
    model = train(docs)
    found = docs.select("doc_id", in_class("doc_id", 4, 2).alias("held_out"), language_of(model, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


ship(__name__)
