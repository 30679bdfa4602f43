"""Document fingerprints from closed syncmers, in SQL expressions alone.

Words are the letters. A run of ``K`` words is an anchor when the smallest hash of its inner runs of
``S`` words stands at its first or last place. Whether a run is chosen depends on its own words only,
so equal passages choose equal anchors wherever they stand. A fingerprint keeps the ``KEPT`` smallest
anchor hashes of a text, in the order of the text: its places are those of the anchors to each other, and two
fingerprints are alike as far as their common anchors follow each other in the same order.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetspark.llm.common import NO_ID, WHITE, id_key, stored, whole_text

K, S, KEPT = 5, 2, 64
#: anchor hashes have 48 bits, 12 hexadecimal digits in a fingerprint
BITS = 48
#: documents of neighbouring ids that one task holds together; with more than MAX_RANGES times that
#: many documents the ranges become longer instead of more, as their bounds are part of the plan
RANGE_DOCS, MAX_RANGES = 2048, 65536


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchors(text: Column) -> Column:
    """Hashes of all closed syncmers of a text, in order; one for the whole text if it has none,
    as with fewer than ``K`` words; none without words."""
    mask = F.lit((1 << BITS) - 1)
    span = K - S  # places of the inner runs: 0 .. span

    def chosen(words: Column, inner: Column) -> Column:
        def anchor(i: Column) -> Column:
            at = [F.get(inner, i + j) for j in range(span + 1)]
            edge = F.least(at[0], at[-1])
            runs = [F.get(inner, i + j) for j in range(0, span, S)] + [F.get(words, i + K - 1)]
            return F.when(edge <= F.least(*at[1:-1]), F.xxhash64(*runs).bitwiseAND(mask))

        places = F.sequence(F.lit(0), F.size(words) - K)
        return F.filter(F.transform(places, anchor), lambda x: x.isNotNull())

    def of_words(words: Column) -> Column:
        inner = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
        whole = F.array(F.xxhash64(words).bitwiseAND(mask))
        found = F.when(F.size(words) >= K, _let(inner, lambda s: chosen(words, s)))
        return _let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(whole))

    trimmed = F.btrim(text, F.lit(WHITE))
    hashed = F.transform(F.split(trimmed, "[\\x20\\x09-\\x0D]+"), lambda w: F.xxhash64(w))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(_let(hashed, of_words))


def sketch(text: Column) -> Column:
    """The ``KEPT`` smallest distinct anchors of a text, in the order of their first place."""

    def smallest(found: Column) -> Column:
        bound = F.get(F.sort_array(found), F.least(F.size(found), F.lit(KEPT)) - 1)
        return F.when(F.size(found) <= KEPT, found).otherwise(
            _let(bound, lambda top: F.filter(found, lambda x: x <= top))
        )

    return _let(F.array_distinct(anchors(text)), smallest)


def printed(kept: Column) -> Column:
    """A sketch as text: 12 digits for each anchor."""
    return F.array_join(F.transform(kept, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), "")


def in_order(a: Column, b: Column) -> Column:
    """How many of the anchors common to both follow each other in the same order in both: the longest
    increasing run of their places in ``b``, taken in the order of ``a``."""

    def placed(ends: Column, at: Column) -> Column:
        # ends[k] is the smallest place at which a run of k + 1 anchors may end
        before = F.size(F.filter(ends, lambda e: e < at))
        return _let(before, lambda k: F.concat(F.slice(ends, 1, k), F.array(at), F.slice(ends, k + 2, F.lit(KEPT))))

    places = F.transform(F.array_intersect(a, b), lambda x: F.array_position(b, x))
    return F.size(F.aggregate(places, F.array().cast("array<bigint>"), placed))


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors in the same order among the smallest of both sketches; with all in order an
    estimate of the Jaccard similarity of all anchors. 1 for two equal sketches, empty ones too, 0 for one empty one."""

    def share(top: Column) -> Column:
        return in_order(F.array_intersect(a, top), F.array_intersect(b, top)) / F.size(top)

    both = F.slice(F.sort_array(F.array_union(a, b)), 1, KEPT)
    return F.when(a == b, F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(
        _let(both, share)
    )


def _ranges(keys: DataFrame) -> tuple[int, list[int]]:
    """Smallest id, and the ids at which a new range of about ``RANGE_DOCS`` documents begins."""
    n, first = keys.agg(F.count(F.lit(1)), F.min("key")).first()
    parts = min(ceil(n / RANGE_DOCS), MAX_RANGES)
    if parts <= 1:
        return first, []
    cuts = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx("key", cuts, 10 * parts)).first()[0]
    return first, sorted({x for x in found if x > first})


def with_next(docs: DataFrame, id_col: str, text_col: str, carried: dict[str, Column]) -> DataFrame:
    """``key``, the columns ``carried`` and ``next_<name>`` for each of them: the same of the document
    with the next larger id; the largest id is followed by the smallest. A NULL id stands before all others.

    Rows that share an id are all followed by the same document, and of several with the next id
    the one whose text has the smallest hash stands for them. So they need no order among themselves: one of them
    takes part in the search, and the others join what it finds.
    """
    th = F.xxhash64(whole_text(text_col))
    rows = docs.select(id_key(id_col).alias("key"), th.alias("th"), *[c.alias(n) for n, c in carried.items()])
    shared = docs.select(id_key(id_col).alias("key"), th.alias("th")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("th").alias("th")).where("n > 1").select("key", "th")
    shared = stored(shared, "shared-ids")
    if shared.isEmpty():
        return _with_next(rows.drop("th"), list(carried))
    names = list(carried)
    single = rows.join(shared.select("key"), "key", "left_anti").drop("th")
    # copies of one text under one id fold in the map task
    stand = rows.join(shared, ["key", "th"], "left_semi").groupBy("key").agg(*[F.first(n).alias(n) for n in names])
    found = stored(_with_next(single.unionByName(stand), names), "followed")
    # written, so its size is known: one row for each shared id is sent to the rows of those ids, or split by AQE
    following = stored(
        found.select("key", *[f"next_{n}" for n in names]).join(shared.select("key"), "key", "left_semi"), "followers")
    repeated = rows.drop("th").join(following, "key")
    return found.join(shared.select("key"), "key", "left_anti").unionByName(repeated)


def _with_next(rows: DataFrame, names: list[str]) -> DataFrame:
    """The same for rows of ``key`` and ``names`` with no id twice. Documents are dealt by ranges of ids. The first
    one of a range visits the range before, so each row finds its successor in its own task."""
    first, bounds = _ranges(rows.select("key"))
    # bounds in groups: a search looks at one bound of each group and at one group
    width = max(1, isqrt(len(bounds)))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.split(F.lit(",".join(str(g[0]) for g in groups)), ",").cast("array<bigint>")
    tails = F.transform(
        F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"),
        lambda g: F.split(g, ",").cast("array<bigint>"),
    )
    key = F.col("key")
    if bounds:
        rows = rows.withColumn("_group", F.size(F.filter(heads, lambda b: b <= key)))
        rows = rows.withColumn("_inside", F.when(F.col("_group") > 0, F.get(tails, F.col("_group") - 1)))
        rows = rows.withColumn(
            "_passed", F.when(F.col("_group") > 0, F.size(F.filter("_inside", lambda b: b <= key))).otherwise(0))
        at = F.when(F.col("_group") > 0, (F.col("_group") - 1) * width + F.col("_passed")).otherwise(0)
        starts = F.coalesce(F.get("_inside", F.col("_passed") - 1) == key, F.lit(False))
    else:
        at, starts = F.lit(0), F.lit(False)

    def stand(bucket: Column, after: int, guest: bool) -> Column:
        return F.struct(bucket.cast("int").alias("bucket"), F.lit(after).alias("after"), F.lit(guest).alias("guest"))

    places = F.array_compact(F.array(
        stand(at, 0, False),
        F.when(starts, stand(at - 1, 0, True)),
        F.when(key == (first if first is not None else 0), stand(F.lit(len(bounds)), 1, True)),
    ))
    dealt = rows.select("key", *names, F.inline(places))
    order = Window.partitionBy("bucket").orderBy("after", "key")
    following = {f"next_{n}": F.lead(n).over(order) for n in names}
    return dealt.withColumns(following).where(~F.col("guest")).drop("bucket", "after", "guest")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the fingerprint of its text and of its edited text, and two likenesses.

    The edited text has the last half of the code points replaced by as many (or all) first ones of
    the next document. NULL text is empty; an empty text has the empty fingerprint, which is like
    the empty one only; rows that repeat an id, or have none, share the next document; a lone document follows itself. An empty
    table gives an empty table. Columns other than id and text are not read.
    """
    text = whole_text(text_col)
    pairs = with_next(docs.select(id_col, text_col), id_col, text_col, {"text": text, "sketch": sketch(text)})
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.left("text", F.char_length("text") - half), F.left("next_text", half)
    )
    shown = pairs.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch",
    )
    done = shown.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "sketch",
        "next_sketch", sketch(F.col("edited")).alias("edited_sketch"),
    )
    return done.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
