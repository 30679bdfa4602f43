"""Benchmark decontamination by SimHash windows, in SQL expressions alone.

A window has the size of a benchmark item and starts at any word from where it holds as many of the
item's shingles as the similarity asked for needs; other windows cannot reach it. Windows and items have
64-bit SimHashes;
blocks of bits, one more than the radius, find all pairs within the radius. Exact weighted similarity of
the shingles decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.llm.common import NO_ID, id_key, stored, whole_text

SHINGLE, SIMILAR = 5, 0.8
BITS = 64
#: sets of similarity 0.8 differ in 9.7 bits on average, 2.9 being the standard deviation: this is 5 of them
RADIUS = 24


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of the runs of letters and digits, in lower case."""
    words = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order; empty for fewer words."""
    if size == 1:
        return F.transform(words, lambda w: F.xxhash64(w, F.lit(1)))
    places = F.sequence(F.lit(0), F.size(words) - size)
    if size < 4:
        runs = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))
    else:  # runs of two, hashed once, shorten the longer ones
        two = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
        runs = _let(two, lambda t: F.transform(
            places, lambda i: F.xxhash64(*[F.get(t, i + j) for j in range(0, size - 1, 2)], F.get(words, i + size - 1))))
    return F.when(F.size(words) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def sized_shingles(words: Column, size: Column) -> Column:
    """Shingles whose size, 1 to 5, is a column."""
    out = F.array().cast("array<bigint>")
    for k in range(1, SHINGLE + 1):
        out = F.when(size == k, shingles(words, k)).otherwise(out)
    return out


def simhash(hashes: Column) -> Column:
    """Bit b is set when more hashes have it set than not; repeated shingles weigh as often."""
    def votes(b: Column) -> Column:
        return F.aggregate(hashes, F.lit(0), lambda n, h: n + F.when(F.getbit(h, b) == 1, 1).otherwise(-1))

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"),
        lambda out, b: F.when(votes(b) > 0, out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(out))


def blocks(code: Column, radius: int = RADIUS) -> Column:
    """The code cut in ``radius + 1`` blocks: two codes within the radius have one in common."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(code, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])


def numbered(hashes: Column) -> Column:
    """Equal shingles told apart by their number, so that set operations count them."""
    return _let(F.array_sort(hashes), lambda s: F.transform(
        s, lambda x, i: F.xxhash64(x, i + 1 - F.array_position(s, x))))


def weighted_similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of numbered shingles."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def window_starts(places: Column, length: Column, n: Column, k: Column, similar: float) -> Column:
    """All starts of windows of ``n`` words that hold enough of an item's shingles, which stand at
    ``places``, in order, of a document of ``length`` words. Sets of m and w shingles of the similarity
    have similar / (1 + similar) * (m + w) in common."""
    last = n - k
    need = F.ceil((last + 1 + F.least(last, length - k) + 1) * (similar / (1 + similar)) - 1e-6).cast("int")

    def starts(need: Column) -> Column:
        # so many places in a row lie in the windows from the last one's distance to the first one
        low = lambda i: F.get(places, i + need - 1) - last
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - need), lambda i: _let(
            F.greatest(low(i), F.coalesce(F.get(places, i - 1) + 1, low(i))),
            lambda lo: F.when(lo <= F.get(places, i), F.sequence(lo, F.get(places, i))).otherwise(F.array().cast("array<int>")))))

    inside = lambda at: F.greatest(F.lit(0), F.least(at, length - n))
    return _let(need, lambda c: F.when(F.size(places) >= c, F.array_distinct(F.transform(starts(c), inside))))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """The items with their shingles and SimHash, stored; items without words match nothing."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(whole_text()).alias("words"))
    items = items.where(F.size("words") > 0).distinct()
    items = items.withColumn("n", F.size("words")).withColumn("k", F.least("n", F.lit(SHINGLE)))
    items = items.withColumn("hashes", sized_shingles(F.col("words"), F.col("k")))
    return stored(
        items.select(
            F.xxhash64("item_id", "words").alias("item"), "item_id", "n", "k", "hashes",
            simhash(F.col("hashes")).alias("code"), numbered(F.col("hashes")).alias("numbers")),
        "items")


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    similar: float = SIMILAR, radius: int = RADIUS,
) -> DataFrame:
    """``id``, ``th`` (hash of the text), ``item_id``, ``similarity`` of the best window and its first
    word, ``start``; one row per document and item that reach ``similar``.

    Words are runs of letters and digits in lower case; an item of fewer than five words is one
    shingle. NULL or empty texts and items match nothing; a NULL document id is the smallest id, a NULL
    item id stays NULL; repeated rows give one row. Other columns are not read.

    The items are written first, so Spark knows their size: it sends a small table to all tasks and
    then no shingle moves; a large one is joined by shuffle. The starts that the shingles found
    allow are written too and joined to the texts; windows carry hashes of their own words only and are written.
    """
    items = benchmark_items(benchmark)
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most five
    texts = docs.select(
        id_key(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("th"), whole_text(text_col).alias("text"))
    rows = texts.select("id", "th", word_hashes(F.col("text")).alias("words")).withColumn("length", F.size("words"))
    hits = None
    for k in sizes:
        wanted = stored(
            items.where(F.col("k") == k).select("item", "n", F.explode(F.array_distinct("hashes")).alias("hash")), "shingles")
        # the outer form: for the plain one Spark adds a filter on the array's size below, with the words
        # put into the lambda, where they would be split again for every shingle
        runs = rows.select("id", "th", "length", F.posexplode_outer(shingles(F.col("words"), k)).alias("pos", "hash"))
        placed = runs.join(wanted, "hash")
        found = placed.select("id", "th", "length", "item", "n", F.lit(k).alias("k"), "pos")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:  # no item has a word
        nothing = "id long, th long, item_id long, similarity double, start int"
        return docs.sparkSession.createDataFrame([], nothing)
    hits = hits.groupBy("id", "th", "length", "item", "n", "k").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    # fewer places than this share of the item's are enough nowhere
    hits = hits.where(F.size("places") >= similar * (F.col("n") - F.col("k") + 1) - 1e-6)
    starts = window_starts(F.col("places"), F.col("length"), F.col("n"), F.col("k"), similar)
    hits = stored(hits.select("id", "th", "item", "n", "k", starts.alias("starts")), "hits")
    held = texts.join(hits.where("size(starts) > 0"), ["id", "th"]).withColumn("words", word_hashes(F.col("text")))
    windows = held.select("id", "th", "item", "n", "k", "words", F.explode("starts").alias("start"))
    windows = windows.select(
        "id", "th", "item", "k", "start", F.slice("words", F.col("start") + 1, F.col("n")).alias("words")).distinct()
    windows = windows.select("id", "th", "item", "start", sized_shingles(F.col("words"), F.col("k")).alias("hashes"))
    # written too: else Spark tests the codes for NULL below the join above, spelled out down to the text
    coded = stored(windows.withColumn("code", simhash(F.col("hashes"))), "windows")
    probes = coded.select("*", F.inline_outer(blocks(F.col("code"), radius)))
    indexed = stored(items.select("item", F.col("code").alias("item_code"), F.inline(blocks(F.col("code"), radius))), "blocks")
    near = (
        probes.join(indexed, ["item", "block", "bits"])
        .where(F.bit_count(F.col("code").bitwiseXOR(F.col("item_code"))) <= radius)
        .select("id", "th", "item", "start", "hashes").distinct()
    )
    exact = near.join(items.select("item", "item_id", "numbers"), "item").select(
        "id", "th", "item_id", "start", weighted_similarity(numbered(F.col("hashes")), F.col("numbers")).alias("similarity"))
    best = exact.where(F.col("similarity") >= similar).groupBy("id", "th", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    return best.select("id", "th", "item_id", "best.similarity", (-F.col("best.back")).alias("start"))


def leaked_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What the registered query returns: documents and the items found in them."""
    return leaks(docs, benchmark).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "item_id", "similarity", F.col("start").alias("start_word"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    lost = stored(leaks(docs, benchmark, id_col, text_col).select("id", "th").distinct(), "leaked")
    rows = docs.select(F.struct("*").alias("row"), id_key(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("th"))
    return rows.join(lost, ["id", "th"], "left_anti").select("row.*")
