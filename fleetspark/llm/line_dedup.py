"""Line deduplication across documents.

Lines are exploded, hashed and counted by distinct documents; the lines of a key that too many
documents hold are dropped everywhere but in the document with the largest id, and what stays is
put together again by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import WHITE, ascii_lower, digest, id_key, stored, whole_text


def _exploded(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """The lines long enough to count: document, hash of its text, position, hash of the key."""
    lines = docs.select(
        id_key(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("th"),
        F.posexplode(F.split(whole_text(text_col), "\n")).alias("pos", "line"),
    )
    keyed = lines.withColumn("line", F.btrim("line", F.lit(WHITE)))
    high, low = digest(ascii_lower(F.col("line")))
    return keyed.where(F.char_length("line") >= min_chars).select(
        "id", "th", "pos", high.alias("h1"), low.alias("h2")
    )


def line_report(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``row`` (the row as a struct), ``kept`` (its text without dropped
    lines), ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at both ends, with A-Z in lower case. A key
    of at least ``min_chars`` code points found in at least ``min_docs`` documents keeps its lines
    in the document with the largest id only, there all of them.

    NULL text is one empty line; all rows with a NULL id count as one document with the smallest
    id; rows that repeat an id count as one document. An empty table gives an empty table. Other
    columns travel in ``row`` and may have any name.

    Texts are split and lines hashed once, into a stored table of numbers. A hot line costs one row per document: counts
    are pre-aggregated before each shuffle, and the table of repeated keys is written first, so that Spark can split a
    hot key of the join.
    """
    lines = stored(_exploded(docs, id_col, text_col, min_chars), "line-keys")
    repeated = stored(
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("id").alias("n"), F.max("id").alias("holder"))
        .where(F.col("n") >= min_docs).select("h1", "h2", "holder"),
        "lines",
    )
    gone = (
        lines.join(repeated, ["h1", "h2"]).where(F.col("id") != F.col("holder"))
        .groupBy("id", "th").agg(F.collect_set("pos").alias("gone"))
    )
    rows = docs.select(
        F.struct("*").alias("row"), id_key(id_col).alias("id"), whole_text(text_col).alias("text"),
        F.xxhash64(whole_text(text_col)).alias("th"),
    )
    split = F.split("text", "\n")
    last = F.size(split) - 1
    left = F.array_except(F.sequence(F.lit(0), last), F.col("gone"))
    cut = F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    return rows.join(gone, ["id", "th"], "left").select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(cut).alias("kept"),
        (last + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text",
    length_col: str = "n_chars",
) -> DataFrame:
    """``docs`` with repeated lines taken out of the text (see ``line_report``); a text that loses
    none stays as it is, NULL too. ``length_col``, if there is one, follows the new text."""
    report = line_report(docs, min_docs, min_chars, id_col, text_col)
    changed = F.col("n_dropped") > 0

    def value(name: str):
        old = F.col("row").getField(name)
        if name == text_col:
            return F.when(changed, F.col("kept")).otherwise(old).alias(name)
        if name == length_col:
            kind = docs.schema[name].dataType
            return F.when(changed, F.char_length("kept").cast(kind)).otherwise(old).alias(name)
        return old.alias(name)

    return report.select(*[value(c) for c in docs.columns])


def line_digests(docs: DataFrame) -> DataFrame:
    """What the registered query returns of each document."""
    return line_report(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, pos, line, holder IS NOT NULL AND holder <> doc_id AS gone
  FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
