"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.session import materialized

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 40
MIN_DOCS = 5
#: A line held by more than 1/HOT_LIMIT of all (document, line) rows is cut into slices.
HOT_LIMIT = 10_000


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def line_hash(line: Column) -> Column:
    """The 128-bit hash of a line's key, or NULL if the key is too short to count."""
    key = line_key(line)
    return F.when(F.length(key) >= MIN_CHARS, F.unhex(F.md5(key)))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept_text``.

    A key of at least 40 code points found in at least ``min_docs`` documents loses all its lines
    except those of the largest id that holds it. Lines are exploded as 128-bit hashes, once per
    document; distinct documents are counted per hash, partially before each shuffle; only (id,
    hash) pairs of frequent lines meet their documents again, so texts are shuffled once. Hashes are stored, as
    they are read twice. Lines of very many documents, fewer than ``HOT_LIMIT`` by counting alone, meet
    their documents in slices.

    NULL or empty texts are one empty line. Rows that repeat an id are one document for the count
    and for the largest id, and each loses its own lines. Rows without an id count as no document
    and keep their lines. Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.split("text", "\n", -1)
    held = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.explode(F.array_distinct(F.transform(lines, line_hash))).alias("line")
    ).where("line IS NOT NULL")
    held = materialized(held, "line-hashes")
    frequent = materialized(
        held.groupBy("line")
        .agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs),
        "frequent-lines",
    )
    share = F.lit(held.count() // HOT_LIMIT + 1)
    slices = F.ceil(F.col("docs") / share)
    first = F.lit(0).cast("bigint")
    hot = F.broadcast(frequent.where(F.col("docs") > share).select("line", slices.alias("slices")))
    own_slice = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("slices")), first)
    sliced = held.join(hot, "line", "left").select("doc_id", "line", own_slice.alias("slice"))
    keepers = frequent.select("line", "keeper", F.explode(F.sequence(first, slices - 1)).alias("slice"))
    dropped = (
        sliced.join(keepers, ["line", "slice"])
        .where("doc_id < keeper")
        .groupBy("doc_id")
        .agg(F.collect_set("line").alias("dropped"))
    )
    split = docs.join(dropped, "doc_id", "left").select(
        "doc_id", lines.alias("lines"), F.coalesce("dropped", F.array().cast("array<binary>")).alias("dropped")
    )
    stays = F.when(F.size("dropped") == 0, F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.coalesce(F.array_contains(F.col("dropped"), line_hash(x)), F.lit(False)))
    )
    return split.withColumn("kept", stays).select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.array_join("kept", "\n").alias("kept_text"),
    )


ORACLE_SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
each AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM split),
lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM each),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.i, l.line, (f.k IS NOT NULL AND l.doc_id <> f.keeper) AS gone
  FROM lines l LEFT JOIN frequent f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
