"""Sharding by extendible hashing, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.joins import skew_join
from paytrail.session import materialized

SHARD_BYTES = 16 << 20
HASH_BITS = 60
_STEP = 8  # bits by which a cell of the histogram is finer than the mean shard


def hash_bits(id_col: Column) -> Column:
    """The first 60 bits of the MD5 of an id's text, as a bigint; NULL counts as the empty text."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _prefix(bits: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", bits, F.lit(HASH_BITS) - depth)


def _bit_text(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(prefix.cast("string"), 10, 2), depth, "0"))


def directory(sized: DataFrame, limit: int) -> DataFrame:
    """The leaves of the directory for rows (``bits``, ``n_bytes``), keyed by cells that cover them.

    Returns ``cell_depth``, ``cell`` (the first ``cell_depth`` bits), ``depth``, ``shard_bytes``, ``shard_docs``:
    the cell lies in the leaf made of its first ``depth`` bits. A bucket is a leaf once its bytes are within
    ``limit``, or its bits are spent. Bytes are first summed into cells some bits finer than the mean shard;
    only cells that are too large themselves are summed again, finer, until none is left.
    """
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    low, fine = 0, min(HASH_BITS, _STEP + max(0, math.ceil(math.log2(max(1, total) / limit))))
    rest, out = sized, None
    while True:
        cells = materialized(
            rest.groupBy(_prefix(F.col("bits"), fine).alias("cell")).agg(
                F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_docs")
            ),
            "cells",
        )
        up = F.explode(F.sequence(F.lit(low), F.lit(fine))).alias("depth")
        buckets = (
            cells.select("*", up)
            .groupBy("depth", F.expr(f"shiftright(cell, {fine} - depth)").alias("prefix"))
            .agg(F.sum("n_bytes").alias("shard_bytes"))
        )
        # a cell lies in the first bucket on its way down that fits: one bit below the deepest that does not
        large = (F.col("shard_bytes") > limit) & (F.col("depth") < HASH_BITS)
        split = buckets.where(large).select("depth", "prefix")
        way = cells.select("cell", up).withColumn("prefix", F.expr(f"shiftright(cell, {fine} - depth)"))
        deepest = way.join(split, ["depth", "prefix"]).groupBy("cell").agg(F.max("depth").alias("deepest"))
        placed = cells.join(deepest, "cell", "left").withColumn("depth", F.coalesce(F.col("deepest") + 1, F.lit(low)))
        placed = placed.where(F.col("depth") <= fine).withColumn("prefix", F.expr(f"shiftright(cell, {fine} - depth)"))
        leaves = placed.groupBy("depth", "prefix").agg(
            F.sum("n_bytes").alias("shard_bytes"), F.sum("n_docs").alias("shard_docs")
        )
        found = placed.select("cell", "depth", "prefix").join(leaves, ["depth", "prefix"]).select(
            F.lit(fine).alias("cell_depth"), "cell", "depth", "shard_bytes", "shard_docs"
        )
        out = found if out is None else out.union(found)
        large = cells.where(F.col("n_bytes") > limit).select("cell")
        if fine == HASH_BITS or large.isEmpty():
            return materialized(out, "directory")
        rest = rest.withColumn("cell", _prefix(F.col("bits"), fine)).join(large, "cell", "left_semi")
        rest = rest.select("bits", "n_bytes")
        low, fine = fine + 1, min(HASH_BITS, fine + _STEP)


def shard(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``depth``, ``shard``, ``part``, ``shard_bytes``, ``shard_docs``.

    ``shard`` holds the leading hash bits of the bucket as text ('' while one bucket is enough) and
    ``depth`` their number. Only a bucket with more than ``limit`` bytes of UTF-8 text splits, on one more
    bit, so every shard fits, unless it consists of rows whose ids agree in all 60 bits: those are cut by
    running bytes into numbered parts (``part``, else 0), and only a single row above the limit exceeds it.

    NULL or empty texts have 0 bytes; rows without an id hash as the empty text. Rows that repeat an id
    share a shard. Other columns are ignored. An empty table gives no rows.
    """
    sized = materialized(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
            hash_bits(F.col(id_col)).alias("bits"),
        ),
        "sizes",
    )
    leaves = directory(sized, limit)
    depths = sorted(r[0] for r in leaves.select("cell_depth").distinct().collect())  # 8 at most
    out = None
    for fine in depths:
        lookup = leaves.where(F.col("cell_depth") == fine).drop("cell_depth")
        rows = skew_join(sized.withColumn("cell", _prefix(F.col("bits"), fine)), lookup, ["cell"], "inner")
        out = rows if out is None else out.union(rows)
    if out is None:
        empty = {"cell": "bigint", "depth": "int", "shard_bytes": "bigint", "shard_docs": "bigint"}
        out = sized.withColumns({k: F.lit(None).cast(v) for k, v in empty.items()})
    whole = out.where(F.col("shard_bytes") <= limit).withColumn("part", F.lit(0).cast("bigint"))
    # a larger leaf holds rows of one hash: equal rows are counted, placed together and spread out again
    keys = [c for c in out.columns if c != "cell"]
    counted = out.where(F.col("shard_bytes") > limit).groupBy(*keys).agg(F.count(F.lit(1)).alias("equal"))
    run = Window.partitionBy("bits").orderBy("n_bytes", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("n_bytes") * F.col("equal")).over(run), F.lit(0))
    spread = counted.withColumn("before", before).select("*", F.explode(F.expr("sequence(0L, equal - 1)")).alias("nth"))
    # parts begin every half limit; a row above half the limit has a part of its own
    start = F.col("before") + F.col("nth") * F.col("n_bytes")
    part = F.floor(2 * start / F.lit(limit)) + (2 * F.col("n_bytes") > limit).cast("bigint")
    same = spread.withColumn("part", part.cast("bigint"))
    return whole.unionByName(same.select(*whole.drop("cell").columns), allowMissingColumns=True).select(
        "doc_id", "n_bytes", "depth", _bit_text(_prefix(F.col("bits"), F.col("depth")), F.col("depth")).alias("shard"),
        "part", "shard_bytes", "shard_docs",
    )


#: For one limit and whole tables; depths up to 40 bits cover them.
ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {HASH_BITS // 4}))::BIGINT AS bits
  FROM documents),
buckets AS (
  SELECT d.depth, bits >> ({HASH_BITS} - d.depth)::INT AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
  FROM sized, range(0, 41) AS d(depth) GROUP BY ALL),
leaf AS (
  SELECT s.doc_id, s.n_bytes, s.bits, min(b.depth) AS depth
  FROM sized s JOIN buckets b ON b.prefix = s.bits >> ({HASH_BITS} - b.depth)::INT
  WHERE b.shard_bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT l.doc_id, l.n_bytes, l.depth::INT AS depth,
       CASE WHEN l.depth = 0 THEN '' ELSE right(lpad(bin(b.prefix), 64, '0'), l.depth::INT) END AS shard,
       0::BIGINT AS part, b.shard_bytes, b.shard_docs
FROM leaf l JOIN buckets b ON b.depth = l.depth AND b.prefix = l.bits >> ({HASH_BITS} - l.depth)::INT
"""
