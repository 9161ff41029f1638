"""Mixing sources to target weights by hash-random keys and exact budgets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.joins import skew_join
from paytrail.operators.numbering import number_rows
from paytrail.session import materialized

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_RANGE = 20_000
_KEY_BITS = 48


def size(text: Column) -> Column:
    """Words of a text: runs of characters outside ``[\\x20\\x09-\\x0D]``; 0 for NULL."""
    spaced = F.btrim(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " "))
    count = F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1)
    return F.coalesce(count, F.lit(0)).cast("bigint")


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, epochs: int) -> DataFrame:
    """``totals`` (``skey``, ``source_size``) with each source's ``target``.

    Sources by code point, NULL last, take the weights in turn. A source's target is its weight times a
    common level, but at most ``epochs`` times its size. Each round holds the sources above that cap at it
    and shares the rest anew by weight; the held only grow in number, so the rounds end. One row per
    source, numbered by a range sort, so that the number of sources may be large.
    """
    placed = number_rows(totals, [F.when(F.col("skey") == "", 1).otherwise(0), F.col("skey")], "place")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = materialized(placed.withColumn("weight", turn).withColumn("cap", F.col("source_size") * epochs), "weights")
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = (total or 0) * share
    level, held = wanted / weight if weight else 0.0, 0
    while True:
        over = F.col("weight") * level > F.col("cap")
        n, caps, free = weighed.agg(
            F.count_if(over), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == held or not free:
            break
        level, held = (wanted - caps) / free, n
    return weighed.withColumn("target", F.least(F.col("weight") * level, F.col("cap").cast("double"))).drop(
        "weight", "cap", "place"
    )


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    key = F.xxhash64(id_col, source_col, text_col)
    return docs.select(
        F.struct(*docs.columns).alias("row"),
        size(F.col(text_col)).alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("skey"),
        F.shiftrightunsigned(key, 64 - _KEY_BITS).alias("key"),
    )


def cuts(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source of rows (skey, key, size): its target and where its budget ends.

    ``whole`` epochs take every row; of the next one, rows with a key below ``cut_key`` are taken, and
    ``cut_left`` of the ``cut_size`` words at that key. Keys are random, so equal key ranges hold about
    equal rows: sizes are summed per source and range, their running totals find the range in which the
    budget ends, and only that range is sorted row by row.
    """
    totals = sized.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    totals = materialized(totals, "source-totals")
    most = totals.agg(F.max("rows")).first()[0] or 1
    bits = max(0, math.ceil(math.log2(most / ROWS_PER_RANGE)))
    plan = targets(totals.drop("rows"), weights, share, epochs)
    plan = plan.withColumn("budget", F.floor("target"))
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0))
    plan = materialized(plan.withColumn("left", F.col("budget") - F.col("whole") * F.col("source_size")), "budgets")

    ranged = sized.select("skey", "key", "size", F.shiftright("key", _KEY_BITS - bits).alias("range"))
    running = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("skey", "range").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    crossed = sums.join(plan.where("left > 0").select("skey", "left"), "skey").where("before < left AND left <= before + words")

    inside = skew_join(ranged, crossed.select("skey", "range", "before", "left"), ["skey", "range"], "inner")
    keyed = inside.groupBy("skey", "before", "left", "key").agg(F.sum("size").alias("cut_size"))
    running = Window.partitionBy("skey").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("cut_size").over(running), F.lit(0))
    ends = keyed.withColumn("at", at).where("at < left AND left <= at + cut_size").select(
        "skey", F.col("key").alias("cut_key"), (F.col("left") - F.col("at")).alias("cut_left"), "cut_size"
    )
    return materialized(plan.select("skey", "source_size", "target", "whole").join(ends, "skey", "left"), "cuts")


def _taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    part = (
        F.when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), F.floor(F.col("size") * F.col("cut_left") / F.col("cut_size")))
        .otherwise(0)
    )
    joined = skew_join(sized, plan, ["skey"], "left", traffic=sized.select("skey"))
    return joined.withColumn("taken", (F.col("whole") * F.col("size") + part).cast("bigint"))


def mix_words(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    Sources share 150% of all words by weights 5, 2, 1, none above twice its own size. Rows get a random
    key from a hash of id, source and text; in that order each source is taken whole as often as its budget
    allows, and then up to the budget exactly, which may end within a document.

    NULL and wordless texts have size 0 and are taken for 0 words. A NULL source is a source of its own.
    Rows without an id are mixed like others. Equal rows share a key, and share what is taken at it evenly.
    Without any words every target is 0. Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    sized = _sized(docs, "doc_id", "source", "text").withColumn("row", F.col("row.doc_id"))
    sized = materialized(sized, "sizes")
    return _taken(sized, cuts(sized)).select(F.col("row").alias("doc_id"), "size", "source_size", "target", "taken")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in the mixture: once for each epoch that takes at least half of the row's words.

    Rows keep all their columns, whatever these are called. Texts are not moved: each row compares its own
    key with its source's cut. Wordless rows follow their source's epochs and their own key.
    """
    sized = _sized(docs, id_col, source_col, text_col)
    lean = materialized(sized.select("skey", "key", "size"), "sizes")
    joined = skew_join(sized, cuts(lean), ["skey"], "left", traffic=lean)
    partial = (F.col("key") < F.col("cut_key")) | (
        (F.col("key") == F.col("cut_key")) & (2 * F.col("cut_left") >= F.col("cut_size"))
    )
    copies = (F.col("whole") + F.coalesce(partial, F.lit(False)).cast("bigint")).cast("int")
    repeated = F.explode(F.array_repeat(F.lit(True), copies))
    return joined.select("row", repeated.alias("copy")).select("row.*")
