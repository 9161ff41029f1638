"""Joins that keep every task bounded when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytrail.config import HOT_KEY_LIMIT


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; negative when broadcasting is off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    if text[-1:] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None where it cannot be asked."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except AttributeError:
        return None


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the plan's estimated size is proven to be within the limit."""
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    size = estimated_bytes(df)
    return size is not None and size <= limit


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def hot_keys(rows: DataFrame, keys: list[str], limit: int = HOT_KEY_LIMIT) -> DataFrame:
    """Keys holding more than 1/limit of all rows, and the slices that brings each down to it.

    By counting alone there are fewer than ``limit`` such keys and 2 x ``limit`` slices.
    """
    frequency = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = frequency.agg(F.sum("_n")).scalar()
    known = _all([F.col(k).isNotNull() for k in keys])
    slices = F.ceil(F.col("_n") * limit / total).cast("int").alias("_slices")
    return frequency.where(known & (F.col("_n") * limit > total)).select(*keys, slices)


def skew_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "left",
    condition: Column | None = None,
    traffic: DataFrame | None = None,
    limit: int | None = None,
    hot_limit: int = HOT_KEY_LIMIT,
) -> DataFrame:
    """Left or inner equi-join of a large side to a keyed side, with an optional residual.

    A keyed side within the broadcast limit is broadcast. Beyond it the two sides meet
    in one shuffle join on the key and a slice number: a hot key is cut into as many
    slices as its share asks for, and its few keyed rows are repeated per slice.
    The slice of a fact row follows from its input partition, so it splits equal copies
    and is the same when a task runs again. ``traffic`` is any frame with the key
    distribution of the fact side, or of some of its keys: whoever is frequent on all
    keys is so on each. Give the base table when the fact side is long to compute,
    since counting its keys would compute it twice.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    dim_keys = {k: f"_dim_{k}" for k in keys}
    on = _all([F.col(k) == F.col(dim_keys[k]) for k in keys])
    if condition is not None:
        on = on & condition
    if is_small(dim, limit):
        lookup = F.broadcast(dim.withColumnsRenamed(dim_keys))
        return fact.join(lookup, on, how).drop(*dim_keys.values())

    traffic = fact if traffic is None else traffic
    counted = [k for k in keys if k in traffic.columns]
    hot = F.broadcast(hot_keys(traffic, counted, hot_limit))
    known = _all([F.col(k).isNotNull() for k in keys])
    here = F.spark_partition_id()
    row_slice = F.when(known, F.coalesce(F.pmod(here, F.col("_slices")), F.lit(0))).otherwise(here)
    all_slices = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    sliced = fact.join(hot, counted, "left").select(*fact.columns, row_slice.alias("_slice"))
    repeated = (
        dim.join(hot, counted, "left")
        .select(*dim.columns, F.explode(all_slices).alias("_dim_slice"))
        .withColumnsRenamed(dim_keys)
    )
    joined = sliced.join(repeated, on & (F.col("_slice") == F.col("_dim_slice")), how)
    return joined.drop("_slice", "_dim_slice", *dim_keys.values())


def full_join(fact: DataFrame, keyed: DataFrame, keys: list[str], hot_limit: int = HOT_KEY_LIMIT) -> DataFrame:
    """Full outer equi-join of a large side to a side with one row per key: keys, then both sides' other columns.

    Both sides are appended and meet in one shuffle on the key and a slice number; a window hands each large row its
    keyed row, and a keyed row stays if it meets none. A hot key's slices repeat its keyed row, which
    has been met by definition. NULL keys match nothing and stay spread. Beyond the one read of
    each side, only the large side's keys are counted. Two keyed rows with one key are an error.
    """
    hot = F.broadcast(hot_keys(fact, keys, hot_limit))
    known = _all([F.col(k).isNotNull() for k in keys])
    here, marker = F.spark_partition_id(), F.lit(True).alias("_row")
    others = [c for c in fact.columns if c not in keys]
    attributes = [c for c in keyed.columns if c not in keys]
    own_slice = F.when(known, F.coalesce(F.pmod(here, F.col("_slices")), F.lit(0))).otherwise(here)
    all_slices = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    large = fact.join(hot, keys, "left").select(
        *keys, own_slice.alias("_slice"), F.struct(*others, marker).alias("_large")
    )
    small = keyed.join(hot, keys, "left").select(
        *keys,
        F.explode(all_slices).alias("_slice"),
        F.col("_slices").isNull().alias("_may_stay"),
        F.struct(*attributes, marker).alias("_keyed"),
    )
    meeting = Window.partitionBy(*keys, "_slice")
    both = large.unionByName(small, allowMissingColumns=True).withColumns(
        {
            "_met": F.when(known, F.first("_keyed", ignorenulls=True).over(meeting)),
            "_larges": F.count("_large").over(meeting),
            "_keyeds": F.count("_keyed").over(meeting),
        }
    )
    message = f"several keyed rows share one key ({', '.join(keys)})"
    single = F.when(~known | (F.col("_keyeds") <= 1), F.lit(True)).otherwise(
        F.raise_error(F.lit(message)).cast("boolean")
    )
    is_large = F.col("_large").isNotNull()
    kept = both.where(single).where(is_large | ~known | (F.col("_may_stay") & (F.col("_larges") == 0)))
    row = F.when(is_large, F.col("_met")).otherwise(F.col("_keyed")).alias("_side")
    return kept.select(*keys, "_large", row).select(
        *keys, *[f"_large.{c}" for c in others], *[f"_side.{c}" for c in attributes]
    )


def exclusive_periods(
    history: DataFrame, keys: list[str], start: str, end: str, payload: list[str]
) -> DataFrame:
    """Cut closed, possibly overlapping periods so that each day has one owner per key.

    The owner of a day is the period with the earliest start (then earliest end, then
    lowest payload) that covers it. In that order a period owns exactly the
    days after the latest end seen so far, so one running maximum settles it.
    Equal periods are merged first, which bounds a key's group by its distinct
    date pairs rather than by its rows. Output: keys, ``_from``, ``_to``, payload.
    """
    periods = (
        history.where(F.col(start).isNotNull())
        .withColumn("_close", F.coalesce(F.col(end), F.to_date(F.lit("9999-12-31"))))
        .groupBy(*keys, F.col(start).alias("_open"), "_close")
        .agg(F.min(F.struct(*payload)).alias("_payload"))
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_open", "_close")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        periods.withColumn("_covered", F.max("_close").over(earlier))
        .withColumn("_from", F.greatest("_open", F.date_add("_covered", 1)))
        .where(F.col("_from") <= F.col("_close"))
        .select(*keys, "_from", F.col("_close").alias("_to"), "_payload.*")
    )


# What cutting periods by spans adds at most: a row per span touched, one for each end.
_GROWTH = 3


def _calendar(history: DataFrame, keys: list[str], start: str) -> Column:
    """First and last start of a history and the days of a span, as one value.

    A span is as long as the average period would be if every key had periods from the first to the last
    start. All periods cut by span are then at most three times as many as the rows of the history.
    """
    opened = F.col(start).cast("date")
    days = F.datediff(F.max(opened), F.min(opened)) + 1
    key_count = F.approx_count_distinct(F.struct(*keys))
    width = F.greatest(F.ceil(days * key_count / F.count(opened)), F.lit(1))
    bounds = F.struct(F.min(opened).alias("first"), F.max(opened).alias("last"), width.alias("width"))
    return history.where(opened.isNotNull()).agg(bounds).scalar()


def _span(day: Column, calendar: Column) -> Column:
    """The span a day falls into; all days after the last start fall into the last one."""
    within = F.least(day.cast("date"), calendar["last"])
    return F.when(day.isNotNull(), F.floor(F.datediff(within, calendar["first"]) / calendar["width"]))


def as_of_join(
    left: DataFrame,
    history: DataFrame,
    keys: list[str],
    at: str,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    payload: list[str] | None = None,
    how: str = "left",
    traffic: DataFrame | None = None,
    limit: int | None = None,
    hot_limit: int = HOT_KEY_LIMIT,
    spans: bool | None = None,
) -> DataFrame:
    """Attach the history row in force on the day ``at``; both period ends are inclusive.

    On a day shared by two periods the earlier one wins. Since the periods are made
    exclusive first, a left row meets at most one of them and no ranking of the
    large side is needed. Beyond the broadcast limit, periods are cut by the spans of days they touch
    and joined on key and span, so a row is compared with the periods of its key in one span, however
    many the key has. Setting the spans reads the history's starts once more; ``spans`` asks for them in a
    small history whose keys have thousands of periods, too.
    """
    payload = payload or [c for c in history.columns if c not in {*keys, start, end}]
    if spans is None:
        spans = not is_small(history, limit)
    in_force = F.col(at).between(F.col("_from"), F.col("_to"))
    if not spans:
        periods = exclusive_periods(history, keys, start, end, payload)
        return skew_join(left, periods, keys, how, in_force, traffic, limit, hot_limit).drop("_from", "_to")
    calendar = _calendar(history, keys, start)
    touched = F.sequence(_span(F.col("_from"), calendar), _span(F.col("_to"), calendar))
    periods = exclusive_periods(history, keys, start, end, payload).withColumn("_span", F.explode(touched))
    if limit is None:
        limit = broadcast_limit(left.sparkSession)
    dated = left.withColumn("_span", _span(F.col(at), calendar))
    joined = skew_join(
        dated, periods, [*keys, "_span"], how, in_force, traffic, limit // _GROWTH if limit > 0 else limit, hot_limit
    )
    return joined.drop("_from", "_to", "_span")
