"""Type-2 history: building, reading, keyed upsert and merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.numbering import collapse_copies, expand_copies

START, END, CURRENT = "effective_start_date", "effective_end_date", "is_current"


def build_history(changes: DataFrame, key: str, at: str, attributes: list[str]) -> DataFrame:
    """Turn dated changes into periods: each ends on the day the next one starts.

    The window sees each distinct change once, so a key's group is bounded by its
    calendar days and attribute values, not by its rows.
    """
    distinct = collapse_copies(changes, [key, at, *attributes])
    following = F.lead(at).over(Window.partitionBy(key).orderBy(at, *attributes))
    periods = expand_copies(distinct.withColumn("_next", following))
    end = F.when(F.col("_copy") < F.col("_copies"), F.col(at)).otherwise(F.col("_next"))
    return periods.select(
        key, *attributes, F.col(at).alias(START), end.alias(END), end.isNull().alias(CURRENT)
    )


def current_dimension(dim: DataFrame, current: str = CURRENT) -> DataFrame:
    """The rows in force now; prunes to one folder when stored by the flag (then read as text)."""
    return dim.where(F.col(current).cast("boolean"))


def with_version_key(
    history: DataFrame, key: str, name: str, start: str = START
) -> DataFrame:
    """Add ``<key>_<n>``, n counting a key's periods by start (ties by all columns)."""
    rest = [c for c in history.columns if c not in (key, start)]
    through = (
        Window.partitionBy(key)
        .orderBy(start, *rest)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    distinct = collapse_copies(history, history.columns)
    numbered = expand_copies(distinct.withColumn("_through", F.sum("_copies").over(through)))
    version = F.col("_through") - F.col("_copies") + F.col("_copy")
    return numbered.select(
        *history.columns, F.concat_ws("_", F.col(key).cast("string"), version).alias(name)
    )


def _keyed(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def reject_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; running the plan fails if two of them share a non-NULL key."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*(rest or keys))
    per_key = df.where(_keyed(keys)).groupBy(*keys)
    grouped = per_key.agg(F.any_value(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
    message = f"several source rows share one key ({', '.join(keys)})"
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(message)).cast("boolean")
    )
    kept = grouped.where(single).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
    return kept.unionByName(df.where(~_keyed(keys)))


def _together(keys: list[str], gather: list[str] | None) -> list[str]:
    return list(dict.fromkeys([*(gather or []), *keys]))


def _beside_update(target: DataFrame, batch: DataFrame, keys: list[str], gather: list[str] | None = None) -> DataFrame:
    """Target rows (``_old``) and batch rows (``_new``) as structs in one frame, shuffled once by key.

    Every row knows of its key the batch row (``_update``) and the number of target rows (``_olds``).
    Rows without a whole key know of none and stay spread by input partition. Two batch rows with one key
    are an error. A key's rows meet in one window, which spills; a keyed table holds few per key. With
    ``gather``, columns that the key determines, rows move by these alone.
    """
    known = _keyed(keys)
    apart = F.when(known, F.lit(0)).otherwise(F.spark_partition_id() + 1).alias("_apart")
    by = _together(keys, gather)
    old = target.select(*by, apart, F.struct(*target.columns).alias("_old"))
    new = batch.select(*by, apart, F.struct(*batch.columns).alias("_new"))
    both = old.unionByName(new, allowMissingColumns=True)
    if gather:
        both = both.repartition(*gather)
    same_key = Window.partitionBy(*by, "_apart")
    message = f"several source rows share one key ({', '.join(keys)})"
    single = F.when(~known | (F.col("_news") <= 1), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return both.withColumns(
        {
            "_update": F.when(known, F.first("_new", ignorenulls=True).over(same_key)),
            "_olds": F.when(known, F.count("_old").over(same_key)).otherwise(0),
            "_news": F.count("_new").over(same_key),
        }
    ).where(single)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], gather: list[str] | None = None) -> DataFrame:
    """Keyed merge: matched target rows take the source's values, other source rows are added.

    Both tables are appended, shuffled once by key and settled row by row, each read once. Source columns
    are cast to the target's types. NULL keys match nothing. Two source rows with one key are an error.
    """
    types = dict(target.dtypes)
    typed = source.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])
    both = _beside_update(target, typed, keys, gather)
    is_old = F.col("_old").isNotNull()
    kept = both.where(is_old | (F.col("_olds") == 0))
    row = F.when(~is_old, F.col("_new")).otherwise(F.coalesce("_update", "_old"))
    return kept.select(row.alias("_row")).select("_row.*")


def _differs(tracked: list[str], null_safe: bool) -> Column:
    """Whether a tracked column changed; NULL-unsafe mode sees no change from or to NULL."""

    def one(c: str) -> Column:
        old, new = F.col(f"_old.{c}"), F.col(f"_update.{c}")
        return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))

    return reduce(lambda a, b: a | b, [one(c) for c in tracked])


def _settled(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: list[str],
    current: str = CURRENT,
    null_safe: bool = True,
    gather: list[str] | None = None,
) -> DataFrame:
    """Open target rows beside their updates; ``_changed`` tells whether any open row of the key differs."""
    both = _beside_update(target.where(_is_open(current)), updates, [key], gather)
    hit = F.col("_old").isNotNull() & F.col("_update").isNotNull() & _differs(tracked, null_safe)
    return both.withColumn("_changed", F.bool_or(hit).over(Window.partitionBy(*_together([key], gather), "_apart")))


def _is_open(current: str) -> Column:
    return F.coalesce(F.col(current).cast("boolean"), F.lit(False))


def scd2_changed_keys(
    target: DataFrame, updates: DataFrame, key: str, tracked: list[str], current: str = CURRENT, null_safe: bool = True
) -> DataFrame:
    """Keys whose current row differs from its update."""
    both = _settled(target, updates, key, tracked, current, null_safe)
    return both.where(F.col("_new").isNotNull() & F.col(key).isNotNull() & F.col("_changed")).select(key)


def scd2_new_keys(target: DataFrame, updates: DataFrame, key: str, current: str = CURRENT) -> DataFrame:
    """Updates whose key has no current row, be it unknown or closed."""
    both = _beside_update(target.where(_is_open(current)).select(key), updates, [key])
    return both.where(F.col("_new").isNotNull() & F.col(key).isNotNull() & (F.col("_olds") == 0)).select("_new.*")


def scd2_seed(updates: DataFrame, end: str = END, current: str = CURRENT) -> DataFrame:
    """The first load: every row open and current."""
    return updates.withColumns({current: F.lit(True), end: F.lit(None).cast("date")})


def scd2_merge(
    target: DataFrame | None,
    updates: DataFrame,
    key: str,
    tracked: list[str],
    end: str = END,
    current: str = CURRENT,
    close_date: Column | None = None,
    close_before: str | None = None,
    null_safe: bool = True,
    gather: list[str] | None = None,
) -> DataFrame:
    """The whole new state of a Type-2 dimension after one batch of updates.

    A changed key's current row is closed on ``close_date`` (today by default; with
    ``close_before``, the day before that start column of the update) and its update
    opens a new version; keys without a current row are added; everything
    else stays. ``updates`` holds one row per key; those without a key are left out.

    Open rows and updates are appended and shuffled once by key; each row then tells by itself whether it
    stays, closes, opens or goes. Closed rows pass by without a shuffle.
    """
    if target is None:
        return scd2_seed(reject_duplicate_keys(updates, [key]), end, current)

    both = _settled(target, updates.where(F.col(key).isNotNull()), key, tracked, current, null_safe, gather)
    if close_before:
        close_date = F.date_sub(F.col(f"_update.{close_before}").cast("date"), 1)
    elif close_date is None:
        close_date = F.current_date()
    is_old, changed = F.col("_old").isNotNull(), F.col("_changed")
    kept = both.where(is_old | (F.col("_olds") == 0) | changed)

    def value(c: str) -> Column:
        if c == current:
            return (~is_old | ~changed).alias(c)
        if c == end:
            return F.when(is_old, F.when(changed, close_date).otherwise(F.col(f"_old.{c}"))).cast("date").alias(c)
        return F.when(is_old, F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}")).alias(c)

    untouched = target.where(~_is_open(current))
    return untouched.unionByName(kept.select(*[value(c) for c in target.columns]))
