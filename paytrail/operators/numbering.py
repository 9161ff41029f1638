"""Row numbers, ranks and sequence ids over a whole table, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.operators.joins import skew_join
from paytrail.session import materialized

# monotonically_increasing_id keeps the partition number above its lower 33 bits.
_SLOT_BITS = 33
_COPIES_PER_CHUNK = 100_000


def _sorted_slots(df: DataFrame, order_by: list[Column]) -> DataFrame:
    """Globally sorted rows with their partition ``_part`` and place ``_slot`` in it.

    The places are written out with the rows, so a lost executor cannot change them.
    """
    sorted_rows = df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id())
    return materialized(sorted_rows, "sorted").select(
        *df.columns,
        F.shiftright("_id", _SLOT_BITS).alias("_part"),
        F.col("_id").bitwiseAND((1 << _SLOT_BITS) - 1).alias("_slot"),
    )


def _part_offsets(placed: DataFrame, size: Column) -> DataFrame:
    """Running total of earlier partitions: one row per partition of the sort."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(size.alias("_size"))
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    return sizes.select("_part", before.cast("bigint").alias("_before"))


def number_rows(df: DataFrame, order_by: list[Column], name: str = "row_number") -> DataFrame:
    """Consecutive numbers from 1 in the given order, which should identify rows."""
    placed = _sorted_slots(df, order_by)
    offsets = _part_offsets(placed, F.count(F.lit(1)))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_slot") + 1).alias(name)
    )


def with_sequence_id(
    df: DataFrame, order_by: list[Column], name: str, prefix: str, width: int
) -> DataFrame:
    """Zero-padded sequential business ids such as ``TXN00000042``."""
    numbered = number_rows(df, order_by, "_seq")
    return numbered.select(*df.columns, F.format_string(f"{prefix}%0{width}d", "_seq").alias(name))


def global_rank(df: DataFrame, by: str, name: str = "rank") -> DataFrame:
    """Descending rank over all rows; ties share a rank, gaps follow, NULLs come last.

    The distinct values are counted and sorted across the cluster, and each row looks up
    its value's rank. Only distinct values are stored; the rows are computed for the counts and for the
    look-up, and Spark reuses a shuffle that both end in, such as that of an aggregate.
    """
    values = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    placed = _sorted_slots(values, [F.col(by).desc()])
    offsets = _part_offsets(placed, F.sum("_rows"))
    earlier = (
        Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    ranks = placed.join(F.broadcast(offsets), "_part").select(
        by, (F.col("_before") + ahead + 1).alias(name)
    )
    after_all = placed.agg(F.coalesce(F.sum("_rows"), F.lit(0)) + 1).scalar()
    ranked = skew_join(df, ranks, [by])
    return ranked.withColumn(name, F.coalesce(F.col(name), after_all).cast("bigint"))


def collapse_copies(df: DataFrame, columns: list[str], count: str = "_copies") -> DataFrame:
    """Distinct rows with the number of their copies; copies merge before the shuffle."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count))


def expand_copies(df: DataFrame, count: str = "_copies", index: str = "_copy") -> DataFrame:
    """Undo ``collapse_copies``, numbering each row's copies from 1.

    Copies are made in chunks that are spread first, so no task has to write all
    the copies of one row.
    """
    step = _COPIES_PER_CHUNK
    chunks = df.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count), F.lit(step).cast("bigint")))
    )
    last = F.least(F.col("_chunk") + step - 1, F.col(count))
    return (
        chunks.repartition(*df.columns, "_chunk")
        .withColumn(index, F.explode(F.sequence(F.col("_chunk"), last)))
        .drop("_chunk")
    )
