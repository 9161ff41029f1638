"""Snapshot selection, deduplication and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot; the maximum stays in the plan and prunes the scan."""
    return df.where(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


def dedup_latest(
    df: DataFrame, keys: list[str], newest_first: list[Column] | None = None
) -> DataFrame:
    """One row per key: the newest, ties settled by comparing every column.

    The ``= 1`` filter on the row number becomes a per-task group limit before the
    shuffle, so even a very frequent key sends at most one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    total_order = [F.col(c).desc_nulls_last() for c in rest] or [F.col(k) for k in keys]
    newest = Window.partitionBy(*keys).orderBy(*(newest_first or []), *total_order)
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def split_quarantine(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which the rule holds, and all others: rule false or unknown."""
    return df.where(valid), df.where(~valid | valid.isNull())
