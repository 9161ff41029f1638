"""Lake tables: read, overwrite, append, quarantine and merge."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytrail.operators.history import reject_duplicate_keys, scd2_merge, upsert
from paytrail.operators.numbering import number_rows
from paytrail.session import materialized

#: The folder column of a merge-maintained table, and how many folders it has unless the caller says.
BUCKET = "_bucket"
BUCKETS = 64
#: Fixed value: the name Spark gives the folder of rows whose folder column is NULL or empty.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a readable table lies at the path; other failures are not hidden."""
    try:
        read_table(spark, path, fmt)
    except AnalysisException:
        return False
    return True


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    balanced: bool = True,
    order_by: list[Column | str] | None = None,
) -> None:
    """Write a table; a partitioned one is rebalanced by folder first, hot folders split.

    Rebalancing is a shuffle: rows that already lie together by folder do without. With ``order_by`` the rows of
    each folder (of the table, if it has none) are sorted across its files, in the order of their names, and within each.
    """
    if order_by:
        df = in_order(df, order_by, partition_by or [])
    elif partition_by and balanced:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def in_order(df: DataFrame, order_by: list[Column | str], partition_by: list[str]) -> DataFrame:
    """Rows in ranges of folder and order, sorted within each, so that a write keeps the order.

    A folder of any size is cut into ranges of the order, and a range may end in the middle of
    a day or a name: give an order that tells rows apart, as rows equal in all of it go to one task.
    """
    # The writer sorts again by folder alone, and loses the order within, if a text it names folders by may be NULL.
    for name, kind in df.dtypes:
        if name in partition_by and kind == "string":
            known = F.nullif(F.col(name), F.lit(""))
            df = df.withColumn(name, F.coalesce(known, F.lit(NULL_FOLDER)))
    order = [*map(F.col, partition_by), *[F.col(c) if isinstance(c, str) else c for c in order_by]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_numbered(
    df: DataFrame, path: str, order_by: list[Column], place: str = "place", partition_by: list[str] | None = None
) -> None:
    """Write a Parquet table in order, each row with its place (from 1) in the order of the whole table.

    A reader may open files in any order; the place tells it the order without a comparison of the keys,
    and a range of places prunes row groups.
    """
    write_table(number_rows(df, order_by, place), path, partition_by=partition_by, order_by=[place])


def read_stored_order(spark: SparkSession, path: str, place: str = "place", partition_by: list[str] | None = None) -> DataFrame:
    """The rows of a numbered table and ``in_order``: whether each follows the row before it in its folder's files.

    A row is compared with the row above it in its file, the first of a file with the last of the file before.
    """
    rows = read_table(spark, path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy(*(partition_by or []), "_file").agg(F.max_by(place, "_row").alias("_end"))
    one_after_another = Window.partitionBy(*(partition_by or [])).orderBy("_file")
    ends = files.select("_file", F.lag("_end").over(one_after_another).alias("_end_before"))
    above = F.lag(place).over(Window.partitionBy("_file").orderBy("_row"))
    followed = rows.withColumn("_above", above).join(ends, "_file")
    before = F.coalesce("_above", "_end_before")
    return followed.select(*[c for c in rows.columns if c not in ("_file", "_row")], (before.isNull() | (before < F.col(place))).alias("in_order"))


def publish_table(
    df: DataFrame,
    name: str,
    folder: str,
    partition_by: list[str] | None = None,
    balanced: bool = True,
    order_by: list[Column | str] | None = None,
) -> None:
    """Write a table to a fresh folder, then move its readers there by the catalog in one step.

    ``name`` is a view of the newest complete folder. A write that fails leaves the old rows readable, and
    queries that run meanwhile go on reading the files they began with. Older folders stay until
    their owner removes them. Folder columns keep their types.
    """
    fresh = f"{folder}/{uuid.uuid4().hex}"
    write_table(df, fresh, partition_by=partition_by, balanced=balanced, order_by=order_by)
    columns = ", ".join(f"CAST(`{c}` AS {kind}) AS `{c}`" if c in (partition_by or ()) else f"`{c}`" for c, kind in df.dtypes)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{fresh}`")


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(df, path, mode="append", fmt=fmt)


def write_quarantine(df: DataFrame, layer_dir: str, name: str, fmt: str = "parquet") -> None:
    """Replace the table's quarantine, with nothing if the run had no bad rows."""
    write_table(df, f"{layer_dir}/_quarantine/{name}", fmt=fmt)


def read_merged(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a merge-maintained table, or None if there is none yet."""
    return read_table(spark, path).drop(BUCKET) if table_exists(spark, path) else None


def _merge(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], buckets: int, merged: Callable) -> None:
    """Rewrite the buckets that a batch touches, and no others.

    The bucket of a row follows from its key and names the folder it lies in, as ``5of64``. The batch is stored first, which
    fixes its buckets; only their folders are read, merged and overwritten, each by one task. Spark moves the new
    files into place once all are written, so a failed merge leaves the table as it was, and a merge that
    ends while files move can be run again with the same batch.
    """
    target = read_table(spark, path) if table_exists(spark, path) else None
    if target is not None:  # keys of another type would fall into other buckets
        types = dict(target.dtypes)
        batch = batch.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in batch.columns])
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    place = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    # Rows without a whole key match nothing: they are dealt out evenly.
    dealt = F.when(known, place).otherwise(F.pmod(F.spark_partition_id(), F.lit(buckets)))
    of = f"of{buckets}"
    batch = materialized(batch.withColumn(BUCKET, F.concat(dealt.cast("string"), F.lit(of))), "batch")
    if target is None:
        write_table(merged(None, batch), path, partition_by=[BUCKET])
        return
    if not target.where(~F.endswith(BUCKET, F.lit(of))).isEmpty():  # decided by the folders alone
        raise ValueError(f"{path} is not stored in {buckets} buckets")
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # no more than buckets
    if touched:
        state = merged(target.where(F.col(BUCKET).isin(touched)), batch)
        state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def upsert_table(
    spark: SparkSession, source: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS
) -> None:
    """Merge rows into a table by key, rewriting only the buckets they fall into; the first batch creates it.

    ``buckets`` is fixed for a table: take as many as make a bucket fit a task.
    """

    def merged(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        if target is None:
            return reject_duplicate_keys(batch, keys)
        return upsert(target, batch, keys, gather=[BUCKET])

    _merge(spark, path, source, keys, buckets, merged)


def scd2_merge_table(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    key: str,
    tracked: list[str],
    buckets: int = BUCKETS,
    **options,
) -> None:
    """Merge one batch of updates into a Type-2 dimension, rewriting only the buckets of its keys."""

    def merged(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        return scd2_merge(target, batch, key, tracked, gather=[BUCKET], **options)

    _merge(spark, path, updates, [key], buckets, merged)
