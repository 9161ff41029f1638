"""Incremental landing of monthly extracts: each run reads only files not yet landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.schemas import MONTHLY_EXTRACTS
from paytrail.session import materialized
from paytrail.sources.extracts import MALFORMED, MONTH, fits, read_extract, with_lineage

#: The folder column of a landed table: the number of the run's micro-batch.
BATCH = "_batch"

_FILES = f"path string, modificationTime timestamp, length bigint, content binary, {MONTH} string"
_FITS = "_fits"


def ingest_new_files(
    spark: SparkSession, raw_dir: str, name: str, bronze_dir: str, checkpoint_dir: str
) -> None:
    """Append the extract files that arrived since the last run, then stop.

    Gives the rows a full re-read gives, as long as delivered files do not
    change. The stream carries the names of the new files, whose checkpoint on shared storage tells which have landed. Each
    micro-batch reads its files once, by their headers, which may differ between deliveries, into a scratch table, and
    puts well-formed and malformed rows into a folder of its number; a batch that runs again replaces that folder.
    """
    path, declared = f"{raw_dir}/{name}", MONTHLY_EXTRACTS[name]

    def land(arrived: DataFrame, batch: int) -> None:
        files = [r["path"] for r in arrived.collect()]  # names only
        if not files:
            return
        rows = read_extract(spark, path, declared, MONTH, files).drop(MONTH)
        flagged = rows.withColumn(_FITS, fits(rows))
        stored = materialized(flagged, "landing")  # no folders: those would sort each task's rows in memory
        good, bad = stored.where(_FITS).drop(MALFORMED, _FITS), stored.where(f"NOT {_FITS}").drop(_FITS)
        _replace_batch(with_lineage(good), f"{bronze_dir}/{name}", batch)
        if not bad.isEmpty():
            _replace_batch(with_lineage(bad), f"{bronze_dir}/_quarantine/{name}", batch)

    arriving = spark.readStream.format("binaryFile").schema(_FILES).load(path).select("path")
    query = (
        arriving.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{checkpoint_dir}/{name}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _replace_batch(rows: DataFrame, path: str, batch: int) -> None:
    numbered = rows.withColumn(BATCH, F.lit(batch))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
