"""CSV extracts in dated folders: reading, lineage, landing and exporting."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail.functions import pay_period
from paytrail.schemas import EXTRACT_DATE, MONTHLY_EXTRACTS, REFERENCE_EXTRACTS
from paytrail.session import at_once, open_folders
from paytrail.sources.tables import write_table

SNAPSHOT, MONTH = "full_load_date", "ingest_month"
LINEAGE = ["_ingested_at", "_source_file"]


MALFORMED, _FITS = "_malformed", "_fits"
#: The header decides which column is which; a file is never read under another file's header.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "columnPruning": False, "columnNameOfCorruptRecord": MALFORMED}
_HEADER_READERS = 16


def _first_line(spark: SparkSession, file: str) -> str | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def files_by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files grouped by their first line, of which alone is read here; empty files are left out."""
    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            groups.setdefault(tuple(next(csv.reader([line.removeprefix("\ufeff")]))), []).append(file)
    return groups


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files under a path, as the reader lists them."""
    uri, of = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    return [of(uri(f)).toString() for f in spark.read.text(path).inputFiles()]


def _schema(header: tuple[str, ...], schema: str, folder: str | None) -> T.StructType:
    """The declared columns in the order of a header, further ones as text, then the malformed line."""
    declared = {f.name: f for f in T.StructType.fromDDL(schema)}
    fields = [declared.get(c, T.StructField(c, T.StringType())) for c in header if c != folder]
    # The folder column is declared too, or discovery would guess its type.
    extra = [MALFORMED, *([folder] if folder else [])]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in extra])


def declared_columns(frame: DataFrame, schema: str) -> list[Column]:
    """The declared columns of a frame read by its header; one the files lack is NULL."""
    fields = T.StructType.fromDDL(schema).fields
    return [(F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields]


def read_extract(
    spark: SparkSession, path: str, schema: str | None, folder: str | None = None, files: list[str] | None = None
) -> DataFrame:
    """Header CSV with its folder date (as text) and file path; columns are found by name.

    Under a declared schema the declared columns are returned, whatever their order in the
    files (NULL for one that they lack), and ``_malformed`` holds a line of which some value does not fit its type.
    Files may differ in their headers, as when a column is added in a later month: there is one
    scan for each header. ``files`` limits the read to some of the files under ``path``.
    Passing no schema infers one, as a last resort: that costs an extra pass and loses
    leading zeros and month texts.
    """
    source = F.col("_metadata.file_path").alias("_source_file")
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path).select("*", source)
    groups = files_by_header(spark, _files(spark, path) if files is None else files) or {(): []}
    parts = []
    for header, members in groups.items():
        chosen = path if len(groups) == 1 and files is None else members or path
        reader = spark.read.options(**CSV_OPTIONS, basePath=path).schema(_schema(header, schema, folder))
        frame = reader.csv(chosen)
        parts.append(
            frame.select(*declared_columns(frame, schema), *([folder] if folder else []), MALFORMED, source)
        )
    return reduce(DataFrame.unionByName, parts)


def fits(df: DataFrame) -> Column:
    """Whether all values of a row fit their types.

    The reader cannot tell from the malformed line alone, so the rule names another column too.
    """
    first = F.col(df.columns[0]).cast("string")
    return F.concat_ws("|", first, MALFORMED) == F.coalesce(first, F.lit(""))


def well_formed(df: DataFrame) -> DataFrame:
    """The rows whose values all fit their types."""
    return df.where(fits(df)).drop(MALFORMED)


def malformed(df: DataFrame) -> DataFrame:
    """The other rows, with the line as it was read."""
    return df.where(~fits(df))


def with_lineage(df: DataFrame) -> DataFrame:
    """Stamp the load time; the source file is added on reading, where it is known."""
    columns = [c for c in df.columns if c not in LINEAGE]
    return df.select(*columns, F.current_timestamp().alias("_ingested_at"), "_source_file")


def _snapshot(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """The newest full snapshot: its date comes from the listing of the files, not from their rows."""
    path = f"{raw_dir}/reference/{name}"
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", False).load(path)
    newest = listing.agg(F.max(F.col(SNAPSHOT).cast("string"))).scalar()
    everything = read_extract(spark, path, REFERENCE_EXTRACTS[name], SNAPSHOT)
    return everything.where(F.col(SNAPSHOT) == newest).drop(SNAPSHOT)


def _monthly(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    return read_extract(spark, f"{raw_dir}/{name}", MONTHLY_EXTRACTS[name], MONTH).drop(MONTH)


def snapshot_extract(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """The well-formed rows of the newest full snapshot of a reference table; older folders are not read."""
    return with_lineage(well_formed(_snapshot(spark, raw_dir, name)))


def monthly_extract(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """The well-formed rows of all month folders of an incremental table."""
    return with_lineage(well_formed(_monthly(spark, raw_dir, name)))


def quarantine_malformed(df: DataFrame, bronze_dir: str, name: str, fmt: str = "parquet") -> None:
    """Write the malformed rows of a table, if any, beside the bronze tables."""
    write_table(malformed(df), f"{bronze_dir}/_quarantine/{name}", fmt=fmt)


def land(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write a bronze table and return its row count, observed during the write."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt=fmt)
    return seen.get["rows"]


def ingest_all(spark: SparkSession, raw_dir: str, bronze_dir: str, fmt: str = "parquet") -> dict[str, int]:
    """Land every extract, several at once; the result gives the rows per table.

    The write of a table counts its malformed rows as well, and only if there are some are its files parsed again for them.
    """

    def ingest(name: str) -> int:
        read = (_snapshot if name in REFERENCE_EXTRACTS else _monthly)(spark, raw_dir, name)
        seen = Observation()
        flagged = read.withColumn(_FITS, fits(read)).observe(seen, F.count_if(~F.col(_FITS)).alias("rows"))
        good = flagged.where(_FITS).drop(MALFORMED, _FITS)
        rows = land(with_lineage(good), f"{bronze_dir}/{name}", fmt)
        quarantine_malformed(read if seen.get.get("rows") else read.limit(0), bronze_dir, name, fmt)
        return rows

    names = [*REFERENCE_EXTRACTS, *MONTHLY_EXTRACTS]
    return dict(zip(names, at_once(spark, [partial(ingest, name) for name in names])))


def _text_dates(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in dates})


def _write_csv(df: DataFrame, path: str, folder: str, mode: str) -> None:
    # Rebalancing joins small slices of a folder and splits large ones, so neither a
    # busy month nor many quiet ones make a bad file size.
    balanced = df.hint("rebalance", folder)
    with open_folders(df.sparkSession):
        balanced.write.mode(mode).partitionBy(folder).option("header", True).csv(path)


def write_snapshot_extract(
    df: DataFrame, raw_dir: str, name: str, load_date: str, mode: str = "append"
) -> None:
    """Export a full snapshot to ``reference/<name>/full_load_date=<date>``."""
    dated = _text_dates(df).withColumn(SNAPSHOT, F.lit(load_date))
    _write_csv(dated, f"{raw_dir}/reference/{name}", SNAPSHOT, mode)


def write_monthly_extract(
    df: DataFrame, raw_dir: str, name: str, date_column: str, mode: str = "append"
) -> None:
    """Export to ``<name>/ingest_month=<yyyy-MM>``; rows without a date get the default folder."""
    monthly = _text_dates(df.withColumn(MONTH, pay_period(date_column)))
    _write_csv(monthly, f"{raw_dir}/{name}", MONTH, mode)


def export_extracts(tables: dict[str, DataFrame], raw_dir: str, load_date: str) -> None:
    """Write all given tables, several at once, in the layout ``ingest_all`` reads."""

    def export(name: str, df: DataFrame) -> None:
        if name in REFERENCE_EXTRACTS:
            write_snapshot_extract(df, raw_dir, name, load_date)
        else:
            write_monthly_extract(df, raw_dir, name, EXTRACT_DATE[name])

    if tables:
        spark = next(iter(tables.values())).sparkSession
        with open_folders(spark):  # a setting of the session, so it stands until the last of the writes has ended
            at_once(spark, [partial(export, name, df) for name, df in tables.items()])
