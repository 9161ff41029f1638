"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


#: How many folders a task of a write keeps open; it sorts what falls into further ones.
OPEN_FOLDERS = 32
_OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"


#: How many independent writes are submitted side by side.
WRITES_AT_ONCE = 4


def get_spark(app_name: str = "paytrail", **extra: str) -> SparkSession:
    """The active or a new session; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream progress.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall
    back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="paytrail-")
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage by a table written to the shared folder, and read it back.

    Survives the loss of executors, computes the rows once (a checkpoint computes them
    twice) and gives later plans the true size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_folders(spark: SparkSession) -> Iterator[None]:
    """Writes into folders keep a file per folder open, instead of sorting in memory all rows of a task by folder."""
    before = spark.conf.get(_OPEN_FOLDERS)
    spark.conf.set(_OPEN_FOLDERS, OPEN_FOLDERS)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FOLDERS, before)


def at_once(spark: SparkSession, steps: list[Callable]) -> list:
    """Run steps that do not need one another side by side, and return their results in order.

    Each submits Spark jobs; the tasks of one take the cores that the last tasks and the planning of another leave
    idle. All steps end before a failure is raised.
    """
    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]
