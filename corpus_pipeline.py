"""From raw documents to shards: toxicity, near duplicates, decontamination, mixing, sharding.

``STAGES`` are functions of (spark, docs, sf_dir); each stage's rows are written as Parquet and
reread as the next one's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paytrail.llm import decontamination, mixing, neardup, sharding, toxicity
from paytrail.session import materialized


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return neardup.keep_representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source in proportion to its weight; a document appears once per epoch that takes it."""
    return mixing.mix(docs)


def cut_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash", keep_one_of_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_into_shards),
]

#: The first stage scores with a model fitted on labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, applied to the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
