"""The registered queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.llm import (
    centroids,
    decontamination,
    embeddings,
    language,
    linededup,
    mixing,
    neardup,
    ngrams,
    pages,
    runs,
    sharding,
    tokens,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(_table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_embeddings(_table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(_table(spark, sf_dir, "pages"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(runs.periodic_runs(runs.repeat_tails(_table(spark, sf_dir, "documents"))))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_language": op6_language,
    "op7_html": op7_html,
    "op8_minhash": op8_minhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_sharding": op10_sharding,
    "op11_runs": op11_runs,
    "op12_centroids": op12_centroids,
    "op13_ngrams": op13_ngrams,
}

ORACLE = {
    "op2_embedding_dedup": embeddings.ORACLE_SQL,
    "op8_minhash": neardup.ORACLE_SQL,
    "op9_line_dedup": linededup.ORACLE_SQL,
    "op10_sharding": sharding.ORACLE_SQL,
    "op12_centroids": centroids.oracle_sql(),
}
