"""The corpus pipeline, and SQL against the registered queries."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from paytrail.llm import neardup
from paytrail.llm.queries import ORACLE, QUERIES
from paytrail.session import materialized
from tests.oracle_check import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, sf) is None


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_take_effect_and_keep_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf), name)
        assert docs.columns == columns
        counts.append(docs.count())
        if name == "minhash":
            assert neardup.near_duplicates(docs).where("NOT kept").count() == 0
    assert counts[1] <= counts[0] and counts[2] < counts[1] and counts[3] <= counts[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == counts[-1] == corpus_pipeline.run(spark, sf).count()


def test_stages_accept_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
