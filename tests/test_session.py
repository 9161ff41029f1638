from types import SimpleNamespace

import pytest

from paytrail.session import materialized, scratch_path, scratch_root


def test_scratch_is_the_configured_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_must_name_its_shared_folder():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session)


def test_materialized_rows_keep_schema_and_cut_the_lineage(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(18,2)) AS m, CAST(NULL AS DATE) AS d, 'x' AS s")
    stored = materialized(df)
    assert stored.dtypes == df.dtypes and stored.collect() == df.collect()
    assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()
