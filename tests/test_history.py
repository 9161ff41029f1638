from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paytrail.operators.history import (
    build_history,
    current_dimension,
    scd2_changed_keys,
    scd2_merge,
    scd2_new_keys,
    upsert,
    with_version_key,
)
from paytrail.session import materialized
from paytrail.sources.tables import read_merged, scd2_merge_table, table_exists, upsert_table

UPDATE = "agent_id string, tier string, effective_start_date date"


def updates(spark, *rows):
    return spark.createDataFrame([(k, t, date.fromisoformat(d)) for k, t, d in rows], UPDATE)


def state(df):
    return sorted(
        ((r["agent_id"], r["tier"], r["effective_end_date"], r["is_current"]) for r in df.collect()),
        key=str,
    )


def test_history_from_changes(spark):
    d = date
    rows = [("a", "Gold", d(2021, 1, 1)), ("a", "Bronze", d(2020, 1, 1)), ("b", "Silver", d(2020, 5, 1)),
            ("a", "Bronze", d(2020, 1, 1))]
    df = spark.createDataFrame(rows, "agent_id string, tier string, at date")
    got = sorted(tuple(r) for r in build_history(df, "agent_id", "at", ["tier"]).drop("effective_end_date").collect())
    assert got == [
        ("a", "Bronze", d(2020, 1, 1), False), ("a", "Bronze", d(2020, 1, 1), False),
        ("a", "Gold", d(2021, 1, 1), True), ("b", "Silver", d(2020, 5, 1), True),
    ]
    ends = build_history(df, "agent_id", "at", ["tier"]).where("tier = 'Bronze'").select("effective_end_date")
    assert sorted(r[0] for r in ends.collect()) == [d(2020, 1, 1), d(2021, 1, 1)]


def test_version_keys_are_unique_even_for_copies(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), ("b", 1), ("b", 1), ("b", 1)]
    df = spark.createDataFrame(rows, "agent_id string, effective_start_date int")
    got = with_version_key(df, "agent_id", "sk").collect()
    assert sorted(r["sk"] for r in got) == ["a_1", "a_2", "a_3", "b_1", "b_2", "b_3"]
    assert [r["effective_start_date"] for r in got if r["sk"] == "a_3"] == [2]


def test_current_flag_may_be_text(spark):
    df = spark.createDataFrame([(1, "true"), (2, "false")], "n int, is_current string")
    assert [r["n"] for r in current_dimension(df).collect()] == [1]


def test_upsert_updates_and_inserts(spark):
    target = spark.createDataFrame([("A", 1), ("B", 2), (None, 5)], "id string, value long")
    source = spark.createDataFrame([("A", 99), ("C", 3), (None, 6)], "id string, value long")
    got = sorted((tuple(r) for r in upsert(target, source, ["id"]).collect()), key=str)
    assert got == [("A", 99), ("B", 2), ("C", 3), (None, 5), (None, 6)]


def test_upsert_takes_null_values_from_the_source(spark):
    target = spark.createDataFrame([("A", 1, "x")], "id string, v long, w string")
    source = spark.createDataFrame([("A", None, "y")], "id string, v long, w string")
    assert [tuple(r) for r in upsert(target, source, ["id"]).collect()] == [("A", None, "y")]


def test_duplicate_source_keys_fail(spark):
    target = spark.createDataFrame([("A", 1)], "id string, value long")
    source = spark.createDataFrame([("A", 2), ("A", 3)], "id string, value long")
    with pytest.raises(PySparkException, match="share one key"):
        upsert(target, source, ["id"]).collect()
    with pytest.raises(PySparkException, match="share one key"):
        upsert(target, source, ["id"]).count()


def test_upsert_of_several_key_columns_and_repeated_target_rows(spark):
    target = spark.createDataFrame([("A", 1, 10), ("A", 1, 10), ("A", 2, 20), ("A", None, 30)], "id string, part long, v long")
    source = spark.createDataFrame([("A", 1, 11), ("A", 3, 13), ("A", None, 14)], "id string, part long, v int")
    got = sorted((tuple(r) for r in upsert(target, source, ["id", "part"]).collect()), key=str)
    assert got == sorted([("A", 1, 11), ("A", 1, 11), ("A", 2, 20), ("A", 3, 13), ("A", None, 30), ("A", None, 14)], key=str)
    assert dict(upsert(target, source, ["id", "part"]).dtypes) == dict(target.dtypes)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_merges_read_the_target_once_and_shuffle_once(spark, tmp_path):
    target, batch = f"{tmp_path}/target", f"{tmp_path}/batch"
    scd2_merge(None, updates(spark, ("a", "Gold", "2024-01-01"), ("b", None, "2024-01-01")), "agent_id", ["tier"]).write.partitionBy("is_current").parquet(target)
    updates(spark, ("a", "Silver", "2025-01-01")).write.parquet(batch)
    old, new = spark.read.parquet(target), spark.read.parquet(batch)
    plan = plan_of(upsert(old, new.selectExpr("*", "null AS effective_end_date", "true AS is_current"), ["agent_id"]))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    # Open and closed rows lie in folders of their own, so two scans read each row once.
    plan = plan_of(scd2_merge(old, new, "agent_id", ["tier"]))
    assert plan.count("FileScan") == 3 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def files_by_bucket(path):
    return {d.name: sorted(f.name for f in d.glob("part-*")) for d in path.glob("_bucket=*")}


def test_merges_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    rows = [(f"k{i}", i) for i in range(300)]
    upsert_table(spark, spark.createDataFrame(rows, "id string, value long"), f"{tmp_path}/t", ["id"], buckets=16)
    before = files_by_bucket(tmp_path / "t")
    batch = spark.createDataFrame([("k7", -7), ("new", 1), ("k70", None)], "id string, value long")
    upsert_table(spark, batch, f"{tmp_path}/t", ["id"], buckets=16)
    after = files_by_bucket(tmp_path / "t")
    changed = {b for b in before if before[b] != after[b]}
    assert len(before) == 16 and 1 <= len(changed) <= 3
    got = {r["id"]: r["value"] for r in read_merged(spark, f"{tmp_path}/t").collect()}
    assert got == {**dict(rows), "k7": -7, "new": 1, "k70": None}
    upsert_table(spark, batch.where("false"), f"{tmp_path}/t", ["id"], buckets=16)
    assert files_by_bucket(tmp_path / "t") == after
    for other in (8, 32, 116):
        with pytest.raises(ValueError, match=f"not stored in {other} buckets"):
            upsert_table(spark, batch, f"{tmp_path}/t", ["id"], buckets=other)
    assert files_by_bucket(tmp_path / "t") == after


def test_stored_keys_of_another_type_meet_their_rows(spark, tmp_path):
    for kind in ("long", "int"):
        batch = spark.createDataFrame([(1, kind), (2, kind)], f"id {kind}, v string")
        upsert_table(spark, batch, f"{tmp_path}/t", ["id"], buckets=16)
    assert sorted(tuple(r) for r in read_merged(spark, f"{tmp_path}/t").collect()) == [(1, "int"), (2, "int")]


def test_stored_history_rewrites_only_the_buckets_of_its_batch(spark, tmp_path):
    first = updates(spark, *[(f"k{i}", "Gold", "2024-01-01") for i in range(200)])
    close = F.to_date(F.lit("2024-12-31"))
    for batch in (first, updates(spark, ("k5", "Silver", "2025-01-01"), ("k9", None, "2025-01-01"), ("k11", "Gold", "2025-01-01"))):
        before = files_by_bucket(tmp_path / "t")
        scd2_merge_table(spark, batch, f"{tmp_path}/t", "agent_id", ["tier"], buckets=32, close_date=close)
    after = files_by_bucket(tmp_path / "t")
    assert 1 <= sum(before[b] != after[b] for b in before) <= 3
    rows = state(read_merged(spark, f"{tmp_path}/t"))
    assert len(rows) == 202 and [r for r in rows if r[0] in ("k5", "k9", "k11")] == [
        ("k11", "Gold", None, True), ("k5", "Gold", date(2024, 12, 31), False), ("k5", "Silver", None, True),
        ("k9", "Gold", date(2024, 12, 31), False), ("k9", None, None, True),
    ]


def test_upsert_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not table_exists(spark, path) and read_merged(spark, path) is None
    upsert_table(spark, spark.createDataFrame([("x", 10), ("y", 20)], "id string, value long"), path, ["id"])
    upsert_table(spark, spark.createDataFrame([("y", 21), ("w", 5)], "id string, value long"), path, ["id"])
    got = {r["id"]: r["value"] for r in read_merged(spark, path).collect()}
    assert got == {"x": 10, "y": 21, "w": 5}


def test_failed_merge_keeps_the_old_state(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert_table(spark, spark.createDataFrame([("A", 1)], "id string, value long"), path, ["id"])
    twice = spark.createDataFrame([("A", 2), ("A", 3)], "id string, value long")
    with pytest.raises(PySparkException):
        upsert_table(spark, twice, path, ["id"])
    assert [tuple(r) for r in read_merged(spark, path).collect()] == [("A", 1)]


def test_scd2_seed_change_and_new_key(spark, tmp_path):
    path = f"{tmp_path}/dim"
    first = updates(spark, ("p-9", "north", "2019-05-20"), ("p-4", "south", "2019-05-20"))
    scd2_merge_table(spark, first, path, "agent_id", ["tier"])
    assert state(read_merged(spark, path)) == [
        ("p-4", "south", None, True), ("p-9", "north", None, True),
    ]
    second = updates(
        spark, ("p-9", "west", "2020-02-11"), ("p-4", "south", "2019-05-20"), ("p-6", "east", "2020-02-03")
    )
    close = F.to_date(F.lit("2020-02-14"))
    scd2_merge_table(spark, second, path, "agent_id", ["tier"], close_date=close)
    want = [
        ("p-9", "north", date(2020, 2, 14), False), ("p-9", "west", None, True),
        ("p-4", "south", None, True), ("p-6", "east", None, True),
    ]
    assert state(read_merged(spark, path)) == sorted(want, key=str)
    scd2_merge_table(spark, second, path, "agent_id", ["tier"], close_date=close)
    assert state(read_merged(spark, path)) == sorted(want, key=str)


def test_scd2_default_close_is_today_and_close_before(spark):
    target = scd2_merge(None, updates(spark, ("a", "Gold", "2024-01-01")), "agent_id", ["tier"])
    change = updates(spark, ("a", "Silver", "2025-03-01"))
    closed = scd2_merge(target, change, "agent_id", ["tier"]).where("NOT is_current").first()
    assert closed["effective_end_date"] == spark.range(1).select(F.current_date()).first()[0]
    before = scd2_merge(target, change, "agent_id", ["tier"], close_before="effective_start_date")
    assert before.where("NOT is_current").first()["effective_end_date"] == date(2025, 2, 28)


def test_scd2_null_changes_and_legacy_mode(spark):
    target = scd2_merge(None, updates(spark, ("a", None, "2024-01-01")), "agent_id", ["tier"])
    change = updates(spark, ("a", "Gold", "2025-01-01"))
    assert scd2_merge(target, change, "agent_id", ["tier"]).count() == 2
    assert scd2_merge(target, change, "agent_id", ["tier"], null_safe=False).count() == 1


def test_scd2_reopens_a_key_whose_versions_are_all_closed(spark):
    target = scd2_merge(None, updates(spark, ("a", "Gold", "2024-01-01")), "agent_id", ["tier"])
    closed = target.withColumns({"is_current": F.lit(False), "effective_end_date": F.to_date(F.lit("2024-05-01"))})
    change = updates(spark, ("a", "Gold", "2025-01-01"))
    assert state(scd2_merge(closed, change, "agent_id", ["tier"])) == [
        ("a", "Gold", None, True), ("a", "Gold", date(2024, 5, 1), False),
    ]
    assert [r["agent_id"] for r in scd2_new_keys(closed, change, "agent_id").collect()] == ["a"]
    assert scd2_changed_keys(closed, change, "agent_id", ["tier"]).isEmpty()


def test_scd2_several_current_rows_of_a_changed_key_are_all_closed(spark):
    target = scd2_merge(None, updates(spark, ("a", "Gold", "2024-01-01")), "agent_id", ["tier"])
    both = target.unionByName(target.withColumn("tier", F.lit("Silver")))
    got = scd2_merge(both, updates(spark, ("a", "Gold", "2025-01-01")), "agent_id", ["tier"])
    assert [s[1] for s in state(got.where("is_current"))] == ["Gold"]
    assert got.where("NOT is_current").count() == 2


tiers = st.sampled_from(["Gold", "Silver", None])
batch = st.dictionaries(st.sampled_from("abcd"), tiers, max_size=4)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(batch, batch)
def test_scd2_is_idempotent_with_one_current_row_per_key(spark, first, second):
    def as_updates(rows, day):
        return spark.createDataFrame([(k, t, date(2024, 1, day)) for k, t in rows.items()], UPDATE)

    close = F.to_date(F.lit("2024-02-01"))
    target = materialized(scd2_merge(None, as_updates(first, 1), "agent_id", ["tier"]))
    once = materialized(
        scd2_merge(target, as_updates(second, 2), "agent_id", ["tier"], close_date=close)
    )
    twice = scd2_merge(once, as_updates(second, 2), "agent_id", ["tier"], close_date=close)
    assert state(once) == state(twice)
    current = {r["agent_id"]: r["tier"] for r in once.where("is_current").collect()}
    assert current == {**first, **second}
    assert once.where("is_current").count() == len(current)
