from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.operators import joins
from paytrail.operators.joins import as_of_join, exclusive_periods, hot_keys, is_small, skew_join

DAY0 = date(2020, 1, 1)
ROWS = "k string, at date, n int"
HISTORY = "k string, tier string, effective_start_date date, effective_end_date date"

day = st.integers(0, 12).map(lambda d: DAY0 + timedelta(days=d))
key = st.sampled_from(["a", "b", None])
period = st.tuples(key, st.sampled_from("WXYZ"), day, st.one_of(st.none(), day))


def brute(rows, periods):
    """First period, by start, end (open last) and tier, that covers the day."""
    ordered = sorted(periods, key=lambda p: (p[2], p[3] or date.max, p[1]))
    out = []
    for k, at, n in rows:
        hit = [p[1] for p in ordered if k is not None and p[0] == k and p[2] <= at and (p[3] is None or at <= p[3])]
        out.append((k, at, n, hit[0] if hit else None))
    return out


def null_first(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("limit, spans", [(None, None), (None, True), (-1, None)])
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(key, day), min_size=1, max_size=12), periods=st.lists(period, min_size=1, max_size=8))
def test_as_of_equals_brute_force(spark, limit, spans, rows, periods):
    rows = [(k, at, i) for i, (k, at) in enumerate(rows)]
    left, history = spark.createDataFrame(rows, ROWS), spark.createDataFrame(periods, HISTORY)
    got = as_of_join(left, history, ["k"], "at", limit=limit, hot_limit=3, spans=spans).collect()
    assert null_first(map(tuple, got)) == null_first(brute(rows, periods))


def test_boundary_day_belongs_to_the_earlier_period(spark):
    history = spark.createDataFrame(
        [("a", "Silver", DAY0, date(2020, 6, 1)), ("a", "Gold", date(2020, 6, 1), None)], HISTORY
    )
    rows = [("a", date(2019, 12, 31), 0), ("a", DAY0, 1), ("a", date(2020, 6, 1), 2), ("a", date(2020, 6, 2), 3)]
    got = as_of_join(spark.createDataFrame(rows, ROWS), history, ["k"], "at").orderBy("n").collect()
    assert [r["tier"] for r in got] == [None, "Silver", "Silver", "Gold"]


@pytest.mark.parametrize("options", [{"spans": True}, {"limit": -1}])
def test_pairs_do_not_grow_with_the_periods_of_a_key(spark, options):
    """A key with 5,000 periods of a day beside keys with one: rows meet a few periods, not thousands."""
    opened = F.date_add(F.lit(DAY0), F.col("id").cast("int"))
    many = spark.range(5000).select(F.lit("many").alias("k"), F.col("id").cast("string").alias("tier"), opened.alias("effective_start_date"), opened.alias("effective_end_date"))
    few = spark.range(5).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("one").alias("tier"), F.lit(DAY0).alias("effective_start_date"), F.lit(None).cast("date").alias("effective_end_date"))
    history = many.unionByName(few)
    on = F.date_add(F.lit(DAY0), (F.col("id") % 5200 - 100).cast("int"))
    left = spark.range(20_000).select(F.when(F.col("id") % 3 != 0, "many").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), on.alias("at"), F.col("id").cast("int").alias("n"))

    calendar = joins._calendar(history, ["k"], "effective_start_date")
    spans = F.sequence(joins._span(F.col("_from"), calendar), joins._span(F.col("_to"), calendar))
    cut = exclusive_periods(history, ["k"], "effective_start_date", "effective_end_date", ["tier"]).withColumn("_span", F.explode(spans))
    assert cut.count() <= 3 * history.count()
    pairs = left.withColumn("_span", joins._span(F.col("at"), calendar)).join(cut, ["k", "_span"]).count()
    assert pairs <= 10 * left.count()

    joined = as_of_join(left, history, ["k"], "at", **options)
    got = {r["n"]: r["tier"] for r in joined.collect()}
    for n in range(0, 20_000, 7):
        day = n % 5200 - 100
        want = None if day < 0 else "one" if n % 3 == 0 else str(day) if day < 5000 else None
        assert got[n] == want
    assert joined.count() == 20_000 and joined.columns == ["k", "at", "n", "tier"]


def test_as_of_on_an_empty_history_and_explicit_far_ends(spark):
    rows = spark.createDataFrame([("a", date(2020, 1, 5), 0), ("a", None, 1), (None, DAY0, 2), ("a", date(2999, 1, 1), 3)], ROWS)
    assert [r["tier"] for r in as_of_join(rows, spark.createDataFrame([], HISTORY), ["k"], "at").collect()] == [None] * 4
    history = spark.createDataFrame([("a", "X", DAY0, date(2020, 1, 3)), ("a", "Y", date(2020, 1, 4), date(9999, 12, 31)), ("b", "Z", date(1900, 1, 1), None)], HISTORY)
    for options in ({}, {"spans": True}, {"limit": -1}):
        got = as_of_join(rows, history, ["k"], "at", **options).orderBy("n").collect()
        assert [r["tier"] for r in got] == ["Y", None, None, "Y"]


def test_exclusive_periods_are_disjoint_and_merge_copies(spark):
    rows = [("a", t, DAY0, date(2020, 3, 1)) for t in "XXXW"] + [("a", "Y", date(2020, 2, 1), None)]
    history = spark.createDataFrame(rows, HISTORY)
    got = exclusive_periods(history, ["k"], "effective_start_date", "effective_end_date", ["tier"])
    assert [tuple(r) for r in got.orderBy("_from").collect()] == [
        ("a", DAY0, date(2020, 3, 1), "W"),
        ("a", date(2020, 3, 2), date(9999, 12, 31), "Y"),
    ]


def skewed(spark):
    """A third of the rows on one key and a tenth on NULL."""
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 997)
    return spark.range(0, 30_000, 1, 8).select(k.cast("bigint").alias("k"), F.lit("same").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_plain_join(spark, how):
    fact = skewed(spark)
    dim = spark.range(0, 900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    split = skew_join(fact, dim, ["k"], how, limit=-1, hot_limit=100)
    plain = fact.join(dim, "k", how).select("k", "v", "d")
    assert split.columns == ["k", "v", "d"]
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_hot_key_is_cut_into_slices(spark):
    found = hot_keys(skewed(spark), ["k"], 100).collect()
    assert [(r["k"], r["_slices"]) for r in found] == [(7, 34)]


def test_no_task_gets_all_rows_of_a_hot_key(spark):
    """Equal copies of one row, the worst case for hash salting, still spread."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.range(0, 900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
        joined = skew_join(skewed(spark), dim, ["k"], limit=-1, hot_limit=100)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 30_000 * 0.34
        hot = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_size_decides_on_broadcast(spark):
    small = spark.range(5)
    assert is_small(small)
    assert not is_small(spark.range(10_000_000_000))
    assert not is_small(small, limit=-1)


def test_unknown_join_type_is_rejected(spark):
    with pytest.raises(ValueError):
        skew_join(spark.range(1), spark.range(1), ["id"], "full")


@pytest.mark.parametrize("hot_limit", [20, 10_000])
def test_full_join_equals_plain_full_join(spark, hot_limit):
    """A third of the rows on one key, some on NULL, keyed rows that no row meets, NULL keyed rows."""
    fact = skewed(spark)
    met = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    keyed = met.unionByName(spark.createDataFrame([(7, 1), (None, 2), (None, 3)], "k bigint, d bigint"))
    joined = joins.full_join(fact, keyed, ["k"], hot_limit)
    plain = fact.join(keyed, "k", "full_outer").select("k", "v", "d")
    assert joined.columns == ["k", "v", "d"]
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_full_join_reads_each_side_once_and_spreads_a_hot_key(spark, tmp_path):
    skewed(spark).repartition(8).write.parquet(f"{tmp_path}/fact")
    spark.range(0, 900).select(F.col("id").alias("k"), F.lit("x").alias("d")).write.parquet(f"{tmp_path}/keyed")
    fact, keyed = spark.read.parquet(f"{tmp_path}/fact"), spark.read.parquet(f"{tmp_path}/keyed")
    joined = joins.full_join(fact, keyed, ["k"], 100)
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    reads = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    # One read of each side; the rest count the keys of the large side.
    assert reads.count("k:bigint,v:string") == 1 and reads.count("k:bigint,d:string") == 1
    assert set(reads) <= {"k:bigint,v:string", "k:bigint,d:string", "k:bigint"} and "FullOuter" not in plan
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = joins.full_join(fact, keyed, ["k"], 100).where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(held) >= 3


def test_full_join_rejects_repeated_keyed_rows(spark):
    keyed = spark.createDataFrame([(1, 2), (1, 3)], "k bigint, d bigint")
    with pytest.raises(Exception, match="keyed rows share one key"):
        joins.full_join(spark.range(3).withColumnRenamed("id", "k"), keyed, ["k"]).collect()
