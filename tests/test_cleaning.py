from datetime import date, datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.functions import (
    cents,
    from_cents,
    in_cents,
    month_after,
    parse_date,
    pay_period,
    payment_date,
    published,
)
from paytrail.operators.cleaning import dedup_latest, latest_snapshot, split_quarantine
from paytrail.plans.silver import clean_agents, dim_policy, fact_commission_transactions


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_dates_and_periods(spark):
    assert one(spark, parse_date(F.lit("2025-02-03"))) == date(2025, 2, 3)
    assert one(spark, parse_date(F.lit("not a date"))) is None
    assert one(spark, pay_period(F.lit("2025-02-03"))) == "2025-02"
    assert one(spark, pay_period(F.lit("2025-02"))) == "2025-02"
    assert one(spark, pay_period(F.lit(datetime(2025, 2, 3, 23, 59)))) == "2025-02"
    assert one(spark, pay_period(F.lit(None).cast("date"))) is None
    assert one(spark, month_after(F.lit("2025-01"), -11)) == "2024-02"
    assert one(spark, payment_date(F.lit("2024-02"))) == date(2024, 3, 5)


def test_cents_round_half_up(spark):
    for text, want in [("0.005", "0.01"), ("-0.005", "-0.01"), ("1.0049", "1.00"), ("2.675", "2.68")]:
        assert one(spark, cents(F.lit(Decimal(text)))) == Decimal(want)


def test_published_types(spark):
    df = published(spark.sql("SELECT 1 AS i, 1.50BD AS m, DATE'2025-01-31' AS d, 'x' AS `a b`"))
    assert dict(df.dtypes) == {"i": "bigint", "m": "double", "d": "string", "a b": "string"}
    assert tuple(df.first()) == (1, 1.5, "2025-01-31", "x")


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-02-01"), (3, "2025-02-01"), (4, None)], "n int, d string")
    assert sorted(r["n"] for r in latest_snapshot(df, "d").collect()) == [2, 3]
    assert latest_snapshot(df.where("false"), "d").isEmpty()


def test_dedup_is_deterministic(spark):
    rows = [(1, "old", 1), (1, "new", 2), (2, "b", 1), (2, "a", 1), (None, "n", 1), (None, "n", 0)]
    df = spark.createDataFrame(rows, "k int, v string, seq int")
    got = {r["k"]: (r["v"], r["seq"]) for r in dedup_latest(df, ["k"], [F.col("seq").desc()]).collect()}
    assert got == {1: ("new", 2), 2: ("b", 1), None: ("n", 1)}


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=20))
def test_split_covers_every_row_once(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    clean, bad = split_quarantine(df, F.col("v") > 0)
    got, rest = [r["v"] for r in clean.collect()], [r["v"] for r in bad.collect()]
    assert sorted(got) == sorted(v for v in values if v is not None and v > 0)
    assert len(got) + len(rest) == len(values)


def test_quarantine_filter_reaches_the_scan(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    for part in split_quarantine(lines, F.col("l_tax") > 0):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "l_tax" in plan.split("PushedFilters:")[1].split("]")[0]


def test_transactions_split_and_period(spark):
    rows = [
        ("TXN001", "2025-01-15", 120.0),
        ("TXN002", "2025-01-16", -120.0),
        ("TXN003", "2025-02-01", 60.0),
        ("TXN004", "2025-02-01", 0.0),
        ("TXN005", "2025-02-01", None),
        ("TXN006", "bad", 1.0),
    ]
    df = spark.createDataFrame(rows, "transaction_id string, transaction_date string, commission_amount double")
    clean, bad = fact_commission_transactions(df.withColumn("_ingested_at", F.current_timestamp()))
    assert {r["transaction_id"]: r["pay_period"] for r in clean.collect()} == {
        "TXN001": "2025-01", "TXN003": "2025-02", "TXN006": None,
    }
    assert {r["transaction_id"] for r in bad.collect()} == {"TXN002", "TXN004", "TXN005"}
    assert "_ingested_at" not in clean.columns


def test_policies_keep_the_newest_load(spark):
    rows = [
        ("P1", 10.0, datetime(2025, 1, 1)),
        ("P1", 11.0, datetime(2025, 1, 2)),
        ("P2", 5.0, datetime(2025, 1, 1)),
        ("P2", None, datetime(2025, 1, 3)),
    ]
    df = spark.createDataFrame(rows, "policy_id string, annual_premium double, _ingested_at timestamp").selectExpr(
        "*", "'2025-01-01' AS issue_date", "'2025-01-01' AS policy_start_date", "CAST(NULL AS string) AS cancel_date"
    )
    clean, bad = dim_policy(df)
    assert [(r["policy_id"], r["annual_premium"]) for r in clean.collect()] == [("P1", 11.0)]
    assert [r["policy_id"] for r in bad.collect()] == ["P2"]


def test_agents_are_cleaned(spark):
    rows = [("A1", " tx ", "2020-01-01", None), ("A1", " tx ", "2020-01-01", None), (None, "NY", None, None)]
    df = spark.createDataFrame(rows, "agent_id string, license_state string, hire_date string, termination_date string")
    assert [tuple(r) for r in clean_agents(df).collect()] == [("A1", "TX", date(2020, 1, 1), None)]


def test_cents_hold_every_amount_exactly(spark):
    for text in ("9999999999999999.99", "-9999999999999999.99", "0.01", "-0.01", "0.00"):
        amount = F.lit(Decimal(text)).cast("decimal(18,2)")
        assert one(spark, in_cents(amount)) == int(Decimal(text) * 100)
        assert one(spark, from_cents(in_cents(amount))) == Decimal(text)
    assert one(spark, from_cents(in_cents(F.lit(None).cast("double")))) is None
    assert one(spark, in_cents(F.lit(0.1) + F.lit(0.2))) == 30
