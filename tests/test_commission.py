from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from paytrail.operators import commission as c

POLICY = (
    "policy_id string, agent_id string, product_id string, issue_date date, cancel_date date, "
    "annual_premium decimal(18,2), policy_status string, num_renewals int"
)
TIERS = "agent_id string, tier string, effective_start_date date, effective_end_date date"
END = F.to_date


@pytest.fixture(scope="module")
def products(spark):
    rows = [("AUTO", D("0.12")), ("HOME", D("0.15"))]
    return spark.createDataFrame(rows, "product_id string, base_commission_rate decimal(9,4)")


@pytest.fixture(scope="module")
def plans(spark, products):
    return c.build_commission_plans(products, c.plan_starts("2020-01-01", 1, spark))


@pytest.fixture(scope="module")
def tiers(spark):
    rows = [
        ("A1", "Gold", date(2020, 1, 1), date(2020, 6, 1)),
        ("A1", "Platinum", date(2020, 6, 1), None),
        ("A2", "Silver", date(2019, 1, 1), None),
    ]
    return spark.createDataFrame(rows, TIERS)


def policies(spark, *rows):
    full = [(i, a, p, d, x, None if m is None else D(m), s, n) for i, a, p, d, x, m, s, n in rows]
    return spark.createDataFrame(full, POLICY)


def test_rate_card(plans):
    rows = {
        (r["product_id"], r["agent_tier"], r["transaction_type"], str(r["effective_start_date"])): r
        for r in plans.collect()
    }
    assert len(rows) == 2 * 2 * 4 * 2
    first = rows["AUTO", "Gold", "New Business", "2020-01-01"]
    assert first["commission_rate"] == D("0.1380") and first["effective_end_date"] == date(2020, 12, 30)
    second = rows["AUTO", "Gold", "Renewal", "2020-12-31"]
    assert second["commission_rate"] == D("0.0704") and second["effective_end_date"] is None


def test_new_business_rates_and_fallbacks(spark, tiers, plans, products):
    d = date
    df = policies(
        spark,
        ("P1", "A1", "AUTO", d(2020, 6, 1), None, "1000.00", "Active", 0),  # boundary: still Gold
        ("P2", "A1", "AUTO", d(2020, 6, 2), None, "1000.00", "Active", 0),
        ("P3", "A9", "AUTO", d(2020, 6, 2), None, "1000.00", "Active", 0),  # no tier: Bronze
        ("P4", "A2", "AUTO", d(2019, 6, 2), None, "1000.00", "Active", 0),  # before any plan
        ("P5", "A2", "HOME", d(2020, 6, 2), None, None, "Active", 0),
    )
    priced = c.price_policies(df, tiers, plans, products)
    got = {r["policy_id"]: (r["commission_rate"], r["commission_amount"]) for r in c.calc_new_business(priced).collect()}
    assert got == {
        "P1": (D("0.1380"), D("138.00")),
        "P2": (D("0.1560"), D("156.00")),
        "P3": (D("0.0960"), D("96.00")),
        "P4": (D("0.1200"), D("120.00")),
    }


def test_zero_plan_rate_falls_back(spark, plans, tiers, products):
    zero = plans.withColumn("commission_rate", F.lit(0).cast("decimal(9,4)"))
    df = policies(spark, ("P1", "A1", "HOME", date(2020, 3, 1), None, "10.00", "Renewed", 1))
    priced = c.price_policies(df, tiers, zero, products)
    assert priced.first()["new_business_rate"] == D("0.1500")
    renewal = c.calc_renewals(priced, df, tiers, zero, END(F.lit("2030-01-01"))).first()
    assert renewal["commission_rate"] == D("0.0750")
    assert renewal["commission_amount"] == D("0.75")


def test_chargeback_window_is_inclusive(spark, tiers, plans, products):
    issued = date(2020, 1, 1)
    df = policies(
        spark,
        ("D90", "A1", "AUTO", issued, date(2020, 3, 31), "100.00", "Cancelled", 0),
        ("D91", "A1", "AUTO", issued, date(2020, 4, 1), "100.00", "Cancelled", 0),
        ("ACT", "A1", "AUTO", issued, date(2020, 1, 2), "100.00", "Active", 0),
        ("NUL", "A1", "AUTO", issued, None, "100.00", "Cancelled", 0),
    )
    got = c.calc_chargebacks(c.price_policies(df, tiers, plans, products)).collect()
    assert [(r["policy_id"], r["original_transaction_id"], r["chargeback_amount"]) for r in got] == [
        ("D90", "NB-D90", D("-13.80"))
    ]


def test_renewals_stop_at_the_end_and_use_the_tier_of_the_day(spark, tiers, plans, products):
    df = policies(
        spark,
        ("P1", "A1", "AUTO", date(2020, 3, 1), None, "1000.00", "Renewed", 3),
        ("P2", "A9", "AUTO", date(2020, 3, 1), None, "1000.00", "Renewed", 0),
        ("P3", "A9", "AUTO", date(2020, 3, 1), None, "1000.00", "Active", 2),
    )
    priced = c.price_policies(df, tiers, plans, products)
    got = c.calc_renewals(priced, df, tiers, plans, END(F.lit("2022-03-01"))).orderBy("transaction_date").collect()
    assert [(r["transaction_id"], r["transaction_date"], r["commission_rate"]) for r in got] == [
        ("RN-P1-1", date(2021, 3, 1), D("0.0796")),
        ("RN-P1-2", date(2022, 3, 1), D("0.0796")),
    ]


def test_overrides_pay_the_direct_upline_only(spark):
    sold = spark.createDataFrame(
        [("T1", "P", "low", "X", "New Business", "10.05"), ("T2", "P", "low", "X", "Renewal", "-1.00"),
         ("T3", "P", "mid", "X", "New Business", "1.00"), ("T4", "P", "low", "X", "Override", "9.00"),
         ("T5", "P", "top", "X", "New Business", "9.00")],
        "transaction_id string, policy_id string, agent_id string, product_id string, transaction_type string, m string",
    ).select("*", F.lit(date(2020, 1, 1)).alias("transaction_date"), F.lit(D("1.00")).alias("premium_amount"),
             F.col("m").cast("decimal(18,2)").alias("commission_amount"))
    agents = spark.createDataFrame([("low", "mid"), ("mid", "top"), ("top", None)], "agent_id string, upline_agent_id string")
    got = {r["transaction_id"]: (r["agent_id"], r["commission_amount"]) for r in c.calc_overrides(sold, agents).collect()}
    assert got == {"OV-T1": ("mid", D("1.01")), "OV-T2": ("mid", D("-0.10")), "OV-T3": ("top", D("0.10"))}


def test_payment_run_keeps_orphans_and_holds_below_the_threshold(spark):
    txn = spark.createDataFrame(
        [("a", "2025-01", 100.0), ("a", "2025-01", 50.0), ("h", "2025-01", 0.0), ("n", None, 5.0), (None, "2025-01", 5.0)],
        "agent_id string, pay_period string, commission_amount double",
    )
    cb = spark.createDataFrame(
        [("a", "2025-01", -25.5), ("o", "2025-02", -500.0), ("h", "2025-01", -500.01)],
        "agent_id string, pay_period string, chargeback_amount double",
    )
    got = {
        (r["agent_id"], r["pay_period"]): (r["gross_commission"], r["net_payment_amount"], r["payment_status"], r["payment_date"])
        for r in c.calc_payment_run(txn, cb).collect()
    }
    assert got == {
        ("a", "2025-01"): (D("150.00"), D("124.50"), "Paid", date(2025, 2, 5)),
        ("o", "2025-02"): (D("0.00"), D("-500.00"), "Paid", date(2025, 3, 5)),
        ("h", "2025-01"): (D("0.00"), D("-500.01"), "Held", date(2025, 2, 5)),
    }


def test_eligible_agents_and_sale_window(spark):
    d = date
    rows = [
        ("a", "Active", d(2021, 1, 1), None), ("a", "Active", d(2021, 1, 1), None),
        ("t", "Terminated", d(2019, 1, 1), d(2019, 5, 1)), ("s", "Suspended", d(2019, 1, 1), d(2021, 5, 1)),
        ("x", None, d(2022, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "agent_id string, agent_status string, hire_date date, termination_date date")
    assert sorted(r["agent_id"] for r in c.eligible_agents(df).collect()) == ["a", "s", "x"]
    first, last = F.lit(d(2020, 1, 1)), F.lit(d(2022, 1, 1))
    got = {r["agent_id"]: (r["sale_window_start"], r["sale_window_end"]) for r in c.with_sale_window(df, first, last).collect()}
    assert got == {
        "a": (d(2021, 1, 1), d(2022, 1, 1)),
        "t": (d(2020, 1, 1), d(2022, 1, 1)),  # tenure outside the range: the whole range
        "s": (d(2020, 1, 1), d(2021, 5, 1)),
        "x": (d(2020, 1, 1), d(2022, 1, 1)),  # an empty range too
    }


@pytest.fixture(scope="module")
def sold_policies(spark):
    """Hot agent, uncovered days, no seller, no issue date, no premium, repeated rows and an unknown product."""
    d = date
    rows = [
        (f"H{i}", "A1", "AUTO", d(2020, 1 + i % 12, 1), None, "100.00", "Renewed", i % 4) for i in range(12)
    ] + [
        ("G1", "A3", "HOME", d(2020, 2, 1), None, "1000.00", "Renewed", 2),  # tier ends before the renewals
        ("G2", None, "HOME", d(2020, 2, 1), None, "1000.00", "Renewed", 1),
        ("G3", "A2", "HOME", None, None, "1000.00", "Renewed", 1),
        ("G4", "A2", "HOME", d(2020, 2, 1), None, None, "Renewed", 1),
        ("G5", "A2", "BOAT", d(2020, 2, 1), None, "10.00", "Active", 3),
        ("G6", "A2", None, d(2020, 2, 1), None, "10.00", None, None),
        ("G7", "A2", "AUTO", d(2021, 2, 1), None, "10.00", "Renewed", -1),
        ("G8", "A2", "AUTO", d(2021, 2, 1), None, "10.00", "Renewed", 5),
        ("G8", "A2", "AUTO", d(2021, 2, 1), None, "10.00", "Renewed", 5),
    ]
    return policies(spark, *rows)


@pytest.mark.parametrize("limit", [None, -1])
def test_sales_in_one_pass_equal_both_kinds_appended(spark, sold_policies, tiers, plans, products, limit):
    ended = spark.createDataFrame([("A3", "Platinum", date(2020, 1, 1), date(2020, 12, 31))], TIERS)
    history, end = tiers.union(ended), END(F.lit("2023-01-01"))
    priced = c.price_policies(sold_policies, history, plans, products)
    apart = c.calc_new_business(priced).unionByName(c.calc_renewals(priced, sold_policies, history, plans, end))
    got = c.calc_sales(sold_policies, history, plans, products, end, limit)
    assert got.columns == c.TRANSACTION_COLUMNS
    assert sorted(got.collect(), key=str) == sorted(apart.collect(), key=str)
    late = {r["transaction_id"]: r["commission_rate"] for r in got.where("policy_id = 'G1'").collect()}
    assert late["RN-G1-1"] == D("0.0995")  # still the tier at issue, by the second plan year


@pytest.mark.parametrize("limit", [None, -1])
def test_overrides_beside_their_sales(spark, limit):
    agents = spark.createDataFrame(
        [("A1", "A2"), ("A2", None), ("A9", "A1")], "agent_id string, upline_agent_id string"
    )
    on = date(2020, 1, 1)
    rows = [
        ("T1", "P1", "A1", "AUTO", "New Business", on, D("100.00"), D("0.1000"), D("10.05")),
        ("T1", "P1", "A1", "AUTO", "New Business", on, D("100.00"), D("0.1000"), D("10.05")),
        ("T2", "P1", "A1", None, "Renewal", None, D("100.00"), D("0.1000"), None),
        ("T3", "P2", "A2", "AUTO", "Renewal", on, D("100.00"), D("0.1000"), D("-1.00")),
        ("T4", "P3", None, "AUTO", "Renewal", on, D("100.00"), D("0.1000"), D("1.00")),
        (None, "P3", "A9", "AUTO", "Override", on, D("100.00"), D("0.1000"), D("1.00")),
        ("T6", "P3", "A9", "AUTO", None, on, D("100.00"), D("0.1000"), D("1.00")),
    ]
    kinds = "string, string, string, string, string, date, decimal(18,2), decimal(9,4), decimal(18,2)".split(", ")
    sold = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(c.TRANSACTION_COLUMNS, kinds)))
    want = sold.unionByName(c.calc_overrides(sold, agents))
    got = c.with_overrides(sold, agents, limit=limit).collect()
    assert sorted(got, key=str) == sorted(want.collect(), key=str)
    assert [r["transaction_id"] for r in got if r["agent_id"] == "A2" and r["transaction_type"] == "Override"] == [
        "OV-T1", "OV-T1", "OV-T2"
    ]
