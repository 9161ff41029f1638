from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from paytrail.plans import marts

TXN = "transaction_id string, agent_id string, pay_period string, transaction_type string, commission_amount double"
CB = "chargeback_id string, agent_id string, pay_period string, chargeback_amount double"
AGENT = "agent_id string, first_name string, last_name string, agency_id string, tier string, agent_status string, is_current boolean"


@pytest.fixture(scope="module")
def agents(spark):
    rows = [
        ("a", "Ann", "Lee", "Y1", "Gold", "Active", True),
        ("a", "Ann", "Lee", "Y1", "Bronze", "Active", False),
        ("b", "Bo", None, "Y2", "Silver", "Active", True),
    ]
    return spark.createDataFrame(rows, AGENT)


def test_summary_by_type_with_chargebacks(spark, agents):
    txn = spark.createDataFrame(
        [("1", "a", "2025-01", "New Business", 10.0), ("2", "a", "2025-01", "Renewal", 2.5),
         ("3", "a", "2025-01", "Bonus", 99.0), ("4", "u", "2025-02", "Other", 7.0),
         ("5", None, "2025-01", "Override", 1.0)], TXN)
    cb = spark.createDataFrame(
        [("c1", "a", "2025-01", -4.0), ("c2", "a", "2025-03", -9.0), ("c3", None, "2025-01", -1.0)], CB)
    got = {(r["agent_id"], r["pay_period"]): r for r in marts.agent_commission_summary(txn, cb, agents).collect()}
    assert set(got) == {("a", "2025-01"), ("u", "2025-02"), (None, "2025-01")}  # orphan chargeback is lost
    a = got["a", "2025-01"]
    assert (a["gross_commission"], a["chargeback_deductions"], a["net_commission"]) == (D("12.50"), D("-4.00"), D("8.50"))
    assert (a["agent_name"], a["tier"]) == ("Ann Lee", "Gold")
    u = got["u", "2025-02"]
    assert (u["gross_commission"], u["net_commission"], u["agent_name"]) == (D("0.00"), D("0.00"), None)
    assert got[None, "2025-01"]["chargeback_deductions"] == D("0.00")


def test_summary_sums_both_facts_without_a_join(spark, agents):
    txn = spark.createDataFrame([("1", "a", "2025-01", "New Business", 10.0)], TXN)
    cb = spark.createDataFrame([("c1", "a", "2025-01", -4.0)], CB)
    plan = marts.agent_commission_summary(txn, cb, agents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(agent_id#") == plan.count("hashpartitioning") and plan.count("Join") == 1
    assert sum("pay_period" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 1


def test_exposure_threshold_is_strict(spark, agents):
    txn = spark.createDataFrame(
        [("1", "a", "p", "New Business", 100.0), (None, "a", "p", "New Business", 100.0),
         ("2", "b", "p", "New Business", 100.0), ("3", "c", "p", "Renewal", 100.0), ("4", "z", "p", "New Business", 0.0)], TXN)
    cb = spark.createDataFrame(
        [("k1", "a", "p", -50.0), ("k2", "b", "p", -25.01), ("k3", "c", "p", -1.0), ("k4", "z", "p", -1.0)], CB)
    got = {r["agent_id"]: r for r in marts.chargeback_exposure(txn, cb, agents).collect()}
    assert set(got) == {"a", "b", "z"}
    assert (got["a"]["chargeback_rate"], got["a"]["is_high_risk"], got["a"]["new_business_count"]) == (0.25, False, 1)
    assert (got["b"]["is_high_risk"], got["b"]["chargeback_count"], got["b"]["agent_name"]) == (True, 1, "Bo")
    assert (got["z"]["chargeback_rate"], got["z"]["is_high_risk"]) == (0.0, False)


def test_leaderboard_window_and_ties(spark):
    rows = [("a", "2024-01", 1000.0), ("a", "2024-02", 10.0), ("a", "2025-01", 20.0), ("b", "2024-12", 30.0), ("c", "2025-01", 5.0)]
    df = spark.createDataFrame(rows, "agent_id string, pay_period string, net_commission double").selectExpr(
        "*", "agent_id AS agent_name", "'Y' AS agency_id", "'Gold' AS tier", "net_commission AS gross_commission", "0.0 AS chargeback_deductions")
    got = {r["agent_id"]: (r["trailing_12mo_net_commission"], r["rank"]) for r in marts.agent_leaderboard(df).collect()}
    assert got == {"a": (D("30.00"), 1), "b": (D("30.00"), 1), "c": (D("5.00"), 3)}
    assert marts.agent_leaderboard(df.where("false")).isEmpty()


def reconcile(spark, **options):
    calculated = spark.createDataFrame(
        [("Q-17", "Ida", "2031-07", 812.5), ("Q-17", "Ida", "2031-08", 40.0), ("Q-22", "Jo", "2031-07", 77.7),
         ("Q-31", "Kai", "2031-09", 64.2), ("Q-40", "Lou", "2031-07", 350.0), ("Q-41", "Mia", "2031-07", 120.0), (None, "Nil", "2031-07", 3.0)],
        "agent_id string, agent_name string, pay_period string, net_commission double")
    paid = spark.createDataFrame(
        [("Q-17", "2031-07", 812.5, "Paid"), ("Q-17", "2031-08", 58.25, "Paid"), ("Q-90", "2031-07", 15.4, "Held"),
         ("Q-40", "2031-07", 351.0, "Paid"), ("Q-41", "2031-07", 118.99, "Paid"), ("Q-41", "2031-07", 120.0, "Paid"),
         (None, "2031-07", 6.0, "Paid")],
        "agent_id string, pay_period string, net_payment_amount double, payment_status string")
    return calculated, paid, marts.reconciliation_report(calculated, paid, **options)


@pytest.mark.parametrize("hot_limit", [2, 10_000])
def test_reconciliation_statuses(spark, hot_limit):
    calculated, paid, report = reconcile(spark, hot_limit=hot_limit)
    got = sorted((str(r["agent_id"]), r["reconciliation_status"], r["variance"]) for r in report.collect())
    assert got == [
        ("None", "CALCULATED_BUT_NOT_PAID", D("-3.00")), ("None", "PAID_WITHOUT_CALCULATION", D("6.00")),
        ("Q-17", "BREAK", D("18.25")), ("Q-17", "MATCHED", D("0.00")),
        ("Q-22", "CALCULATED_BUT_NOT_PAID", D("-77.70")), ("Q-31", "CALCULATED_BUT_NOT_PAID", D("-64.20")),
        ("Q-40", "MATCHED", D("1.00")), ("Q-41", "BREAK", D("-1.01")), ("Q-41", "MATCHED", D("0.00")),
        ("Q-90", "PAID_WITHOUT_CALCULATION", D("15.40")),
    ]
    plain = calculated.join(paid, ["agent_id", "pay_period"], "full_outer")
    assert plain.count() == report.count()
    sizes = [abs(r["variance"]) for r in report.collect()]
    assert sizes == sorted(sizes, reverse=True)


def test_headline(spark):
    report = reconcile(spark)[2]
    assert marts.reconciliation_headline(report).first().asDict() == {
        "matched_periods": 3, "total_periods": 10, "break_periods": 7,
    }


def test_variances_add_up(spark, sf):
    from paytrail.plans import queries as q
    from paytrail.plans import workload as w

    summary, paid = q._summary(spark, sf), w.payments(spark, sf)
    total = marts.reconciliation_report(summary, paid, ordered=False).agg(F.sum("variance")).first()[0]
    assert total == paid.agg(F.sum("net_payment_amount")).first()[0] - summary.agg(F.sum("net_commission")).first()[0]


def test_payment_run_summary(spark, agents):
    paid = spark.createDataFrame(
        [("1", "a", "2025-01", 10.0, -1.0, 9.0, "Paid"), ("2", "a", "2025-01", 5.0, 0.0, 5.0, "Held"),
         ("3", "b", "2025-01", 1.0, 0.0, 1.0, None), ("4", "q", "2025-01", 2.0, 0.0, 2.0, "Failed")],
        "payment_id string, agent_id string, pay_period string, gross_commission double, "
        "chargeback_deductions double, net_payment_amount double, payment_status string")
    agencies = spark.createDataFrame([("Y1", "One", "West")], "agency_id string, agency_name string, region string")
    got = marts.payment_run_summary(paid, agents, agencies).collect()
    assert [(r["agency_id"], r["agency_name"], r["num_payments"], r["total_net_paid"], r["num_held"], r["num_failed"]) for r in got] == [
        (None, None, 1, D("2.00"), 0, 1), ("Y1", "One", 2, D("14.00"), 1, 0), ("Y2", None, 1, D("1.00"), 0, 0),
    ]
