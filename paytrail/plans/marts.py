"""Gold marts, each a function of silver (or gold) frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.config import (
    HOT_KEY_LIMIT,
    BREAK_TOLERANCE,
    HIGH_RISK_THRESHOLD,
    NEW_BUSINESS,
    OVERRIDE,
    RENEWAL,
    TRAILING_MONTHS,
)
from paytrail.functions import cents, from_cents, in_cents, money, month_after
from paytrail.operators.history import current_dimension
from paytrail.operators.joins import full_join
from paytrail.operators.numbering import global_rank

PERIOD_KEY = ["agent_id", "pay_period"]

# What a period of the reconciliation can be, as its readers expect it.
PAID_ONLY, CALCULATED_ONLY = "PAID_WITHOUT_CALCULATION", "CALCULATED_BUT_NOT_PAID"
BREAK, MATCHED = "BREAK", "MATCHED"


def _zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def _cents_or_zero(c: Column) -> Column:
    return from_cents(F.coalesce(F.sum(c), F.lit(0)))


def current_agents(dim_agent: DataFrame, *attributes: str) -> DataFrame:
    """Today's attributes of each agent, the name in one column."""
    named = current_dimension(dim_agent).withColumn(
        "agent_name", F.concat_ws(" ", "first_name", "last_name")
    )
    return named.select("agent_id", *attributes)


def agent_commission_summary(
    transactions: DataFrame, chargebacks: DataFrame, dim_agent: DataFrame
) -> DataFrame:
    """One row per agent and period: commission by type, chargebacks, net, agent attributes.

    Chargebacks are summed next to the transactions in one aggregation, instead of
    two aggregations and a left join; periods without a transaction are then dropped.
    """
    earned = transactions.select(
        *PERIOD_KEY,
        F.col("transaction_type").alias("_kind"),
        in_cents("commission_amount").alias("_cents"),
        F.lit(1).alias("_earned"),
    )
    clawed = chargebacks.where("agent_id IS NOT NULL AND pay_period IS NOT NULL").select(
        *PERIOD_KEY,
        F.lit(None).cast("string").alias("_kind"),
        in_cents("chargeback_amount").alias("_cents"),
        F.lit(0).alias("_earned"),
    )

    def of_type(kind: str) -> Column:
        return _cents_or_zero(F.when(F.col("_kind") == kind, F.col("_cents")))

    clawed_back = _cents_or_zero(F.when(F.col("_earned") == 0, F.col("_cents")))
    sums = earned.unionByName(clawed).groupBy(*PERIOD_KEY).agg(
        of_type(NEW_BUSINESS).alias("new_business_commission"),
        of_type(RENEWAL).alias("renewal_commission"),
        of_type(OVERRIDE).alias("override_commission"),
        clawed_back.alias("chargeback_deductions"),
        F.max("_earned").alias("_earned"),
    )
    gross = (
        F.col("new_business_commission") + F.col("renewal_commission") + F.col("override_commission")
    )
    summary = sums.where("_earned = 1").select(
        *PERIOD_KEY,
        "new_business_commission",
        "renewal_commission",
        "override_commission",
        money(gross).alias("gross_commission"),
        "chargeback_deductions",
        money(gross + F.col("chargeback_deductions")).alias("net_commission"),
    )
    attributes = current_agents(dim_agent, "agent_name", "agency_id", "tier", "agent_status")
    return summary.join(attributes, "agent_id", "left")


def payment_run_summary(
    payments: DataFrame, dim_agent: DataFrame, dim_agency: DataFrame
) -> DataFrame:
    """Payments per period and agency. Payments are summed per agent before any join."""
    per_agent = payments.groupBy(*PERIOD_KEY).agg(
        F.count("payment_id").alias("num_payments"),
        F.sum(in_cents("gross_commission")).alias("total_gross_commission"),
        F.sum(in_cents("chargeback_deductions")).alias("total_chargeback_deductions"),
        F.sum(in_cents("net_payment_amount")).alias("total_net_paid"),
        F.count_if(F.col("payment_status") == "Held").alias("num_held"),
        F.count_if(F.col("payment_status") == "Failed").alias("num_failed"),
    )
    measures = per_agent.columns[len(PERIOD_KEY):]
    agencies = dim_agency.select("agency_id", "agency_name", "region")
    placed = per_agent.join(current_agents(dim_agent, "agency_id"), "agent_id", "left")
    per_agency = placed.groupBy("pay_period", "agency_id").agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    named = per_agency.join(agencies, "agency_id", "left")
    totals = named.groupBy("pay_period", "agency_id", "agency_name", "region").agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    amounts = {m: from_cents(m) for m in measures if m.startswith("total_")}
    return totals.withColumns(amounts).orderBy("pay_period", "agency_id")


def chargeback_exposure(
    transactions: DataFrame, chargebacks: DataFrame, dim_agent: DataFrame
) -> DataFrame:
    """Per agent with new business: how much of it was clawed back, and whether that is a risk."""
    written = transactions.where(F.col("transaction_type") == NEW_BUSINESS).select(
        "agent_id",
        in_cents("commission_amount").alias("_new"),
        F.col("transaction_id").isNotNull().cast("int").alias("_new_id"),
        F.lit(None).cast("bigint").alias("_back"),
        F.lit(0).alias("_back_id"),
        F.lit(1).alias("_wrote"),
    )
    clawed = chargebacks.where("agent_id IS NOT NULL").select(
        "agent_id",
        F.lit(None).cast("bigint").alias("_new"),
        F.lit(0).alias("_new_id"),
        F.abs(in_cents("chargeback_amount")).alias("_back"),
        F.col("chargeback_id").isNotNull().cast("int").alias("_back_id"),
        F.lit(0).alias("_wrote"),
    )
    sums = written.unionByName(clawed).groupBy("agent_id").agg(
        from_cents(F.sum("_new")).alias("new_business_commission"),
        F.sum("_new_id").alias("new_business_count"),
        _cents_or_zero(F.col("_back")).alias("total_chargeback_amount"),
        F.sum("_back_id").alias("chargeback_count"),
        F.max("_wrote").alias("_wrote"),
    )
    new, back = F.col("new_business_commission"), F.col("total_chargeback_amount")
    share = F.when(new > 0, back.cast("double") / new.cast("double")).otherwise(0.0)
    # The flag compares exact decimals: the threshold itself is not high risk.
    risky = (new > 0) & (back > new * F.lit(HIGH_RISK_THRESHOLD))
    exposure = sums.where("_wrote = 1").drop("_wrote").withColumns(
        {"chargeback_rate": share, "is_high_risk": F.coalesce(risky, F.lit(False))}
    )
    attributes = current_agents(dim_agent, "agent_name", "agency_id", "tier")
    return exposure.join(attributes, "agent_id", "left").orderBy(F.col("chargeback_rate").desc(), "agent_id")


def trailing_periods(summary: DataFrame, months: int = TRAILING_MONTHS) -> DataFrame:
    """The rows of the last periods, ending with the newest one present.

    The newest period stays a subquery of the plan, so it prunes period folders.
    """
    newest = summary.agg(F.max("pay_period").alias("newest"))
    first = newest.select(month_after("newest", 1 - months)).scalar()
    return summary.where(F.col("pay_period") >= first)


def agent_leaderboard(summary: DataFrame) -> DataFrame:
    """Agents ranked by net commission over the trailing twelve months."""
    totals = trailing_periods(summary).groupBy("agent_id", "agent_name", "agency_id", "tier").agg(
        from_cents(F.sum(in_cents("gross_commission"))).alias("trailing_12mo_gross_commission"),
        from_cents(F.sum(in_cents("net_commission"))).alias("trailing_12mo_net_commission"),
        from_cents(F.sum(in_cents("chargeback_deductions"))).alias("trailing_12mo_chargebacks"),
    )
    return global_rank(totals, "trailing_12mo_net_commission")


def reconciliation_report(
    summary: DataFrame, payments: DataFrame, ordered: bool = True, hot_limit: int = HOT_KEY_LIMIT
) -> DataFrame:
    """Calculated against recorded pay, per agent and period, with the verdict.

    A plain full outer join cannot split a frequent key and gathers all NULL keys in one task;
    ``full_join`` does neither. The summary holds one row per agent and period.
    """
    calculated = summary.select(
        "agent_id", "agent_name", "pay_period", F.col("net_commission").alias("calculated_net_commission")
    )
    paid = payments.select(
        "agent_id",
        "pay_period",
        F.col("net_payment_amount").alias("recorded_net_payment"),
        "payment_status",
    )
    both = full_join(paid, calculated, PERIOD_KEY, hot_limit)

    calc, recorded = F.col("calculated_net_commission"), F.col("recorded_net_payment")
    variance = cents(F.coalesce(money(recorded), _zero()) - F.coalesce(money(calc), _zero()))
    status = (
        F.when(calc.isNull(), PAID_ONLY)
        .when(recorded.isNull(), CALCULATED_ONLY)
        .when(F.abs("variance") > F.lit(BREAK_TOLERANCE), BREAK)
        .otherwise(MATCHED)
    )
    report = both.withColumn("variance", variance).withColumn("reconciliation_status", status).select(
        "agent_id",
        "pay_period",
        "agent_name",
        "calculated_net_commission",
        "recorded_net_payment",
        "payment_status",
        "variance",
        "reconciliation_status",
    )
    # the keys split the many rows without variance over the tasks of the sort
    return report.orderBy(F.abs("variance").desc(), "agent_id", "pay_period") if ordered else report


def reconciliation_headline(report: DataFrame) -> DataFrame:
    """Totals of a reconciliation: all, matched and broken periods."""
    matched = F.count_if(F.col("reconciliation_status") == MATCHED)
    total = F.count(F.lit(1))
    return report.agg(
        matched.alias("matched_periods"),
        total.alias("total_periods"),
        (total - matched).alias("break_periods"),
    )
