"""Commission, override, renewal, chargeback and payment-run calculation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.config import (
    ANNUAL_RATE_DRIFT,
    CHARGEBACK_WINDOW_DAYS,
    DEFAULT_TIER,
    NEW_BUSINESS,
    OVERRIDE,
    OVERRIDE_RATE,
    PAYMENT_HOLD_THRESHOLD,
    PLAN_YEAR_DAYS,
    RENEWAL,
    RENEWAL_RATIO,
    TIER_MULTIPLIER,
)
from paytrail.functions import cents, from_cents, in_cents, money, payment_date, rate
from paytrail.operators.cleaning import dedup_latest
from paytrail.operators.joins import as_of_join, skew_join

TRANSACTION_COLUMNS = [
    "transaction_id",
    "policy_id",
    "agent_id",
    "product_id",
    "transaction_type",
    "transaction_date",
    "premium_amount",
    "commission_rate",
    "commission_amount",
]


def plan_starts(first: str, years: int, spark) -> DataFrame:
    """Starts of plan years 0..years, each of 365 days."""
    start = F.date_add(F.to_date(F.lit(first)), F.col("year_index") * PLAN_YEAR_DAYS)
    index = spark.range(years + 1).select(F.col("id").cast("int").alias("year_index"))
    return index.select("year_index", start.alias("effective_start_date"))


def build_commission_plans(products: DataFrame, starts: DataFrame) -> DataFrame:
    """The effective-dated rate card: product x plan year x tier x type.

    ``products`` brings product_id and base_commission_rate, ``starts`` year_index and
    effective_start_date. A plan ends the day before the next starts. Tiers, types and
    plan years are a handful of configured values, so each product row is
    exploded over them in place.
    """
    following = F.lead("effective_start_date").over(Window.orderBy("effective_start_date"))
    years = starts.withColumn("effective_end_date", F.date_sub(following, 1)).agg(
        F.array_sort(
            F.collect_list(F.struct("year_index", "effective_start_date", "effective_end_date"))
        )
    )
    variants = F.array(
        *[
            F.struct(
                F.lit(tier).alias("agent_tier"),
                F.lit(kind).alias("transaction_type"),
                F.lit(multiplier * ratio).cast("decimal(6,3)").alias("factor"),
            )
            for tier, multiplier in TIER_MULTIPLIER.items()
            for kind, ratio in ((NEW_BUSINESS, Decimal("1.0")), (RENEWAL, RENEWAL_RATIO))
        ]
    )
    card = (
        products.select("product_id", "base_commission_rate", F.explode(years.scalar()).alias("year"))
        .select("product_id", "base_commission_rate", "year.*")
        .select("*", F.inline(variants))
    )
    drift = (1 + F.lit(ANNUAL_RATE_DRIFT) * F.col("year_index")).cast("decimal(6,2)")
    yearly = rate("base_commission_rate") * F.col("factor") * drift
    return card.select(
        F.concat_ws(
            "-", "product_id", F.col("year_index").cast("string"), "agent_tier", "transaction_type"
        ).alias("plan_id"),
        "product_id",
        "agent_tier",
        "transaction_type",
        rate(F.round(yearly, 4)).alias("commission_rate"),
        "effective_start_date",
        "effective_end_date",
    )


def tier_as_of(
    rows: DataFrame,
    tiers: DataFrame,
    at: str,
    name: str,
    traffic: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Attach the agent's tier on the day ``at``; NULL where no period covers it."""
    periods = tiers.select(
        "agent_id", F.col("tier").alias(name), "effective_start_date", "effective_end_date"
    )
    return as_of_join(rows, periods, ["agent_id"], at, traffic=traffic, limit=limit)


def lookup_rate(
    rows: DataFrame,
    plans: DataFrame,
    kind: str | None,
    tier: str,
    at: str,
    fallback: Column,
    name: str,
    traffic: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Attach the plan rate for product, tier and type on a day; none or zero falls back.

    Without a ``kind`` each row is rated by its own transaction_type.
    """
    keys = ["product_id", tier] if kind else ["product_id", tier, "transaction_type"]
    card = (plans.where(F.col("transaction_type") == kind) if kind else plans).select(
        F.col("agent_tier").alias(tier),
        *[k for k in keys if k != tier],
        "effective_start_date",
        "effective_end_date",
        F.col("commission_rate").alias("_plan_rate"),
    )
    found = as_of_join(rows, card, keys, at, traffic=traffic, limit=limit)
    planned = F.when(F.col("_plan_rate") != 0, F.col("_plan_rate"))
    return found.withColumn(name, rate(F.coalesce(planned, fallback))).drop("_plan_rate")


def price_policies(
    policies: DataFrame, tiers: DataFrame, plans: DataFrame, products: DataFrame
) -> DataFrame:
    """Policies with their base rate, tier at issue, new-business rate and amount.

    A policy without a premium earns nothing and is left out. Frequent agents and
    products are looked up in the policies themselves, not in what is joined so far.
    """
    payable = policies.where(F.col("annual_premium").isNotNull())
    base = products.select("product_id", "base_commission_rate")
    based = skew_join(payable, base, ["product_id"], traffic=policies)
    tiered = tier_as_of(based, tiers, "issue_date", "_tier", traffic=policies).withColumn(
        "tier_at_issue", F.coalesce("_tier", F.lit(DEFAULT_TIER))
    ).drop("_tier")
    rated = lookup_rate(
        tiered,
        plans,
        NEW_BUSINESS,
        "tier_at_issue",
        "issue_date",
        F.col("base_commission_rate"),
        "new_business_rate",
        traffic=policies,
    )
    amount = cents(money("annual_premium") * F.col("new_business_rate"))
    return rated.withColumn("new_business_amount", amount)


def _transaction_id(prefix: str, *parts: str) -> Column:
    """An id that follows from the row itself, so related rows need no join to share it."""
    return F.concat_ws("-", F.lit(prefix), *[F.col(p).cast("string") for p in parts])


def calc_new_business(priced: DataFrame) -> DataFrame:
    """One transaction per priced policy, dated on its issue."""
    return priced.select(
        _transaction_id("NB", "policy_id").alias("transaction_id"),
        "policy_id",
        "agent_id",
        "product_id",
        F.lit(NEW_BUSINESS).alias("transaction_type"),
        F.col("issue_date").alias("transaction_date"),
        money("annual_premium").alias("premium_amount"),
        F.col("new_business_rate").alias("commission_rate"),
        F.col("new_business_amount").alias("commission_amount"),
    )


def calc_chargebacks(priced: DataFrame, window_days: int = CHARGEBACK_WINDOW_DAYS) -> DataFrame:
    """Claw back the new-business amount of policies cancelled within the window.

    The reason is the cancellation's own, where the policies carry one.
    """
    early = (F.col("policy_status") == "Cancelled") & (
        F.datediff("cancel_date", "issue_date") <= window_days
    )
    reason = (
        F.col("cancel_reason") if "cancel_reason" in priced.columns else F.lit(None).cast("string")
    )
    return priced.where(early).select(
        _transaction_id("CB", "policy_id").alias("chargeback_id"),
        _transaction_id("NB", "policy_id").alias("original_transaction_id"),
        "policy_id",
        "agent_id",
        F.col("cancel_date").alias("chargeback_date"),
        reason.alias("chargeback_reason"),
        money(-F.abs("new_business_amount")).alias("chargeback_amount"),
    )


def _renewals_due(end_date: Column) -> Column:
    """How often a policy is renewed up to the end date, or NULL without an issue date."""
    years = F.floor(F.datediff(end_date, F.col("issue_date")) / PLAN_YEAR_DAYS)
    return F.when(F.col("issue_date").isNotNull(), F.least(F.col("num_renewals").cast("bigint"), years))


def _is_renewed() -> Column:
    return (F.col("policy_status") == "Renewed") & (F.col("num_renewals") >= 1)


def renewal_dates(policies: DataFrame, end_date: Column) -> DataFrame:
    """One row per renewal of a renewed policy: every 365 days up to the end date.

    The end date bounds the renewals of a policy, whatever number it states.
    """
    last = _renewals_due(end_date)
    due = F.when(last >= 1, F.sequence(F.lit(1), last.cast("int")))
    expanded = policies.where(_is_renewed()).withColumn("renewal_number", F.explode(due))
    on = F.date_add("issue_date", F.col("renewal_number") * PLAN_YEAR_DAYS)
    return expanded.withColumn("renewal_date", on).where(F.col("renewal_date") <= end_date)


def calc_renewals(
    priced: DataFrame,
    policies: DataFrame,
    tiers: DataFrame,
    plans: DataFrame,
    end_date: Column,
) -> DataFrame:
    """Renewal transactions at the tier and plan in force on each renewal date.

    Frequent agents and products are looked up in the renewals of ``policies``, to price only once.
    """
    due = renewal_dates(priced, end_date)
    traffic = renewal_dates(policies, end_date)
    tiered = tier_as_of(due, tiers, "renewal_date", "_tier", traffic=traffic).withColumn(
        "tier_at_renewal", F.coalesce("_tier", "tier_at_issue")
    )
    rated = lookup_rate(
        tiered,
        plans,
        RENEWAL,
        "tier_at_renewal",
        "renewal_date",
        F.col("base_commission_rate") * F.lit(RENEWAL_RATIO),
        "renewal_rate",
        traffic=traffic,
    )
    return rated.select(
        _transaction_id("RN", "policy_id", "renewal_number").alias("transaction_id"),
        "policy_id",
        "agent_id",
        "product_id",
        F.lit(RENEWAL).alias("transaction_type"),
        F.col("renewal_date").alias("transaction_date"),
        money("annual_premium").alias("premium_amount"),
        F.col("renewal_rate").alias("commission_rate"),
        cents(money("annual_premium") * F.col("renewal_rate")).alias("commission_amount"),
    )


def sale_events(policies: DataFrame, end_date: Column) -> DataFrame:
    """One row per commission event of a payable policy: its issue (number 0) and each renewal due.

    Adds event_number, transaction_date and transaction_type. A policy without a premium has no event;
    one without an issue date keeps its issue, undated.
    """
    due = F.when(_is_renewed(), _renewals_due(end_date))
    last = F.greatest(F.coalesce(due, F.lit(0)), F.lit(0)).cast("int")
    events = policies.where(F.col("annual_premium").isNotNull()).withColumn(
        "event_number", F.explode(F.sequence(F.lit(0), last))
    )
    kind = F.when(F.col("event_number") == 0, F.lit(NEW_BUSINESS)).otherwise(F.lit(RENEWAL))
    on = F.date_add("issue_date", F.col("event_number") * PLAN_YEAR_DAYS)
    return events.withColumns({"transaction_date": on, "transaction_type": kind})


def calc_sales(
    policies: DataFrame,
    tiers: DataFrame,
    plans: DataFrame,
    products: DataFrame,
    end_date: Column,
    limit: int | None = None,
) -> DataFrame:
    """New-business and renewal transactions in one pass: policies are priced and rated once.

    Equals ``calc_new_business`` and ``calc_renewals`` of the priced policies, appended. The tier at
    issue is found per policy; then the policy's events are exploded, renewals look up the tier of
    their own day, and all events meet the rate card in one join on product, tier and type. Both tier
    lookups share the periods. Frequent keys are counted on the events, as joined.
    """
    payable = policies.where(F.col("annual_premium").isNotNull())
    events = sale_events(policies, end_date)
    base = products.select("product_id", "base_commission_rate")
    based = skew_join(payable, base, ["product_id"], traffic=payable, limit=limit)
    issued = tier_as_of(based, tiers, "issue_date", "_tier", traffic=payable, limit=limit).withColumn(
        "tier_at_issue", F.coalesce("_tier", F.lit(DEFAULT_TIER))
    ).drop("_tier")
    renewed_on = F.when(F.col("event_number") > 0, F.col("transaction_date"))
    due = sale_events(issued, end_date).withColumn("_renewed_on", renewed_on)
    tiered = tier_as_of(due, tiers, "_renewed_on", "_tier", traffic=events, limit=limit).withColumn(
        "agent_tier", F.coalesce("_tier", "tier_at_issue")
    )
    is_new = F.col("event_number") == 0
    share = F.when(is_new, F.lit(Decimal("1.0"))).otherwise(F.lit(RENEWAL_RATIO))
    rated = lookup_rate(
        tiered,
        plans,
        None,
        "agent_tier",
        "transaction_date",
        F.col("base_commission_rate") * share,
        "commission_rate",
        traffic=events,
        limit=limit,
    )
    new_id, renewal_id = _transaction_id("NB", "policy_id"), _transaction_id("RN", "policy_id", "event_number")
    return rated.select(
        F.when(is_new, new_id).otherwise(renewal_id).alias("transaction_id"),
        "policy_id",
        "agent_id",
        "product_id",
        "transaction_type",
        "transaction_date",
        money("annual_premium").alias("premium_amount"),
        "commission_rate",
        cents(money("annual_premium") * F.col("commission_rate")).alias("commission_amount"),
    )


def with_overrides(
    transactions: DataFrame,
    agents: DataFrame,
    traffic: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """All transactions and the overrides that follow from them, in one pass over the transactions.

    Each row meets its seller's upline once and writes itself and, if there is an upline and the
    row is new business or a renewal, the override beside it: nothing is computed or read twice.
    """
    uplines = agents.where(F.col("upline_agent_id").isNotNull()).select("agent_id", "upline_agent_id")
    sold = skew_join(transactions, uplines, ["agent_id"], traffic=traffic, limit=limit)
    override = _override_of_row()
    sale = {**{c: F.col(c) for c in TRANSACTION_COLUMNS}, "transaction_id": F.col("transaction_id").cast("string")}
    pays = F.col("upline_agent_id").isNotNull() & F.col("transaction_type").isin(NEW_BUSINESS, RENEWAL)
    own, above = (F.struct(*[row[c].alias(c) for c in TRANSACTION_COLUMNS]) for row in (sale, override))
    rows = F.when(pays, F.array(own, above)).otherwise(F.array(own))
    return sold.select(F.inline(rows))


def _override_of_row() -> dict[str, Column]:
    """The columns of the override that a sold row brings its upline."""
    kept = {c: F.col(c) for c in ("policy_id", "product_id", "transaction_date", "premium_amount")}
    return {
        **kept,
        "transaction_id": F.concat(F.lit("OV-"), F.col("transaction_id").cast("string")),
        "agent_id": F.col("upline_agent_id"),
        "transaction_type": F.lit(OVERRIDE),
        "commission_rate": rate(F.lit(OVERRIDE_RATE)),
        "commission_amount": cents(F.col("commission_amount") * F.lit(OVERRIDE_RATE)),
    }


def calc_overrides(
    transactions: DataFrame,
    agents: DataFrame,
    traffic: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The seller's direct upline earns a share of each new-business and renewal amount."""
    uplines = agents.where(F.col("upline_agent_id").isNotNull()).select("agent_id", "upline_agent_id")
    base = transactions.where(F.col("transaction_type").isin(NEW_BUSINESS, RENEWAL))
    sold = skew_join(base, uplines, ["agent_id"], "inner", traffic=traffic, limit=limit)
    override = _override_of_row()
    return sold.select(*[override[c].alias(c) for c in TRANSACTION_COLUMNS])


def calc_payment_run(transactions: DataFrame, chargebacks: DataFrame) -> DataFrame:
    """What each agent is due per period: gross, deductions, net, status and date.

    Both sources are appended and summed together, which equals a full outer join of
    their sums and needs one shuffle of partial sums. Rows without agent or period are
    not payable.
    """
    none = F.lit(0).cast("bigint")
    earned = transactions.select(
        "agent_id", "pay_period", in_cents("commission_amount").alias("_gross"), none.alias("_back")
    )
    clawed = chargebacks.select(
        "agent_id", "pay_period", none.alias("_gross"), in_cents("chargeback_amount").alias("_back")
    )
    payable = earned.unionByName(clawed).where("agent_id IS NOT NULL AND pay_period IS NOT NULL")
    sums = payable.groupBy("agent_id", "pay_period").agg(
        F.coalesce(F.sum("_gross"), none).alias("_gross"),
        F.coalesce(F.sum("_back"), none).alias("_back"),
    )
    status = F.when(F.col("net_payment_amount") < F.lit(PAYMENT_HOLD_THRESHOLD), "Held")
    return sums.select(
        "agent_id",
        "pay_period",
        payment_date("pay_period").alias("payment_date"),
        from_cents("_gross").alias("gross_commission"),
        from_cents("_back").alias("chargeback_deductions"),
        from_cents(F.col("_gross") + F.col("_back")).alias("net_payment_amount"),
    ).withColumn("payment_status", status.otherwise("Paid"))


def eligible_agents(agents: DataFrame) -> DataFrame:
    """Agents who may sell: not terminated, one row each."""
    return dedup_latest(
        agents.where(~F.col("agent_status").eqNullSafe("Terminated")), ["agent_id"]
    )


def with_sale_window(agents: DataFrame, first: Column, last: Column) -> DataFrame:
    """Limit the sale range to the agent's tenure; an empty range falls back to the whole."""
    opens = F.greatest(first, F.col("hire_date"))
    closes = F.least(last, F.col("termination_date"))
    usable = opens < closes
    return agents.withColumns(
        {
            "sale_window_start": F.when(usable, opens).otherwise(first),
            "sale_window_end": F.when(usable, closes).otherwise(last),
        }
    )
