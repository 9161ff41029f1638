"""The registered queries: each takes (spark, sf_dir) and reads the driver's tables whole."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytrail.config import Lake, TRANSACTION_TYPES
from paytrail.functions import pay_period, published, stated_period
from paytrail.operators import cleaning, commission, history, numbering, quality
from paytrail.operators.joins import as_of_join
from paytrail.plans import integrity, marts, pipeline, silver
from paytrail.plans import workload as w
from paytrail.schemas import MONTHLY_EXTRACTS, REFERENCE_EXTRACTS
from paytrail.session import materialized, scratch_path
from paytrail.sources import extracts, tables
from paytrail.streaming.ingest import ingest_new_files

QUERIES = {}


def query(build):
    """Register a query under its function name, its columns typed as published."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return published(build(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


_TRANSACTION = [
    "transaction_id",
    "policy_id",
    "agent_id",
    "transaction_type",
    "transaction_date",
    "pay_period",
    "premium_amount",
    "commission_rate",
    "commission_amount",
]


# --- cleaning -------------------------------------------------------------------------


@query
def latest_snapshot(spark, sf_dir):
    """Events of the newest day."""
    events = w.table(spark, sf_dir, "events").withColumn("load_date", F.col("ts").cast("date"))
    newest = cleaning.latest_snapshot(events, "load_date")
    return newest.select("event_id", "user_id", "event_type", "value", "load_date")


@query
def clean_transactions(spark, sf_dir):
    raw = w.transactions(spark, sf_dir)
    return silver.fact_commission_transactions(raw)[0].select(*_TRANSACTION)


@query
def quarantined_transactions(spark, sf_dir):
    raw = w.transactions(spark, sf_dir)
    return silver.fact_commission_transactions(raw)[1].select(*_TRANSACTION)


def _policy_split(spark, sf_dir):
    raw = w.raw_policies(spark, sf_dir)
    newest = cleaning.dedup_latest(raw, ["policy_id"], [F.col("load_seq").desc()])
    return cleaning.split_quarantine(newest, F.col("annual_premium").isNotNull())


@query
def clean_policies(spark, sf_dir):
    return _policy_split(spark, sf_dir)[0]


@query
def quarantined_policies(spark, sf_dir):
    return _policy_split(spark, sf_dir)[1]


@query
def dedup_latest(spark, sf_dir):
    """One line per order and line number: the last shipped, ties by all columns."""
    lines = w.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
    )
    keys = ["l_orderkey", "l_linenumber"]
    return cleaning.dedup_latest(lines, keys, [F.col("l_shipdate").desc_nulls_last()])


@query
def pay_periods(spark, sf_dir):
    """The period from a date, a timestamp, date text and period text is the same."""
    ships = w.table(spark, sf_dir, "lineitem").select("l_shipdate")
    text = F.date_format("l_shipdate", "yyyy-MM-dd")
    return ships.groupBy(
        pay_period("l_shipdate").alias("from_timestamp"),
        pay_period(F.col("l_shipdate").cast("date")).alias("from_date"),
        pay_period(text).alias("from_text"),
        pay_period(F.substring(text, 1, 7)).alias("from_period"),
    ).agg(F.count(F.lit(1)).alias("lines"))


@query
def stated_periods(spark, sf_dir):
    """Periods as payments state them: months and dates count, other texts are no period."""
    ships = w.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    month, kind = F.date_format("l_shipdate", "yyyy-MM"), F.pmod("l_orderkey", F.lit(6))
    text = (
        F.when(kind == 0, F.date_format("l_shipdate", "yyyyMM"))
        .when(kind == 1, F.concat(F.substring(month, 1, 4), F.lit("-13")))
        .when(kind == 2, F.concat(F.substring(month, 1, 4), F.lit("-Q1")))
        .when(kind == 3, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .when(kind == 4, month)
    )
    return ships.groupBy(stated_period(text).alias("period"), kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("lines")
    )


# --- dimensions and facts -------------------------------------------------------------


@query
def dim_agency(spark, sf_dir):
    return silver.dim_agency(w.agencies(spark, sf_dir))


@query
def dim_agent_scd2(spark, sf_dir):
    states = w.agents(spark, sf_dir).withColumn("license_state", F.lit(" tx "))
    return silver.dim_agent(states, w.tier_history(spark, sf_dir))


@query
def current_dimension(spark, sf_dir):
    return history.current_dimension(w.tier_history(spark, sf_dir))


@query
def dim_product(spark, sf_dir):
    return silver.dim_product(w.products(spark, sf_dir))


@query
def dim_commission_plan(spark, sf_dir):
    return silver.dim_commission_plan(w.plans(spark, sf_dir))


@query
def fact_chargebacks(spark, sf_dir):
    return silver.fact_chargebacks(w.chargebacks(spark, sf_dir))


@query
def fact_payments(spark, sf_dir):
    return silver.fact_payments(w.payments(spark, sf_dir))


# --- history --------------------------------------------------------------------------


@query
def build_history(spark, sf_dir):
    return w.tier_history(spark, sf_dir)


def _tier_as_of(spark, sf_dir, limit=None):
    rows = w.transactions(spark, sf_dir).select("transaction_id", "agent_id", "transaction_date")
    tiers = w.tier_history(spark, sf_dir)
    return commission.tier_as_of(rows, tiers, "transaction_date", "tier", limit=limit)


@query
def tier_as_of(spark, sf_dir):
    return _tier_as_of(spark, sf_dir)


@query
def tier_as_of_unbroadcast(spark, sf_dir):
    """The same lookup on the path for a history beyond the broadcast limit."""
    return _tier_as_of(spark, sf_dir, limit=-1)


@query
def tier_as_of_boundary(spark, sf_dir):
    """Transactions on a day that ends one period and starts the next."""
    ends = (
        w.tier_history(spark, sf_dir)
        .where("effective_end_date IS NOT NULL")
        .select("agent_id", F.col("effective_end_date").alias("transaction_date"))
        .distinct()
    )
    return _tier_as_of(spark, sf_dir).join(ends, ["agent_id", "transaction_date"], "left_semi")


@query
def as_of_inner(spark, sf_dir):
    """Only transactions for which a period is in force."""
    rows = w.transactions(spark, sf_dir).select("transaction_id", "agent_id", "transaction_date")
    tiers = w.tier_history(spark, sf_dir).drop("is_current")
    return as_of_join(rows, tiers, ["agent_id"], "transaction_date", how="inner")


@query
def upsert(spark, sf_dir):
    """Orders with re-delivered and new ones merged in by key."""
    orders = w.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    )
    key = F.col("o_orderkey")
    changed = orders.where(key % 10 == 0).withColumn("o_orderstatus", F.lit("X"))
    added = orders.where(key % 100 == 1).withColumn("o_orderkey", key + 1_000_000_000)
    return history.upsert(orders, changed.unionByName(added), ["o_orderkey"])


_TRACKED = ["c_mktsegment", "c_acctbal"]


@query
def scd2_changed_keys(spark, sf_dir):
    target, updates = w.customer_dimension(spark, sf_dir), w.customer_updates(spark, sf_dir)
    return history.scd2_changed_keys(target, updates, "c_custkey", _TRACKED)


@query
def scd2_new_keys(spark, sf_dir):
    target, updates = w.customer_dimension(spark, sf_dir), w.customer_updates(spark, sf_dir)
    return history.scd2_new_keys(target, updates, "c_custkey").select("c_custkey", "c_mktsegment")


@query
def scd2_seed(spark, sf_dir):
    return history.scd2_merge(None, w.customer_updates(spark, sf_dir), "c_custkey", _TRACKED)


@query
def scd2_merge(spark, sf_dir):
    target, updates = w.customer_dimension(spark, sf_dir), w.customer_updates(spark, sf_dir)
    closed_on = F.to_date(F.lit("1998-12-31"))
    return history.scd2_merge(target, updates, "c_custkey", _TRACKED, close_date=closed_on)


@query
def scd2_merge_unbroadcast(spark, sf_dir):
    """The merge closing rows the day before the new start."""
    target, updates = w.customer_dimension(spark, sf_dir), w.customer_updates(spark, sf_dir)
    return history.scd2_merge(
        target, updates, "c_custkey", _TRACKED, close_before="effective_start_date"
    )


# --- commission calculation -----------------------------------------------------------


def _priced(spark, sf_dir):
    return commission.price_policies(
        _policy_split(spark, sf_dir)[0],
        w.tier_history(spark, sf_dir),
        w.plans(spark, sf_dir),
        w.products(spark, sf_dir),
    )


def _renewals(spark, sf_dir, priced):
    return commission.calc_renewals(
        priced,
        w.raw_policies(spark, sf_dir),
        w.tier_history(spark, sf_dir),
        w.plans(spark, sf_dir),
        F.to_date(F.lit(w.LAST_RENEWAL)),
    )


@query
def rate_lookup(spark, sf_dir):
    return _priced(spark, sf_dir).select(
        "policy_id", "product_id", "tier_at_issue", "base_commission_rate", "new_business_rate"
    )


@query
def new_business_commission(spark, sf_dir):
    return commission.calc_new_business(_priced(spark, sf_dir))


@query
def renewal_schedule(spark, sf_dir):
    due = commission.renewal_dates(
        _policy_split(spark, sf_dir)[0], F.to_date(F.lit(w.LAST_RENEWAL))
    )
    return due.select("policy_id", "renewal_number", "renewal_date")


@query
def renewal_commission(spark, sf_dir):
    return _renewals(spark, sf_dir, _priced(spark, sf_dir))


def _sales(spark, sf_dir, limit=None):
    """New business and renewals of the clean policies, and their events for the frequency of keys."""
    policies, end = _policy_split(spark, sf_dir)[0], F.to_date(F.lit(w.LAST_RENEWAL))
    lookups = w.tier_history(spark, sf_dir), w.plans(spark, sf_dir), w.products(spark, sf_dir)
    return commission.calc_sales(policies, *lookups, end, limit), commission.sale_events(policies, end)


@query
def override_commission(spark, sf_dir):
    sold, events = _sales(spark, sf_dir)
    return commission.calc_overrides(sold, w.agents(spark, sf_dir), traffic=events)


@query
def all_commission(spark, sf_dir):
    """New business, renewals and overrides, each policy priced once and each upline met once."""
    sold, events = _sales(spark, sf_dir)
    return commission.with_overrides(sold, w.agents(spark, sf_dir), traffic=events)


@query
def sales_unbroadcast(spark, sf_dir):
    """New business and renewals on the path for large tier and rate tables."""
    return _sales(spark, sf_dir, limit=-1)[0]


@query
def override_unbroadcast(spark, sf_dir):
    """Overrides on line-item transactions, on the path for a large agent table."""
    sold = w.transactions(spark, sf_dir, product=True)
    return commission.calc_overrides(sold, w.agents(spark, sf_dir), limit=-1).select(
        "transaction_id", "agent_id", "product_id", "commission_amount"
    )


@query
def chargeback_from_cancellation(spark, sf_dir):
    return commission.calc_chargebacks(_priced(spark, sf_dir)).drop("chargeback_reason")


@query
def payment_run(spark, sf_dir):
    return w.due(spark, sf_dir)


@query
def eligible_agents(spark, sf_dir):
    return commission.eligible_agents(w.agents(spark, sf_dir)).select("agent_id", "agent_status")


@query
def sale_window(spark, sf_dir):
    first, last = (F.to_date(F.lit(d)) for d in w.SALE_RANGE)
    return commission.with_sale_window(w.agents(spark, sf_dir), first, last).select(
        "agent_id", "sale_window_start", "sale_window_end"
    )


@query
def sequence_ids(spark, sf_dir):
    """Sequential ids for orders by date and key, and a composed policy number."""
    orders = w.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    numbered = numbering.with_sequence_id(orders, order, "policy_id", "POL", 7)
    number = F.concat_ws("-", F.lit("AUTO"), F.right("policy_id", F.lit(7)))
    return numbered.withColumn("policy_number", number)


# --- data quality ---------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    raw = w.raw_policies(spark, sf_dir).select("policy_id", "load_seq", "annual_premium")
    return quality.failing_rows(raw, quality.not_null("annual_premium"))


@query
def dq_unique(spark, sf_dir):
    rows = w.transactions(spark, sf_dir).select("transaction_id", "agent_id", "commission_amount")
    return quality.failing_rows(rows, quality.unique("transaction_id"))


@query
def dq_positive(spark, sf_dir):
    rows = w.transactions(spark, sf_dir).select("transaction_id", "agent_id", "commission_amount")
    return quality.failing_rows(rows, quality.positive("commission_amount"))


@query
def dq_in_set(spark, sf_dir):
    rows = w.transactions(spark, sf_dir).select("transaction_id", "transaction_type")
    return quality.failing_rows(rows, quality.in_set("transaction_type", TRANSACTION_TYPES[:2]))


@query
def dq_custom(spark, sf_dir):
    """Agents with more than one closed tier period."""
    closed = quality.at_most_one("agent_id", ~F.col("is_current"))
    return quality.failing_rows(w.tier_history(spark, sf_dir), closed)


@query
def ref_integrity(spark, sf_dir):
    """Transactions whose policy is not among the policies that have a premium."""
    parents = _policy_split(spark, sf_dir)[0]
    rows = w.transactions(spark, sf_dir).select("transaction_id", "policy_id", "agent_id")
    rule = quality.missing_parent(parents, {"policy_id": "policy_id"})
    return quality.failing_rows(rows, rule)


@query
def commission_integrity(spark, sf_dir):
    """The cross-table rules; line items and orders are unrelated, so some of them fail."""
    policies = cleaning.dedup_latest(
        w.raw_policies(spark, sf_dir).select("policy_id", "issue_date", "load_seq"),
        ["policy_id"],
        [F.col("load_seq").desc()],
    )
    return integrity.commission_integrity(
        w.transactions(spark, sf_dir),
        w.chargebacks(spark, sf_dir),
        policies,
        w.agents(spark, sf_dir),
    ).drop("description")


def _silver_frames(spark, sf_dir):
    return {
        "dim_agency": w.agencies(spark, sf_dir),
        "dim_agent": w.dim_agent(spark, sf_dir),
        "dim_product": w.products(spark, sf_dir),
        "dim_commission_plan": w.plans(spark, sf_dir),
        "dim_policy": _policy_split(spark, sf_dir)[0],
        "fact_commission_transactions": w.clean_transactions(spark, sf_dir),
        "fact_chargebacks": w.chargebacks(spark, sf_dir),
        "fact_payments": w.payments(spark, sf_dir),
    }


@query
def dq_report(spark, sf_dir):
    """All configured checks on all tables."""
    frames = _silver_frames(spark, sf_dir)
    reports = [
        quality.check_report(frames[t.name], t.checks, t.name) for t in silver.silver_tables()
    ]
    return reduce(DataFrame.unionByName, reports).drop("description")


@query
def dq_gate(spark, sf_dir):
    """Failing error checks of the newest run, after an earlier run on unclean transactions."""
    fact = next(t for t in silver.silver_tables() if t.name == "fact_commission_transactions")
    runs = {
        "2002-01-01T00:00:00": w.transactions(spark, sf_dir),
        "2002-01-02T00:00:00": w.clean_transactions(spark, sf_dir),
    }
    log = reduce(
        DataFrame.unionByName,
        [
            quality.check_report(df, fact.checks, fact.name).withColumn("run_timestamp", F.lit(at))
            for at, df in runs.items()
        ],
    )
    return quality.quality_gate(log, whole_history=False).drop("description")


@query
def dq_log_gate(spark, sf_dir):
    """Failing error checks of all runs in an appended log; each run counts its rows while it stores them."""
    fact = next(t for t in silver.silver_tables() if t.name == "fact_commission_transactions")
    log = scratch_path(spark, "quality-log")
    for rows in (w.transactions(spark, sf_dir), w.clean_transactions(spark, sf_dir)):
        counted, watch = quality.observed(rows, fact.checks)
        stored = materialized(counted, "checked")
        quality.run_checks(spark, stored, fact.checks, fact.name, log, fail_on_error=False, watch=watch)
    return quality.quality_gate(tables.read_table(spark, log)).drop("description", "run_timestamp")


# --- marts ----------------------------------------------------------------------------


def _summary(spark, sf_dir):
    return marts.agent_commission_summary(
        w.clean_transactions(spark, sf_dir), w.chargebacks(spark, sf_dir), w.dim_agent(spark, sf_dir)
    )


@query
def agent_commission_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query
def payment_run_summary(spark, sf_dir):
    return marts.payment_run_summary(
        w.payments(spark, sf_dir), w.dim_agent(spark, sf_dir), w.agencies(spark, sf_dir)
    )


@query
def chargeback_exposure(spark, sf_dir):
    return marts.chargeback_exposure(
        w.clean_transactions(spark, sf_dir), w.chargebacks(spark, sf_dir), w.dim_agent(spark, sf_dir)
    )


@query
def stored_payment_run(spark, sf_dir):
    """The payment run in folders by period, each row with its place in the order and whether the files keep it."""
    path = scratch_path(spark, "stored-payment-run")
    order = [F.col("pay_period").asc(), F.col("agency_id").asc()]
    tables.write_numbered(payment_run_summary(spark, sf_dir), path, order, partition_by=["pay_period"])
    stored = tables.read_stored_order(spark, path, partition_by=["pay_period"])
    return stored.select("place", "pay_period", "agency_id", "total_net_paid", "in_order")


@query
def stored_exposure(spark, sf_dir):
    """Agents by their share of clawed-back business, largest first, as they lie in the files."""
    path = scratch_path(spark, "stored-exposure")
    order = [F.col("chargeback_rate").desc(), F.col("agent_id").asc()]
    tables.write_numbered(chargeback_exposure(spark, sf_dir), path, order)
    return tables.read_stored_order(spark, path).select("place", "agent_id", "chargeback_rate", "in_order")


@query
def agent_leaderboard(spark, sf_dir):
    """Ranked from a stored summary, as in the pipeline."""
    return marts.agent_leaderboard(materialized(_summary(spark, sf_dir)))


@query
def agent_leaderboard_distributed(spark, sf_dir):
    """The leaderboard over a stored summary."""
    return marts.agent_leaderboard(materialized(_summary(spark, sf_dir)))


def _reconciled(spark, sf_dir, **options):
    """The report over a stored summary and stored payments, as in the pipeline."""
    summary, paid = materialized(_summary(spark, sf_dir)), materialized(w.payments(spark, sf_dir))
    return marts.reconciliation_report(summary, paid, **options)


@query
def reconciliation_report(spark, sf_dir):
    return _reconciled(spark, sf_dir)


@query
def reconciliation_unbroadcast(spark, sf_dir):
    """The report with frequent agents and periods cut into slices from a fiftieth of the payments on."""
    return _reconciled(spark, sf_dir, hot_limit=50)


@query
def reconciliation_headline(spark, sf_dir):
    return marts.reconciliation_headline(_reconciled(spark, sf_dir, ordered=False))


# --- extracts -------------------------------------------------------------------------


def _extract_rows(spark, sf_dir):
    """All transactions in the columns of the transaction extract."""
    columns = [c.split()[0] for c in MONTHLY_EXTRACTS["commission_transactions"].split(", ")]
    rows = w.transactions(spark, sf_dir).withColumn("product_id", F.lit("0042"))
    return rows.select(*columns)


def _per_month(landed):
    return landed.groupBy(
        pay_period("transaction_date").alias("month"), "transaction_type", "product_id"
    ).agg(
        F.count("transaction_id").alias("transactions"),
        F.sum("commission_amount").cast("decimal(18,2)").alias("commission"),
    )


@query
def extract_roundtrip(spark, sf_dir):
    """Export by month as CSV and read back under the declared schema."""
    raw = scratch_path(spark, "extracts")
    name = "commission_transactions"
    extracts.write_monthly_extract(_extract_rows(spark, sf_dir), raw, name, "transaction_date")
    return _per_month(extracts.monthly_extract(spark, raw, name))


def _evolving_payments(spark, sf_dir):
    """Payments of three eras, each exported under a header of its own: fewer, other and more columns."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    full = w.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("payment_id"),
        F.col("o_custkey").cast("string").alias("agent_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("pay_period"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
        amount.alias("gross_commission"),
        F.lit("0.00").cast("decimal(18,2)").alias("chargeback_deductions"),
        amount.alias("net_payment_amount"),
        F.col("o_orderstatus").alias("payment_status"),
        F.lit("ACH").alias("payment_method"),
    )
    year = F.year("payment_date")
    return [
        full.where(year < 1995).drop("payment_method", "chargeback_deductions"),
        full.where((year >= 1995) & (year < 1997)).select(*reversed(full.columns)),
        full.where(year >= 1997).select(F.lit("new").alias("note"), *full.columns),
    ]


@query
def extract_evolved(spark, sf_dir):
    """Payments from months whose files differ in their headers."""
    raw = scratch_path(spark, "evolved")
    for era in _evolving_payments(spark, sf_dir):
        extracts.write_monthly_extract(era, raw, "payments", "payment_date")
    return extracts.monthly_extract(spark, raw, "payments").drop(*extracts.LINEAGE)


@query
def incremental_evolved(spark, sf_dir):
    """The same payments, landed era by era by the incremental reader."""
    raw, bronze, progress = (scratch_path(spark, label) for label in ("eras", "bronze", "progress"))
    for era in _evolving_payments(spark, sf_dir):
        extracts.write_monthly_extract(era, raw, "payments", "payment_date")
        ingest_new_files(spark, raw, "payments", bronze, progress)
    return silver.without_lineage(tables.read_table(spark, f"{bronze}/payments"))


@query
def extract_reordered(spark, sf_dir):
    """Payments from files whose columns stand in another order, with one more than declared."""
    raw = scratch_path(spark, "reordered")
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    rows = w.table(spark, sf_dir, "orders").select(
        F.lit("extra").alias("note"),
        F.lit("ACH").alias("payment_method"),
        F.col("o_orderstatus").alias("payment_status"),
        amount.alias("net_payment_amount"),
        F.date_format("o_orderdate", "yyyy-MM").alias("pay_period"),
        F.col("o_orderdate").cast("date").alias("payment_date"),
        F.lit("0.00").cast("decimal(18,2)").alias("chargeback_deductions"),
        amount.alias("gross_commission"),
        F.col("o_custkey").cast("string").alias("agent_id"),
        F.col("o_orderkey").cast("string").alias("payment_id"),
    )
    extracts.write_monthly_extract(rows, raw, "payments", "payment_date")
    return extracts.monthly_extract(spark, raw, "payments").drop(*extracts.LINEAGE)


@query
def snapshot_roundtrip(spark, sf_dir):
    """Export two full snapshots; ingesting takes the newer one only."""
    raw = scratch_path(spark, "snapshots")
    agencies = w.table(spark, sf_dir, "customer").select(
        F.format_string("AGY%08d", "c_custkey").alias("agency_id"),
        F.col("c_name").alias("agency_name"),
        F.lit("Captive").alias("agency_type"),
        F.col("c_mktsegment").alias("region"),
    )
    extracts.write_snapshot_extract(agencies, raw, "agencies", "2001-01-01")
    newer = agencies.withColumn("agency_type", F.lit("Franchise"))
    extracts.write_snapshot_extract(newer, raw, "agencies", "2001-02-01")
    return extracts.snapshot_extract(spark, raw, "agencies").drop(*extracts.LINEAGE)


@query
def incremental_ingest(spark, sf_dir):
    """Two deliveries landed by two runs of the incremental reader."""
    raw, bronze = scratch_path(spark, "deliveries"), scratch_path(spark, "bronze")
    progress, name = scratch_path(spark, "progress"), "commission_transactions"
    rows = _extract_rows(spark, sf_dir)
    cut = F.col("transaction_date") < F.to_date(F.lit("1999-01-01"))
    for delivery in (rows.where(cut), rows.where(~cut)):
        extracts.write_monthly_extract(delivery, raw, name, "transaction_date")
        ingest_new_files(spark, raw, name, bronze, progress)
    return _per_month(tables.read_table(spark, f"{bronze}/{name}"))


@query
def ingest_lineage(spark, sf_dir):
    """Rows per source folder, from the lineage columns (paths differ per run)."""
    raw = scratch_path(spark, "extracts")
    name = "commission_transactions"
    extracts.write_monthly_extract(_extract_rows(spark, sf_dir), raw, name, "transaction_date")
    landed = extracts.monthly_extract(spark, raw, name).where("_ingested_at IS NOT NULL")
    folder = F.regexp_extract("_source_file", r"ingest_month=([\d-]+)", 1)
    return landed.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("lines"))


@query
def merged_table(spark, sf_dir):
    """Two stored batches of keyed upserts, the second rewriting the buckets of its keys."""
    path = scratch_path(spark, "merged")
    orders = w.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = orders.where(F.col("o_orderkey") % 7 == 0).withColumn("o_orderstatus", F.lit("X"))
    added = orders.where(F.col("o_orderkey") % 50 == 1).withColumn(
        "o_orderkey", F.col("o_orderkey") + 1_000_000_000
    )
    for batch in (orders, changed.unionByName(added)):
        tables.upsert_table(spark, batch, path, ["o_orderkey"])
    return tables.read_merged(spark, path)


@query
def scd2_merged_table(spark, sf_dir):
    """A stored Type-2 dimension after a full load, a batch for a few keys and a repeat of that batch."""
    path = scratch_path(spark, "dimension")
    customers = w.customer_dimension(spark, sf_dir).where("is_current")
    first = customers.drop("effective_end_date", "is_current")
    closed_on = F.to_date(F.lit("1998-12-31"))
    for batch in (first, w.customer_updates(spark, sf_dir), w.customer_updates(spark, sf_dir)):
        tables.scd2_merge_table(spark, batch, path, "c_custkey", _TRACKED, buckets=16, close_date=closed_on)
    return tables.read_merged(spark, path)


@query
def published_table(spark, sf_dir):
    """Orders by status folders, published twice under one name; readers see the second state."""
    name, folder = f"published_{uuid.uuid4().hex}", scratch_path(spark, "published")
    orders = w.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.publish_table(orders.where("o_orderkey % 2 = 0"), name, folder, ["o_orderstatus"])
    tables.publish_table(orders, name, folder, ["o_orderstatus"])
    return spark.table(name)


# --- all stages -----------------------------------------------------------------------


_GOLD = ["agent_commission_summary", "payment_run_summary", "chargeback_exposure", "agent_leaderboard", "reconciliation_report"]


def _as_extract(df, name):
    """A frame in the declared columns of an extract; what it lacks is NULL."""
    fields = [c.split() for c in {**REFERENCE_EXTRACTS, **MONTHLY_EXTRACTS}[name].split(", ")]
    return df.select(
        *[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields]
    )


def _told_apart(df, key):
    """Rows that share an id get ids of their own: a few line items share order and line number."""
    copies = Window.partitionBy(key).orderBy(*[c for c in df.columns if c != key])
    return df.withColumn(key, F.concat_ws("-", F.col(key).cast("string"), F.row_number().over(copies)))


def _staged(spark, sf_dir):
    """Export all tables as extracts, land them and run silver and gold; the lake and the rows landed per table."""
    lake = Lake(scratch_path(spark, "lake"))
    sources = {
        "agencies": w.agencies(spark, sf_dir),
        "agents": w.agents(spark, sf_dir),
        "agent_tier_history": w.tier_history(spark, sf_dir),
        "products": w.products(spark, sf_dir),
        "commission_plans": w.plans(spark, sf_dir),
        "policies": w.raw_policies(spark, sf_dir),
        "commission_transactions": _told_apart(_extract_rows(spark, sf_dir), "transaction_id"),
        "chargebacks": _told_apart(w.chargebacks(spark, sf_dir), "chargeback_id"),
        "payments": w.payments(spark, sf_dir),
    }
    exported = {name: _as_extract(df, name) for name, df in sources.items()}
    extracts.export_extracts(exported, lake.layer("raw"), "2001-12-31")
    landed = extracts.ingest_all(spark, lake.layer("raw"), lake.layer("bronze"))
    pipeline.run_silver(spark, lake.layer("bronze"), lake.layer("silver"))
    pipeline.run_gold(spark, lake.layer("silver"), lake.layer("gold"))
    return lake, landed


@query
def staged_rows(spark, sf_dir):
    """Rows of every table of every layer after all stages; for bronze also as counted while landing."""
    lake, landed = _staged(spark, sf_dir)
    built = silver.silver_tables()
    found = {
        "bronze": list(landed),
        "silver": [t.name for t in built],
        "quarantine": [t.name for t in built if t.valid is not None],
        "gold": _GOLD,
    }

    def rows(layer, name):
        path = f"{lake.layer('silver')}/_quarantine/{name}" if layer == "quarantine" else lake.table(layer, name)
        counted = F.lit(landed[name] if layer == "bronze" else None).cast("bigint")
        return tables.read_table(spark, path).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows", counted.alias("landed")
        )

    return reduce(DataFrame.unionByName, [rows(layer, name) for layer, names in found.items() for name in names])


@query
def staged_reconciliation(spark, sf_dir):
    """The reconciliation report as gold holds it after all stages."""
    lake, _ = _staged(spark, sf_dir)
    return tables.read_table(spark, lake.table("gold", "reconciliation_report"))
