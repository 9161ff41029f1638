"""The compensation tables, derived from the driver's star-schema tables.

Every function reads whole tables and declares only what it needs, so scans stay narrow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail.config import TIER_MULTIPLIER
from paytrail.functions import cents, parse_date, pay_period
from paytrail.operators.commission import build_commission_plans, calc_payment_run, plan_starts
from paytrail.operators.history import build_history, with_version_key
from paytrail.operators.joins import skew_join

SALE_RANGE = ("2000-06-01", "2001-08-01")
LAST_RENEWAL = "2001-12-31"
PLAN_START, PLAN_YEARS = "1995-01-01", 6
# Base commission rate of each product of the workload.
PRODUCT_RATES = {
    "ECONOMY": "0.10",
    "LARGE": "0.12",
    "MEDIUM": "0.15",
    "PROMO": "0.20",
    "SMALL": "0.55",
    "STANDARD": "0.70",
}


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read once an application, later scans declare the schema."""
    path = f"{sf_dir}/{name}.parquet"
    known = spark.sparkContext.applicationId, path
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[known]).parquet(path)


def _date(text: str) -> Column:
    return F.to_date(F.lit(text))


def transactions(spark: SparkSession, sf_dir: str, product: bool = False) -> DataFrame:
    """Commission transactions from the line items, bad amounts included."""
    lines = table(spark, sf_dir, "lineitem")
    if product:
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product_id")
        )
        lines = skew_join(lines, parts, ["l_partkey"])
    kind = (
        F.when(F.col("l_returnflag") == "A", "New Business")
        .when(F.col("l_returnflag") == "N", "Renewal")
        .when(F.col("l_returnflag") == "R", "Override")
    )
    premium = F.col("l_extendedprice").cast("decimal(12,2)")
    share = F.col("l_discount").cast("decimal(4,2)")
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_orderkey").alias("policy_id"),
        F.col("l_suppkey").alias("agent_id"),
        *(["product_id"] if product else []),
        kind.alias("transaction_type"),
        parse_date("l_shipdate").alias("transaction_date"),
        pay_period("l_shipdate").alias("pay_period"),
        premium.alias("premium_amount"),
        share.alias("commission_rate"),
        cents(premium * share).alias("commission_amount"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).where("commission_amount > 0")


def chargebacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claw-backs of new business that ended within the 90-day window."""
    days = F.col("quantity") * 4
    ended = transactions(spark, sf_dir).where(
        (F.col("transaction_type") == "New Business")
        & (F.col("commission_amount") > 0)
        & (F.col("line_status") == "F")
        & (days <= 90)
    )
    on = F.date_add("transaction_date", days)
    return ended.select(
        F.col("transaction_id").alias("chargeback_id"),
        F.col("transaction_id").alias("original_transaction_id"),
        "policy_id",
        "agent_id",
        on.alias("chargeback_date"),
        pay_period(on).alias("pay_period"),
        (-F.abs("commission_amount")).cast("decimal(18,2)").alias("chargeback_amount"),
    )


def due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the payment run owes, sign errors included."""
    return calc_payment_run(transactions(spark, sf_dir), chargebacks(spark, sf_dir))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What finance recorded: mostly the due amount, some off, some not paid."""
    month, year = F.substring("pay_period", 6, 2).cast("int"), F.substring("pay_period", 1, 4).cast("int")
    noise = (F.col("agent_id") * 31 + month * 7 + year) % 50
    extra = F.when(noise == 0, F.lit("75.25")).when(noise == 1, F.lit("0.75")).otherwise(F.lit("0.00"))
    return due(spark, sf_dir).where(noise != 2).withColumns(
        {
            "payment_id": F.concat_ws("-", F.lit("PAY"), F.col("agent_id").cast("string"), "pay_period"),
            "net_payment_amount": cents(F.col("net_payment_amount") + extra.cast("decimal(18,2)")),
        }
    )


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as agents; the lowest agent of a nation is the upline of the others."""
    suppliers = table(spark, sf_dir, "supplier")
    heads = suppliers.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("_head"))
    ended = F.col("s_suppkey") % 12 == 11
    return skew_join(suppliers, heads, ["s_nationkey"]).select(
        F.col("s_suppkey").alias("agent_id"),
        F.col("s_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.col("s_nationkey").cast("bigint").alias("agency_id"),
        F.date_add(_date("1998-01-01"), ((F.col("s_suppkey") * 37) % 1200).cast("int")).alias("hire_date"),
        F.when(ended, _date("2000-01-01")).alias("termination_date"),
        F.when(ended, "Terminated")
        .when(F.col("s_acctbal") < 0, "Suspended")
        .otherwise("Active")
        .alias("agent_status"),
        F.when(F.col("_head") != F.col("s_suppkey"), F.col("_head")).alias("upline_agent_id"),
    )


def agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf_dir, "nation").join(regions, "n_regionkey").select(
        F.col("n_nationkey").cast("bigint").alias("agency_id"),
        F.col("n_name").alias("agency_name"),
        F.col("r_name").alias("region"),
    )


def tier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three dated tier changes per agent; one agent in 25 has none."""
    key = F.col("s_suppkey")
    step = F.col("_step")
    first = F.when(key % 10 == 9, _date("1996-01-01")).otherwise(_date("1995-01-01"))
    second = F.date_add(_date("1997-01-01"), (key % 365).cast("int"))
    third = F.date_add(_date("1999-07-01"), (key % 181).cast("int"))
    names = F.array(*[F.lit(t) for t in TIER_MULTIPLIER])
    return (
        table(spark, sf_dir, "supplier")
        .where(key % 25 != 24)
        .select(key, F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))).alias("_step"))
        .select(
            key.alias("agent_id"),
            F.element_at(names, (((key + step) % 4) + 1).cast("int")).alias("tier"),
            F.when(step == 0, first).when(step == 1, second).otherwise(third).alias("change_date"),
        )
    )


def tier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_history(tier_changes(spark, sf_dir), "agent_id", "change_date", ["tier"])


def dim_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = with_version_key(tier_history(spark, sf_dir), "agent_id", "agent_sk")
    return skew_join(versions, agents(spark, sf_dir), ["agent_id"], "inner")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct part types with their base rate."""
    rate = reduce(
        lambda found, item: found.when(F.col("p_type") == item[0], F.lit(item[1])),
        list(PRODUCT_RATES.items())[1:],
        F.when(F.col("p_type") == "ECONOMY", F.lit(PRODUCT_RATES["ECONOMY"])),
    )
    return table(spark, sf_dir, "part").select("p_type").distinct().select(
        F.col("p_type").alias("product_id"), rate.cast("decimal(9,4)").alias("base_commission_rate")
    )


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_commission_plans(products(spark, sf_dir), plan_starts(PLAN_START, PLAN_YEARS, spark))


def raw_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as policies, a few re-delivered with a corrected premium."""
    orders = table(spark, sf_dir, "orders")
    sellers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    key, issued = F.col("o_orderkey"), parse_date("o_orderdate")
    sorted_products = F.array(*[F.lit(p) for p in PRODUCT_RATES])
    status = (
        F.when(F.col("o_orderstatus") == "F", "Cancelled")
        .when(F.col("o_orderstatus") == "O", "Active")
        .when(F.col("o_orderstatus") == "P", "Renewed")
    )
    premium = F.when(key % 200 != 0, F.col("o_totalprice").cast("decimal(12,2)"))
    deliveries = F.when(key % 500 == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    product = F.element_at(sorted_products, ((key % 6) + 1).cast("int"))
    ended = F.when(F.col("o_orderstatus") == "F", F.date_add(issued, (key % 400).cast("int")))
    return orders.withColumn("load_seq", F.explode(deliveries)).select(
        key.alias("policy_id"),
        F.concat_ws("-", product, F.lpad(key.cast("string"), 7, "0")).alias("policy_number"),
        F.col("o_custkey").alias("customer_id"),
        product.alias("product_id"),
        (F.col("o_custkey") % sellers).alias("agent_id"),
        issued.alias("issue_date"),
        ended.alias("cancel_date"),
        (premium + F.col("load_seq") - 1).cast("decimal(18,2)").alias("annual_premium"),
        status.alias("policy_status"),
        (1 + key % 2).cast("int").alias("num_renewals"),
        "load_seq",
    )


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a Type-2 dimension: one version each, some closed for good, some without a segment."""
    key = F.col("c_custkey")
    closed = key % 17 == 3
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 13 != 5, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        _date("1995-01-01").alias("effective_start_date"),
        F.when(closed, _date("1996-06-30")).alias("effective_end_date"),
        (~closed).alias("is_current"),
    )


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with changed, unchanged and new customers; some lose their segment."""
    rows = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    balance = F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal")
    on = _date("1999-01-01").alias("effective_start_date")
    known = rows.where(key % 10 <= 1).select(
        "c_custkey",
        F.when(key % 10 == 0, F.concat("c_mktsegment", F.lit("-NEW")))
        .when(key % 30 != 1, F.col("c_mktsegment"))
        .alias("c_mktsegment"),
        balance,
        on,
    )
    new = rows.where(key % 50 == 0).select((key + 10_000_000).alias("c_custkey"), "c_mktsegment", balance, on)
    return known.unionByName(new)
