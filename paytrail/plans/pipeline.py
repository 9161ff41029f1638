"""The staged pipeline: extracts -> bronze -> silver -> gold, and the quality gate.

    python -m paytrail.plans.pipeline bronze --raw-dir R --out-dir B
    python -m paytrail.plans.pipeline silver --bronze-dir B --silver-dir S
    python -m paytrail.plans.pipeline gold   --silver-dir S --gold-dir G
    python -m paytrail.plans.pipeline gate   --dq-log-path S/_dq_log
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.config import Lake
from paytrail.operators.quality import observed, quality_gate, run_checks
from paytrail.plans import marts
from paytrail.plans.silver import silver_tables
from paytrail.session import at_once, get_spark, open_folders, scratch_path
from paytrail.sources.extracts import ingest_all
from paytrail.sources.tables import publish_table, read_table, write_quarantine, write_table


_VALID = "_valid"


def _reader(spark: SparkSession, folder: str, fmt: str, database: str | None) -> Callable[[str], DataFrame]:
    if database:
        return lambda name: spark.table(f"{database}.{name}")
    return lambda name: read_table(spark, f"{folder}/{name}", fmt)


def run_silver(
    spark: SparkSession, bronze_dir: str, silver_dir: str, fmt: str = "parquet", database: str | None = None
) -> None:
    """Build, check and store each silver table; a failed error check stops the run before the table is replaced.

    A table that takes shuffles is built once, into a scratch table with a folder for its valid rows: row rules are counted
    while it is written, key rules on the stored keys, and valid and bad rows are stored from their folders.
    Facts are plain projections of bronze: they are checked in one scan of it and then stored from it, without a scratch
    copy. They arrive in month folders, so their input splits already hold few periods and are written without a shuffle.
    With ``database``, readers move to the new table by the catalog.
    """
    for table in silver_tables():
        built = table.build(*[read_table(spark, f"{bronze_dir}/{name}", fmt) for name in table.sources])
        valid = F.lit(True) if table.valid is None else F.coalesce(table.valid, F.lit(False))
        stored, watch = built.withColumn(_VALID, valid), None
        if table.staged:
            flagged, watch = observed(stored, table.checks, F.col(_VALID))
            stage = scratch_path(spark, table.name)
            with open_folders(spark):
                flagged.write.partitionBy(_VALID).parquet(stage)
            stored = spark.read.schema(flagged.schema).parquet(stage)
        clean, bad = (stored.where(c).select(*built.columns) for c in (F.col(_VALID), ~F.col(_VALID)))
        run_checks(
            spark, clean, table.checks, table.name, f"{silver_dir}/_dq_log", log_format=fmt, watch=watch
        )
        path = f"{silver_dir}/{table.name}"
        if database:
            publish_table(clean, f"{database}.{table.name}", path, table.partition_by, table.staged)
        else:
            write_table(clean, path, "overwrite", table.partition_by, fmt, balanced=table.staged)
        if table.valid is not None:
            write_quarantine(bad, silver_dir, table.name, fmt)


def run_gold(
    spark: SparkSession, silver_dir: str, gold_dir: str, fmt: str = "parquet", database: str | None = None
) -> dict:
    """Build all marts, those that do not need one another at once; the result is the reconciliation headline."""
    silver = _reader(spark, silver_dir, fmt, database)
    gold = _reader(spark, gold_dir, fmt, database)

    def publish(name: str, mart: DataFrame, *folders: str, order_by: list[str] | None = None) -> DataFrame:
        if database:
            publish_table(mart, f"{database}.{name}", f"{gold_dir}/{name}", list(folders), order_by=order_by)
        else:
            write_table(mart, f"{gold_dir}/{name}", partition_by=list(folders), fmt=fmt, order_by=order_by)
        return gold(name).select(*mart.columns)

    transactions, chargebacks = silver("fact_commission_transactions"), silver("fact_chargebacks")
    agents, payments = silver("dim_agent"), silver("fact_payments")

    summary, *_ = at_once(spark, [
        lambda: publish(
            "agent_commission_summary",
            marts.agent_commission_summary(transactions, chargebacks, agents),
            "pay_period",
        ),
        lambda: publish(
            "payment_run_summary",
            marts.payment_run_summary(payments, agents, silver("dim_agency")),
            "pay_period",
            order_by=["agency_id"],
        ),
        lambda: publish("chargeback_exposure", marts.chargeback_exposure(transactions, chargebacks, agents)),
    ])
    report, _ = at_once(spark, [
        lambda: publish("reconciliation_report", marts.reconciliation_report(summary, payments)),
        lambda: publish("agent_leaderboard", marts.agent_leaderboard(summary)),
    ])
    return marts.reconciliation_headline(report).first().asDict()


def run_pipeline(spark: SparkSession, paths: Lake) -> dict:
    """All stages in order over one lake root."""
    ingest_all(spark, paths.layer("raw"), paths.layer("bronze"))
    run_silver(spark, paths.layer("bronze"), paths.layer("silver"))
    return run_gold(spark, paths.layer("silver"), paths.layer("gold"))


def check_gate(spark: SparkSession, log_path: str, whole_history: bool = True) -> int:
    """Exit code of the gate; failing checks are shown in full."""
    failed = quality_gate(read_table(spark, log_path), whole_history)
    if failed.isEmpty():
        print("gate open")
        return 0
    failed.show(truncate=False)
    print("gate closed by the checks above", file=sys.stderr)
    return 1


def main(argv: list[str] | None = None) -> int:
    paths = Lake()
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    stages = parser.add_subparsers(dest="stage", required=True)
    bronze = stages.add_parser("bronze")
    bronze.add_argument("--raw-dir", default=paths.layer("raw"))
    bronze.add_argument("--out-dir", default=paths.layer("bronze"))
    silver = stages.add_parser("silver")
    silver.add_argument("--bronze-dir", default=paths.layer("bronze"))
    silver.add_argument("--silver-dir", default=paths.layer("silver"))
    gold = stages.add_parser("gold")
    gold.add_argument("--silver-dir", default=paths.layer("silver"))
    gold.add_argument("--gold-dir", default=paths.layer("gold"))
    for stage in (silver, gold):
        stage.add_argument("--database", help="publish tables to this database, without a moment in which none stands")
    gate = stages.add_parser("gate")
    gate.add_argument("--dq-log-path", default=paths.table("silver", "_dq_log"))
    gate.add_argument("--newest-run", action="store_true")
    args = parser.parse_args(argv)

    spark = get_spark(f"paytrail-{args.stage}")
    if args.stage == "bronze":
        for name, rows in ingest_all(spark, args.raw_dir, args.out_dir).items():
            print(f"landed {rows} rows of {name}")
    elif args.stage == "silver":
        run_silver(spark, args.bronze_dir, args.silver_dir, database=args.database)
        print(f"silver tables stand in {args.silver_dir}")
    elif args.stage == "gold":
        found = run_gold(spark, args.silver_dir, args.gold_dir, database=args.database)
        print(
            f"agent periods: {found['total_periods']}, in agreement {found['matched_periods']}, "
            f"to review {found['break_periods']}"
        )
    else:
        return check_gate(spark, args.dq_log_path, not args.newest_run)
    return 0


if __name__ == "__main__":
    sys.exit(main())
