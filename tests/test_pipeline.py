from datetime import date
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paytrail.config import Lake
from paytrail.operators.quality import DataQualityError, observed
from paytrail.plans import pipeline
from paytrail.plans.silver import silver_tables
from paytrail.schemas import MONTHLY_EXTRACTS, REFERENCE_EXTRACTS
from paytrail.session import OPEN_FOLDERS, at_once, open_folders
from paytrail.sources import extracts, tables
from paytrail.streaming.ingest import _replace_batch, ingest_new_files

SCHEMAS = {**REFERENCE_EXTRACTS, **MONTHLY_EXTRACTS}
d = date
ROWS = {
    "agencies": [("AGY0001", "Acme, \"North\"", "Captive", "West")],
    "agents": [
        ("AGT000001", "Ann", "Lee", None, d(2020, 1, 1), None, "Active", "00123456", "tx", "AGY0001", None),
        ("AGT000001", "Ann", "Lee", None, d(2020, 1, 1), None, "Active", "00123456", "tx", "AGY0001", None),
        ("AGT000002", "Bo", "Day", "b@x.org", d(2020, 1, 1), None, "Active", "00000002", "NY", "AGY0001", "AGT000001"),
    ],
    "agent_tier_history": [
        ("AGT000001", "Gold", d(2020, 1, 1), d(2021, 1, 1), False),
        ("AGT000001", "Platinum", d(2021, 1, 1), None, True),
        ("AGT000002", "Bronze", d(2020, 1, 1), None, True),
    ],
    "products": [("AUTO", "Personal Auto", "Property & Casualty", D("0.1200"), 800, 2600)],
    "commission_plans": [("PLN00001", "AUTO", "Gold", "New Business", D("0.1380"), d(2020, 1, 1), None)],
    "policies": [
        ("POL0000001", "AUTO-0000001", "C1", "AUTO", "AGT000001", d(2025, 1, 5), d(2025, 1, 5), None, D("1000.00"), "Active"),
        ("POL0000001", "AUTO-0000001", "C1", "AUTO", "AGT000001", d(2025, 1, 5), d(2025, 1, 5), None, D("1000.00"), "Active"),
        ("POL0000002", "AUTO-0000002", "C2", "AUTO", "AGT000002", d(2025, 2, 5), d(2025, 2, 5), None, None, "Active"),
    ],
    "commission_transactions": [
        ("TXN00000001", "POL0000001", "AGT000001", "AUTO", "New Business", d(2025, 1, 5), D("1000.00"), D("0.1380"), D("138.00")),
        ("TXN00000002", "POL0000001", "AGT000002", "AUTO", "New Business", d(2025, 1, 9), D("1000.00"), D("0.1380"), D("-138.00")),
        ("TXN00000003", "POL0000001", "AGT000002", "AUTO", "Renewal", d(2025, 2, 9), D("1000.00"), D("0.0600"), D("60.00")),
    ],
    "chargebacks": [
        ("CBK000001", "TXN00000001", "POL0000001", "AGT000001", d(2025, 1, 20), "Free-look cancellation", D("-38.00")),
    ],
    "payments": [
        ("PAY0000001", "AGT000001", "2025-01", d(2025, 2, 5), D("138.00"), D("-38.00"), D("100.00"), "Paid", "ACH"),
        ("PAY0000002", "AGT000002", "2025-02", d(2025, 3, 5), D("60.00"), D("0.00"), D("75.00"), "Paid", "Check"),
    ],
}


def frames(spark, **changed):
    rows = {**ROWS, **changed}
    return {name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in rows}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    paths = Lake(str(tmp_path_factory.mktemp("lake")))
    old = frames(spark)["agencies"].withColumn("agency_name", F.lit("Old"))
    extracts.write_snapshot_extract(old, paths.layer("raw"), "agencies", "2024-12-01")
    extracts.export_extracts(frames(spark), paths.layer("raw"), "2025-03-01")
    headline = pipeline.run_pipeline(spark, paths)
    return paths, headline


def test_headline(lake):
    assert lake[1] == {"matched_periods": 1, "total_periods": 2, "break_periods": 1}


def test_bronze_keeps_rows_types_and_lineage(spark, lake):
    paths = lake[0]
    agents = tables.read_table(spark, paths.table("bronze", "agents"))
    assert agents.count() == 3
    assert {r["license_number"] for r in agents.collect()} == {"00123456", "00000002"}
    assert agents.columns[-2:] == ["_ingested_at", "_source_file"]
    agency = tables.read_table(spark, paths.table("bronze", "agencies")).first()
    assert agency["agency_name"] == 'Acme, "North"' and "full_load_date=2025-03-01" in agency["_source_file"]
    assert extracts.ingest_all(spark, paths.layer("raw"), f"{paths.root}/again") == {
        name: len(rows) for name, rows in ROWS.items()
    }


def test_silver_tables(spark, lake):
    paths = lake[0]
    dim = tables.read_table(spark, paths.table("silver", "dim_agent"))
    assert sorted(r["agent_sk"] for r in dim.collect()) == ["AGT000001_1", "AGT000001_2", "AGT000002_1"]
    assert {r["license_state"] for r in dim.collect()} == {"TX", "NY"}
    policies = tables.read_table(spark, paths.table("silver", "dim_policy"))
    assert policies.count() == 1 and "ingest_month" not in policies.columns
    bad = tables.read_table(spark, paths.table("silver", "_quarantine/fact_commission_transactions"))
    assert [r["transaction_id"] for r in bad.collect()] == ["TXN00000002"]
    paid = tables.read_table(spark, paths.table("silver", "fact_payments"))
    assert dict(paid.dtypes)["pay_period"] == "string"
    log = tables.read_table(spark, paths.table("silver", "_dq_log"))
    assert log.count() == 22 and log.where("passed").count() == 22


def test_gold_marts(spark, lake):
    paths = lake[0]

    def gold(name):
        return tables.read_table(spark, paths.table("gold", name))

    summary = {(r["agent_id"], r["pay_period"]): r for r in gold("agent_commission_summary").collect()}
    assert summary["AGT000001", "2025-01"]["net_commission"] == D("100.00")
    assert summary["AGT000001", "2025-01"]["tier"] == "Platinum"
    statuses = {r["agent_id"]: r["reconciliation_status"] for r in gold("reconciliation_report").collect()}
    assert statuses == {"AGT000001": "MATCHED", "AGT000002": "BREAK"}
    assert {r["agent_id"]: r["rank"] for r in gold("agent_leaderboard").collect()} == {"AGT000001": 1, "AGT000002": 2}
    assert gold("chargeback_exposure").first()["is_high_risk"] is True
    assert gold("payment_run_summary").count() == 2


def test_trailing_periods_prune_folders(spark, lake):
    from paytrail.plans.marts import trailing_periods

    summary = tables.read_table(spark, lake[0].table("gold", "agent_commission_summary"))
    plan = trailing_periods(summary)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "pay_period" in filters and "subquery" in filters.lower()


def test_old_snapshots_are_pruned(spark, lake):
    plan = extracts.snapshot_extract(spark, lake[0].layer("raw"), "agencies")._jdf.queryExecution().executedPlan().toString()
    assert "subquery" in plan.split("PartitionFilters: [")[1].split("]")[0].lower()


def test_gate_and_command_line(spark, lake, capsys):
    paths = lake[0]
    log = paths.table("silver", "_dq_log")
    assert pipeline.main(["gate", "--dq-log-path", log]) == 0
    assert pipeline.main(["bronze", "--raw-dir", paths.layer("raw"), "--out-dir", f"{paths.root}/b2"]) == 0
    assert pipeline.main(["silver", "--bronze-dir", f"{paths.root}/b2", "--silver-dir", f"{paths.root}/s2"]) == 0
    assert pipeline.main(["gold", "--silver-dir", f"{paths.root}/s2", "--gold-dir", f"{paths.root}/g2"]) == 0
    assert "in agreement 1, to review 1" in capsys.readouterr().out


def test_published_tables_give_the_same_marts(spark, lake, tmp_path):
    paths = lake[0]
    spark.sql("CREATE DATABASE IF NOT EXISTS sales")
    pipeline.run_silver(spark, paths.layer("bronze"), f"{tmp_path}/silver", database="sales")
    assert pipeline.run_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", database="sales") == lake[1]
    dim = spark.table("sales.dim_agent")
    assert dict(dim.dtypes)["is_current"] == "boolean" and dim.where("is_current").count() == 2


def test_a_failed_write_leaves_the_published_rows(spark, tmp_path):
    rows = spark.range(10).withColumn("v", F.lit("old"))
    tables.publish_table(rows, "kept_rows", f"{tmp_path}/t")
    bad = spark.range(10).withColumn("v", F.when(F.col("id") < 9, F.lit("new")).otherwise(F.raise_error(F.lit("lost"))))
    reading = spark.table("kept_rows")
    with pytest.raises(PySparkException, match="lost"):
        tables.publish_table(bad, "kept_rows", f"{tmp_path}/t")
    assert {tuple(r) for r in spark.table("kept_rows").select("v").collect()} == {("old",)}
    tables.publish_table(rows.withColumn("v", F.lit("new")), "kept_rows", f"{tmp_path}/t")
    assert {r["v"] for r in spark.table("kept_rows").collect()} == {"new"} and {r["v"] for r in reading.collect()} == {"old"}


def test_a_failed_check_leaves_the_table_as_it_was(spark, lake, tmp_path):
    paths = lake[0]
    pipeline.run_silver(spark, paths.layer("bronze"), f"{tmp_path}/silver")
    twice = frames(spark, payments=ROWS["payments"][:1] * 2)
    extracts.export_extracts(twice, f"{tmp_path}/raw", "2025-03-01")
    extracts.ingest_all(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze")
    with pytest.raises(DataQualityError):
        pipeline.run_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")
    assert tables.read_table(spark, f"{tmp_path}/silver/fact_payments").count() == 2


def test_each_fact_is_scanned_once(spark, lake, tmp_path):
    """Files of bronze facts are read by one job: the one that stages the table."""
    bronze = tables.read_table(spark, lake[0].table("bronze", "payments"))
    table = next(t for t in silver_tables() if t.name == "fact_payments")
    plan = observed(table.build(bronze), table.checks)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan


def test_failed_check_stops_the_run_and_the_gate(spark, tmp_path):
    paths = Lake(str(tmp_path))
    twice = ROWS["commission_transactions"][:1] * 2
    extracts.export_extracts(frames(spark, commission_transactions=twice), paths.layer("raw"), "2025-03-01")
    with pytest.raises(DataQualityError, match="transaction_id_unique"):
        pipeline.run_pipeline(spark, paths)
    assert not tables.table_exists(spark, paths.table("silver", "fact_commission_transactions"))
    assert pipeline.check_gate(spark, paths.table("silver", "_dq_log")) == 1


def test_bad_dates_land_in_the_default_folder(spark, tmp_path):
    rows = spark.createDataFrame([("P1", d(2025, 1, 5)), ("P2", None)], "policy_id string, issue_date date")
    extracts.write_monthly_extract(rows, str(tmp_path), "policies", "issue_date")
    folders = {p.name for p in (tmp_path / "policies").iterdir() if p.is_dir()}
    assert folders == {"ingest_month=2025-01", "ingest_month=__HIVE_DEFAULT_PARTITION__"}
    assert extracts.monthly_extract(spark, str(tmp_path), "policies").count() == 2


def test_incremental_ingest_equals_full_read(spark, tmp_path):
    raw, bronze = f"{tmp_path}/raw", f"{tmp_path}/bronze"
    name, full = "commission_transactions", frames(spark)["commission_transactions"]
    for month in ("2025-01", "2025-02"):
        part = full.where(F.date_format("transaction_date", "yyyy-MM") == month)
        extracts.write_monthly_extract(part, raw, name, "transaction_date")
        ingest_new_files(spark, raw, name, bronze, f"{tmp_path}/progress")
    ingest_new_files(spark, raw, name, bronze, f"{tmp_path}/progress")
    landed = tables.read_table(spark, f"{bronze}/{name}").select(*full.columns)
    assert landed.exceptAll(full).isEmpty() and landed.count() == full.count()


def test_inferred_extract_is_possible(spark, lake):
    df = extracts.read_extract(spark, f"{lake[0].layer("raw")}/reference/products", None)
    assert df.where("product_id = 'AUTO'").count() == 1


def test_quarantine_is_replaced_when_nothing_is_bad(spark, tmp_path):
    bad = spark.createDataFrame([(1,)], "n int")
    tables.write_quarantine(bad, str(tmp_path), "t")
    tables.write_quarantine(bad.where("false"), str(tmp_path), "t")
    assert tables.read_table(spark, f"{tmp_path}/_quarantine/t").count() == 0


def test_append_and_existence(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not tables.table_exists(spark, path)
    for n in range(2):
        tables.append_table(spark.range(n, n + 1), path)
    assert tables.table_exists(spark, path) and tables.read_table(spark, path).count() == 2


def test_files_are_read_by_header_and_malformed_rows_are_kept_apart(spark, tmp_path):
    names = [c.split()[0] for c in extracts.MONTHLY_EXTRACTS["payments"].split(", ")]
    folder = tmp_path / "raw" / "payments" / "ingest_month=2025-02"
    folder.mkdir(parents=True)
    values = dict(zip(names, ["P1", "A", "2025-02", "2025-03-15", "10.50", "0.00", "10.50", "Paid", "ACH"]))
    order = ["more", *reversed(names)]
    lines = [",".join(order)]
    for k, net in enumerate(["10.50", "ten"]):
        row = {**values, "payment_id": f"P{k}", "net_payment_amount": net, "more": "x"}
        lines.append(",".join(row[c] for c in order))
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    raw, bronze = str(tmp_path / "raw"), str(tmp_path / "bronze")
    row = extracts.monthly_extract(spark, raw, "payments").collect()
    assert [(r.payment_id, r.pay_period, r.net_payment_amount, r.payment_status) for r in row] == [("P0", "2025-02", D("10.50"), "Paid")]
    ingest_new_files(spark, raw, "payments", bronze, str(tmp_path / "progress"))
    assert [r.payment_id for r in tables.read_table(spark, f"{bronze}/payments").collect()] == ["P0"]
    kept = tables.read_table(spark, f"{bronze}/_quarantine/payments").collect()
    assert [r.payment_id for r in kept] == ["P1"] and "ten" in kept[0]["_malformed"]
    (folder / "b.csv").write_text(",".join(names) + "\n" + ",".join(values[c] for c in names) + "\n")
    both = extracts.monthly_extract(spark, raw, "payments").collect()
    assert sorted((r.payment_id, r.agent_id, r.net_payment_amount, r.payment_method) for r in both) == [
        ("P0", "A", D("10.50"), "ACH"), ("P1", "A", D("10.50"), "ACH"),
    ]
    (folder / "c.csv").write_text("payment_id,net_payment_amount\nP9,1.25\nP8,x\n")
    (folder / "empty.csv").write_text("")
    ingest_new_files(spark, raw, "payments", bronze, str(tmp_path / "progress"))
    landed = tables.read_table(spark, f"{bronze}/payments").orderBy("payment_id").collect()
    assert [(r.payment_id, r.net_payment_amount, r.payment_status) for r in landed] == [
        ("P0", D("10.50"), "Paid"), ("P1", D("10.50"), "Paid"), ("P9", D("1.25"), None),
    ]
    assert sorted(r.payment_id for r in tables.read_table(spark, f"{bronze}/_quarantine/payments").collect()) == ["P1", "P8"]
    assert "c.csv" in landed[2]["_source_file"]


def test_an_old_snapshot_with_another_header_does_no_harm(spark, tmp_path):
    old = frames(spark)["agencies"].drop("region").withColumnRenamed("agency_type", "kind")
    extracts.write_snapshot_extract(old, str(tmp_path), "agencies", "2024-12-01")
    extracts.write_snapshot_extract(frames(spark)["agencies"], str(tmp_path), "agencies", "2025-01-01")
    assert [tuple(r)[:4] for r in extracts.snapshot_extract(spark, str(tmp_path), "agencies").collect()] == ROWS["agencies"]


def test_a_batch_that_lands_again_replaces_itself(spark, tmp_path):
    for _ in range(2):
        _replace_batch(spark.range(5), f"{tmp_path}/t", 3)
    _replace_batch(spark.range(5, 7), f"{tmp_path}/t", 4)
    assert sorted(r["id"] for r in tables.read_table(spark, f"{tmp_path}/t").collect()) == list(range(7))


def test_snapshot_date_comes_from_the_listing(spark, lake):
    plan = extracts.snapshot_extract(spark, lake[0].layer("raw"), "agencies")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1


def test_equal_variances_are_spread_by_the_sort(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20000).select(F.lit(0.0).alias("variance"), F.col("id").cast("string").alias("agent_id"), F.lit("2025-01").alias("pay_period"))
    held = rows.repartition(8).orderBy(F.abs("variance").desc(), "agent_id", "pay_period").rdd.glom().map(len).collect()
    assert max(held) < 3 * 20000 / max(1, sum(n > 0 for n in held))


def test_landing_sorts_no_rows(spark, tmp_path):
    """A write into folders sorts in memory all rows of a split, so the scratch table of a delivery has none."""
    folder = tmp_path / "raw" / "payments" / "ingest_month=2025-02"
    folder.mkdir(parents=True)
    lines = [f"P{k},{'x' if k == 2 else k}.00" for k in range(5)]
    (folder / "a.csv").write_text("\n".join(["payment_id,net_payment_amount", *lines]) + "\n")
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("landing-*"))
    ingest_new_files(spark, str(tmp_path / "raw"), "payments", str(tmp_path / "bronze"), str(tmp_path / "progress"))
    (stage,) = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("landing-*")) - before
    assert not [f for f in stage.iterdir() if f.is_dir()] and spark.read.parquet(str(stage)).count() == 5
    landed = tables.read_table(spark, f"{tmp_path}/bronze/payments")
    assert sorted(r.payment_id for r in landed.collect()) == ["P0", "P1", "P3", "P4"]
    kept = tables.read_table(spark, f"{tmp_path}/bronze/_quarantine/payments")
    assert [r.payment_id for r in kept.collect()] == ["P2"]


def test_exports_sort_no_rows_by_folder(spark, tmp_path):
    """A task keeps the files of its months open; more months than that are sorted, and no row is lost."""
    log = spark._jsparkSession.sessionState().conf()
    before = log.maxConcurrentOutputFileWriters()
    with open_folders(spark):
        assert log.maxConcurrentOutputFileWriters() == OPEN_FOLDERS
    assert log.maxConcurrentOutputFileWriters() == before
    months = spark.range(6 * OPEN_FOLDERS).select(
        F.col("id").cast("string").alias("policy_id"),
        F.add_months(F.lit(d(2000, 1, 1)), (F.col("id") % (2 * OPEN_FOLDERS)).cast("int")).alias("issue_date"),
    )
    extracts.write_monthly_extract(months.coalesce(1), str(tmp_path), "policies", "issue_date")
    read = extracts.monthly_extract(spark, str(tmp_path), "policies").select("policy_id", "issue_date")
    assert read.exceptAll(months).isEmpty() and read.count() == 6 * OPEN_FOLDERS
    assert len(list((tmp_path / "policies").glob("ingest_month=*"))) == 2 * OPEN_FOLDERS


def test_files_without_malformed_rows_are_parsed_once(spark, lake, tmp_path, monkeypatch):
    """The write of a bronze table counts its malformed rows; only a table that has some is read again for them."""
    raw = tmp_path / "raw"
    extracts.export_extracts(frames(spark), str(raw), "2025-03-01")
    (raw / "payments" / "ingest_month=2025-02" / "late.csv").write_text("payment_id,net_payment_amount\nP8,x\nP9,1.00\n")
    scans = {}

    def watched(df, bronze_dir, name, fmt="parquet"):
        scans[name] = "FileScan csv" in extracts.malformed(df)._jdf.queryExecution().executedPlan().toString()
        quarantine(df, bronze_dir, name, fmt)

    quarantine = extracts.quarantine_malformed
    monkeypatch.setattr(extracts, "quarantine_malformed", watched)
    landed = extracts.ingest_all(spark, str(raw), str(tmp_path / "bronze"))
    assert landed == {**{name: len(rows) for name, rows in ROWS.items()}, "payments": 3}
    assert scans == {name: name == "payments" for name in ROWS}
    bad = {name: tables.read_table(spark, f"{tmp_path}/bronze/_quarantine/{name}") for name in ROWS}
    assert {name: df.count() for name, df in bad.items()} == {name: int(name == "payments") for name in ROWS}
    assert bad["agents"].columns == [c for c in frames(spark)["agents"].columns] + [extracts.MALFORMED, "_source_file"]


def test_facts_are_stored_without_a_scratch_copy(spark, lake, tmp_path):
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    names = [t.name for t in silver_tables()]
    before = {name: len(list(scratch.glob(f"{name}-*"))) for name in names}
    pipeline.run_silver(spark, lake[0].layer("bronze"), str(tmp_path))
    made = {name: len(list(scratch.glob(f"{name}-*"))) - before[name] for name in names}
    assert made == {t.name: int(t.staged) for t in silver_tables()}
    for name in names:
        rows, first = tables.read_table(spark, f"{tmp_path}/{name}"), tables.read_table(spark, lake[0].table("silver", name))
        assert rows.exceptAll(first).isEmpty() and rows.count() == first.count()


def test_steps_at_once_keep_their_order_and_all_end_before_a_failure(spark):
    ended = []

    def failing():
        raise ValueError("step")

    assert at_once(spark, [lambda k=k: spark.range(k).count() for k in range(6)]) == list(range(6))
    with pytest.raises(ValueError, match="step"):
        at_once(spark, [failing, lambda: ended.append(spark.range(3).count())])
    assert ended == [3]
