from datetime import date

from pyspark.sql import functions as F

from paytrail.functions import stated_period
from paytrail.operators.commission import renewal_dates


def test_stated_periods(spark):
    texts = ["2025-01", "2025-12-31", "2025-01-05T10:00:00", "202501", "2025-13", "2025-Q1", "2025-02-31", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(stated_period("t").alias("p"))
    assert [r.p for r in df.collect()] == ["2025-01", "2025-12", "2025-01", None, None, None, None, None, None]


def test_absurd_renewal_counts_stop_at_the_end_date(spark):
    rows = [("a", 50_000_000), ("b", 1), ("c", -3), ("d", None)]
    df = spark.createDataFrame(rows, "policy_id string, num_renewals long").select(
        "*", F.lit("Renewed").alias("policy_status"), F.lit(date(2020, 1, 1)).alias("issue_date"))
    due = renewal_dates(df, F.to_date(F.lit("2022-06-01"))).collect()
    assert sorted((r.policy_id, r.renewal_number) for r in due) == [("a", 1), ("a", 2), ("b", 1)]
