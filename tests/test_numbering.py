from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.operators.numbering import (
    collapse_copies,
    expand_copies,
    global_rank,
    number_rows,
    with_sequence_id,
)


def brute_rank(values):
    known = [v for v in values if v is not None]
    return sorted(
        (v is not None, v, 1 + sum(o > v for o in known) if v is not None else len(known) + 1)
        for v in values
    )


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=25))
def test_rank_equals_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    got = sorted((r["v"] is not None, r["v"], r["rank"]) for r in global_rank(df, "v").collect())
    assert got == brute_rank(values)


def test_rank_with_a_third_of_rows_tied(spark):
    df = spark.range(0, 9_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("v")
    )
    got = global_rank(df, "v")
    best = got.groupBy("v").agg(F.max("rank").alias("r"), F.min("rank").alias("s"), F.count("*").alias("n"))
    rows = sorted(best.collect(), key=lambda r: -r["v"])
    ahead = 0
    for r in rows:
        assert (r["r"], r["s"]) == (ahead + 1, ahead + 1)
        ahead += r["n"]
    assert ahead == 9_000


def test_rank_of_nothing(spark):
    assert global_rank(spark.range(0), "id").isEmpty()


def test_rows_are_numbered_without_gaps(spark):
    df = spark.range(0, 5_000, 1, 8).select(((F.col("id") * 7919) % 5_000).alias("k"))
    got = number_rows(df, [F.col("k").desc()]).collect()
    assert all(r["row_number"] == 5_000 - r["k"] for r in got) and len(got) == 5_000


def test_sequence_ids_are_padded(spark):
    got = with_sequence_id(spark.range(3), [F.col("id")], "policy_id", "POL", 7)
    assert sorted(tuple(r) for r in got.collect()) == [
        (0, "POL0000001"), (1, "POL0000002"), (2, "POL0000003"),
    ]


def test_copies_survive_the_round_trip(spark, monkeypatch):
    monkeypatch.setattr("paytrail.operators.numbering._COPIES_PER_CHUNK", 7)
    df = spark.createDataFrame([("a",)] * 30 + [("b",)] + [(None,)] * 2, "v string")
    back = expand_copies(collapse_copies(df, ["v"]))
    got = sorted((r["v"] or "", r["_copy"]) for r in back.collect())
    assert got == [("", 1), ("", 2)] + [("a", i) for i in range(1, 31)] + [("b", 1)]
