"""Time the headline queries: a warm-up pass, then the median of three full materialisations.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1), runs on local[$BENCH_CPUS] and prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paytrail.plans.queries import QUERIES  # noqa: E402
from paytrail.session import get_spark  # noqa: E402

HEADLINE = [
    "agent_commission_summary",
    "payment_run_summary",
    "chargeback_exposure",
    "agent_leaderboard",
    "reconciliation_report",
    "payment_run",
    "clean_policies",
    "dedup_latest",
    "tier_as_of",
    "rate_lookup",
    "renewal_commission",
    "override_commission",
    "dq_report",
    "dq_unique",
    "upsert",
    "scd2_merge",
    "sequence_ids",
    "extract_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(
        "paytrail-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    for name in names:
        once(name)
    took = {}
    for name in names:
        took[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(scale),
            }
        )
    )


if __name__ == "__main__":
    main()
