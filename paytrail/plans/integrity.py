"""Referential and business integrity across the commission tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.config import CHARGEBACK_WINDOW_DAYS, NEW_BUSINESS, OVERRIDE, RENEWAL
from paytrail.operators.joins import skew_join
from paytrail.operators.quality import (
    Check,
    FrameRule,
    RowRule,
    check_report,
    missing_parent,
    negative,
)

# Fixed value: the share of negative commissions that source errors may explain.
NEGATIVE_SHARE = 0.01


def outside_window(policies: DataFrame, days: int = CHARGEBACK_WINDOW_DAYS) -> FrameRule:
    """Chargebacks later than the window after their policy's issue."""

    def late(chargebacks: DataFrame) -> DataFrame:
        issued = policies.select("policy_id", F.col("issue_date").alias("_issued"))
        dated = skew_join(chargebacks, issued, ["policy_id"], "inner")
        return dated.where(F.datediff("chargeback_date", "_issued") > days).drop("_issued")

    return FrameRule(late)


def commission_integrity(
    transactions: DataFrame, chargebacks: DataFrame, policies: DataFrame, agents: DataFrame
) -> DataFrame:
    """One report row per rule that ties the commission tables together."""
    claw_back = [
        Check("chargeback_has_transaction", missing_parent(transactions, {"original_transaction_id": "transaction_id"}),
        ),
        Check("chargeback_within_window", outside_window(policies),
        ),
        Check("chargeback_is_negative", negative("chargeback_amount")),
    ]
    recipients = [
        Check("override_goes_to_an_upline", missing_parent(agents, {"agent_id": "upline_agent_id"}),
        )
    ]
    signs = [
        Check("negative_commission_is_rare", RowRule(F.col("commission_amount") < 0),
            max_share=NEGATIVE_SHARE,
        )
    ]
    kind = F.col("transaction_type")
    reports = [
        check_report(chargebacks, claw_back, "chargebacks"),
        check_report(transactions.where(kind == OVERRIDE), recipients, "overrides"),
        check_report(transactions.where(kind.isin(NEW_BUSINESS, RENEWAL)), signs, "production"),
    ]
    return reduce(DataFrame.unionByName, reports)
