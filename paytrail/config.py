"""Business rules, layer paths and scale settings."""

from __future__ import annotations

import os
from decimal import Decimal

# Business rules that results depend on.
CHARGEBACK_WINDOW_DAYS = 90
RENEWAL_RATIO = Decimal("0.5")
OVERRIDE_RATE = Decimal("0.10")
PAYMENT_HOLD_THRESHOLD = Decimal("-500.00")
PAYMENT_LAG_DAYS = 5
ANNUAL_RATE_DRIFT = Decimal("0.02")
PLAN_YEAR_DAYS = 365
HIGH_RISK_THRESHOLD = Decimal("0.25")
BREAK_TOLERANCE = Decimal("1.00")
TRAILING_MONTHS = 12
DEFAULT_TIER = "Bronze"
TIER_MULTIPLIER = {
    "Bronze": Decimal("0.80"),
    "Silver": Decimal("1.00"),
    "Gold": Decimal("1.15"),
    "Platinum": Decimal("1.30"),
}
NEW_BUSINESS, RENEWAL, OVERRIDE = "New Business", "Renewal", "Override"
TRANSACTION_TYPES = [NEW_BUSINESS, RENEWAL, OVERRIDE]
PAYMENT_STATUSES = ["Paid", "Held", "Scheduled", "Failed"]

# A key holding more than 1/HOT_KEY_LIMIT of all rows is split before a shuffle join.
HOT_KEY_LIMIT = 10_000


LAYERS = ("raw", "bronze", "silver", "gold")


class Lake:
    """A folder per layer under one root, which may be any URI Spark can reach."""

    def __init__(self, root: str | None = None):
        self.root = root or os.environ.get("LAKEHOUSE_ROOT", "data")

    def layer(self, name: str) -> str:
        if name not in LAYERS:
            raise ValueError(f"no layer {name!r}")
        return f"{self.root}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.layer(layer)}/{name}"
