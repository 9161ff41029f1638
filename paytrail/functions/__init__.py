from paytrail.functions.columns import (
    cents,
    from_cents,
    in_cents,
    money,
    month_after,
    parse_date,
    pay_period,
    payment_date,
    published,
    rate,
    stated_period,
)

__all__ = [
    "cents",
    "from_cents",
    "in_cents",
    "money",
    "month_after",
    "parse_date",
    "pay_period",
    "payment_date",
    "published",
    "rate",
    "stated_period",
]
