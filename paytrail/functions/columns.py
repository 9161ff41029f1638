"""Column expressions shared by the operators. All stay inside generated code."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail.config import PAYMENT_LAG_DAYS
from paytrail.schemas import MONEY, RATE


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return _col(c).cast(MONEY)


def rate(c: str | Column) -> Column:
    return _col(c).cast(RATE)


def cents(c: str | Column) -> Column:
    """Round half-up to whole cents."""
    return F.round(_col(c), 2).cast(MONEY)


def in_cents(c: str | Column) -> Column:
    """Money as a whole number of cents.

    A bigint holds every ``decimal(18,2)`` exactly and sums several times faster than the
    wider decimal that Spark would sum into.
    """
    return (money(c) * 100).cast("bigint")


def from_cents(c: str | Column) -> Column:
    return (_col(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def parse_date(c: str | Column) -> Column:
    """ISO text, date or timestamp as a date; text that is no date becomes NULL."""
    return _col(c).try_cast("date")


def pay_period(c: str | Column) -> Column:
    """The ``yyyy-MM`` period of a date, timestamp, ISO date or ``yyyy-MM`` text."""
    return F.date_format(parse_date(c), "yyyy-MM")


_STATED = "^[0-9]{4}-(0[1-9]|1[0-2])($|-[0-9]{2}($|[ T]))"


def stated_period(c: str | Column) -> Column:
    """The period that a text states as ``yyyy-MM`` or as an ISO date; NULL for any other text."""
    text = _col(c).cast("string")
    return pay_period(F.when(text.rlike(_STATED), text))


def month_after(period: str | Column, months: int) -> Column:
    """The pay period a number of months after (or, if negative, before) another."""
    first_day = parse_date(F.concat(_col(period), F.lit("-01")))
    return F.date_format(F.add_months(first_day, months), "yyyy-MM")


def payment_date(period: str | Column, lag_days: int = PAYMENT_LAG_DAYS) -> Column:
    """Last day of the period plus the payment lag."""
    first_day = parse_date(F.concat(_col(period), F.lit("-01")))
    return F.date_add(F.last_day(first_day), lag_days)


def published(df: DataFrame) -> DataFrame:
    """Types of a published mart: decimals as DOUBLE, whole numbers as BIGINT, dates as text."""

    def edge(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(field.name)

    return df.select(*[edge(f) for f in df.schema.fields])
