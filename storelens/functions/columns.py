"""Column expressions shared by the plans. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Holds any sum of whole cents that a 64-bit integer holds, so that an order or product with a large
# share of all lines cannot overflow.
MONEY = "decimal(21,2)"

LATE_AFTER_MINUTES = 35
# The four service groups.
ON_TIME, LATE, REFUNDED, CANCELLED = "On time (<=35m)", "Late (>35m)", "Refunded", "Cancelled"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c: Column | str) -> Column:
    """A two-digit decimal as whole cents, so that line sums run on 64-bit integers."""
    return (col(c) * 100).cast("bigint")


def money(c: Column, kind: str = MONEY) -> Column:
    """Whole cents back to a decimal."""
    return (c.cast("decimal(19,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero or either side is null."""
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))


def average(c: Column | str) -> Column:
    """Mean of a decimal as double. The sum stays exact; ``avg`` would cut it to six digits."""
    return ratio(F.sum(col(c)), F.count(col(c)))


def rate(condition: Column) -> Column:
    """Share of rows that meet the condition; rows where it is unknown are left out."""
    return F.avg(condition.cast("int"))


def rounded(c: Column, digits: int) -> Column:
    return F.round(c, digits)


def is_cancelled() -> Column:
    return F.col("status") == CANCELLED


def not_cancelled() -> Column:
    return F.col("status") != CANCELLED


def outcome_of_service() -> Column:
    """Service group of an order. Unknown minutes fall to the on-time group."""
    return (
        F.when(is_cancelled(), CANCELLED)
        .when(F.col("status") == REFUNDED, REFUNDED)
        .when(F.col("delivery_minutes") > LATE_AFTER_MINUTES, LATE)
        .otherwise(ON_TIME)
    )


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def weekend_label(day: Column) -> Column:
    return F.when(iso_weekday(day) >= 6, "Weekend").otherwise("Weekday")


def month_start(c: Column | str) -> Column:
    return F.trunc(F.to_date(col(c)), "month")


def week_start(c: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(F.to_date(col(c)), "week")


def month_gap(later: Column, earlier: Column) -> Column:
    """Calendar months between two month starts."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def span_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days between two timestamps."""
    return F.timestamp_diff("DAY", earlier, later)
