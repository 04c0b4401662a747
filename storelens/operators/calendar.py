"""Calendar tables. Their size is the number of days between two dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions.columns import iso_weekday


def days_between(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """One row per day of a one-row table of bounds; none if the bounds are null."""
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias(name))


def fill_days(daily: DataFrame, day: str, count: str) -> DataFrame:
    """``daily`` with its missing days added as zero.

    Each day is stretched up to the day before the next one, so ``daily`` is computed once.
    """
    following = F.lead(day).over(Window.partitionBy(F.lit(1)).orderBy(day))
    last = F.coalesce(F.date_sub(following, 1), F.col(day))
    every = daily.withColumn("_last", last).withColumn("_day", F.explode(F.sequence(F.col(day), F.col("_last"))))
    return every.select(
        F.col("_day").alias(day), F.when(F.col("_day") == F.col(day), F.col(count)).otherwise(F.lit(0)).alias(count)
    )


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of a date used for reporting."""
    weekday = iso_weekday(day)
    return {
        "year": F.year(day),
        "month_number": F.month(day),
        "month": F.date_format(day, "MMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "weekday_number": weekday,
        "weekday": F.date_format(day, "EEE"),
        "is_weekend": weekday >= 6,
    }


def date_dim(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Date table over the range held in a one-row table."""
    days = days_between(bounds, first, last, "date")
    return days.select("date", *[c.alias(n) for n, c in calendar_columns(F.col("date")).items()])
