"""Daily demand forecast: a weekly pattern plus one linear trend, fitted from group sums.

Least squares on a trend, weekday indicators and a weekly sine and cosine has only eight free
directions, since the weekly waves are sums of the weekday indicators. Its fit is therefore the
weekday means plus one slope pooled within weekdays, which needs nothing but sums per weekday.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Columns of the design matrix, and the normal quantile of a 95 % band.
DESIGN_COLUMNS = 10
BAND = 1.96


def demand_forecast(daily: DataFrame, day: str, count: str, horizon: int = 28) -> DataFrame:
    """Forecast the ``horizon`` days after the last day of a gap-free daily series.

    Returns forecast_date, forecast_orders, lower_95, upper_95. The bounds are null unless more
    than ten days exist. Every table here has one row per day or per weekday.
    """
    whole = Window.partitionBy(F.lit(1))
    start = F.min(day).over(whole)
    points = daily.select(
        F.date_diff(F.col(day), start).cast("bigint").alias("t"), F.col(count).cast("bigint").alias("y"), F.col(day).alias("d")
    )
    t, y = F.col("t"), F.col("y")
    sums = points.groupBy((t % 7).alias("slot")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(t).cast("double").alias("st"),
        F.sum(y).cast("double").alias("sy"),
        F.sum(t * t).cast("double").alias("stt"),
        F.sum(t * y).cast("double").alias("sty"),
        F.sum(y * y).cast("double").alias("syy"),
        F.max("d").alias("last"),
    )
    n, st, sy = F.col("n"), F.col("st"), F.col("sy")
    # Seven rows, one per weekday, from here on.
    spread = (
        sums.withColumn("wtt", F.col("stt") - st * st / n)
        .withColumn("wty", F.col("sty") - st * sy / n)
        .withColumn("wyy", F.col("syy") - sy * sy / n)
        .withColumn("days", F.sum("n").over(whole))
        .withColumn("last_day", F.max("last").over(whole))
        .withColumn("slope", F.sum("wty").over(whole) / F.nullif(F.sum("wtt").over(whole), F.lit(0.0)))
        .withColumn("left_over", F.sum("wyy").over(whole) - F.col("slope") * F.sum("wty").over(whole))
    )
    degrees = F.col("days") - DESIGN_COLUMNS
    half_width = BAND * F.sqrt(F.greatest(F.col("left_over"), F.lit(0.0)) / F.when(degrees > 0, degrees))
    ahead = spread.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1)))).where(
        (F.col("days").cast("bigint") + F.col("step")) % 7 == F.col("slot")
    )
    value = F.greatest(F.lit(0.0), sy / n + F.col("slope") * (F.col("days") + F.col("step") - st / n))
    fitted = ahead.select(
        F.date_add("last_day", F.col("step") + 1).alias("forecast_date"), value.alias("v"), half_width.alias("h")
    )
    return fitted.select(
        "forecast_date",
        F.bround("v", 1).alias("forecast_orders"),
        F.bround(F.when(F.col("h").isNotNull(), F.greatest(F.lit(0.0), F.col("v") - F.col("h"))), 1).alias("lower_95"),
        F.bround(F.col("v") + F.col("h"), 1).alias("upper_95"),
    )
