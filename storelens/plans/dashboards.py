"""Tables behind dashboard visuals that no view, query or mart already serves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import iso_weekday, rate, ratio
from storelens.operators.ranks import percentiles
from storelens.plans import business, marts, measures, views
from storelens.session import write_once
from storelens.sources.star import Star


def revenue_margin_trend(star: Star, where: dict | None = None) -> DataFrame:
    """Net revenue and margin per month, under the page's filters (date, city, store, membership)."""
    return measures.measure(star, ["net_revenue", "contribution_margin", "contribution_margin_pct"],
                            by=["date.year_month"], where=where)


def city_margin_delivery(star: Star) -> DataFrame:
    return business.city_sums(star).select(
        "city", "contribution_margin",
        ratio(F.col("contribution_margin"), F.col("net_revenue")).alias("margin_rate"),
        ratio(F.col("minutes"), F.col("timed")).alias("avg_delivery_minutes"),
    )


def store_exceptions(star: Star) -> DataFrame:
    """Margin, cancellation, on-time and repeat rate per store."""
    cutoff = star.orders.agg(F.max("order_ts") - F.expr("interval '30' day")).scalar()
    repeat = (
        views.order_sequence(star, extra=("store_id",))
        .where(F.col("order_ts") <= cutoff)
        .groupBy("store_id")
        .agg(rate(F.col("repeated_within_30d")).alias("repeat_30d_rate"))
    )
    return marts.store_kpis(star).select(
        "store_id", "city", "zone", "contribution_margin", "cancellation_rate", "on_time_rate"
    ).join(repeat, "store_id", "left")


def channel_scatter(star: Star) -> DataFrame:
    return business.q16_margin_to_cac(star).select("acquisition_channel", "customers", "blended_cac", "margin_per_customer")


def hour_weekday_heatmap(star: Star) -> DataFrame:
    """Orders by hour of day (rows) and weekday (columns)."""
    days = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    cells = star.orders.groupBy(F.hour("order_ts").alias("hour"), iso_weekday(F.to_date("order_ts")).alias("weekday")).count()
    wide = cells.groupBy("hour").agg(
        *[F.coalesce(F.sum(F.when(F.col("weekday") == i, F.col("count"))), F.lit(0)).alias(d) for i, d in enumerate(days, 1)]
    )
    return wide.orderBy("hour")


def stockout_category_store(star: Star) -> DataFrame:
    """Stockout minutes by category and store; inventory folds per store and product first."""
    pairs = star.inventory.groupBy("store_id", "product_id").agg(F.sum("stockout_minutes").alias("stockout_minutes"))
    return (
        pairs.join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category", "store_id")
        .agg(F.sum("stockout_minutes").alias("stockout_minutes"))
        .join(star.stores.select("store_id", "zone"), "store_id")
        .select("category", "store_id", "zone", "stockout_minutes")
    )


def replenishment_review(star: Star, small: int | None = None) -> DataFrame:
    """Products to replenish (often out of stock, profitable) and products to review (wasteful, weak).

    High means at or above the 75th percentile over products, weak means a gross margin rate below
    the median.
    """
    sales = views.product_sums(star).select(
        "product_id", "gross_profit", ratio(F.col("gross_profit"), F.col("item_revenue")).alias("gross_margin_rate")
    )
    stock = marts.inventory_product_kpis(star).select("product_id", "category", "stockout_minutes", "waste_rate")
    products = write_once(stock.join(sales, "product_id"), "replenishment")
    limit = percentiles(
        products, {"stockout_minutes": 0.75, "waste_rate": 0.75, "gross_margin_rate": 0.5}, ["product_id"], small,
    )
    out_of_stock = (F.col("stockout_minutes") >= limit["stockout_minutes"]) & (F.col("gross_profit") > 0)
    wasteful = (F.col("waste_rate") >= limit["waste_rate"]) & (F.col("gross_margin_rate") < limit["gross_margin_rate"])
    return products.withColumn(
        "action", F.when(out_of_stock, "replenish").when(wasteful, "review assortment")
    ).where(F.col("action").isNotNull())
