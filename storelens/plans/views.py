"""The five semantic views and the order-level facts behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import MONEY, average, cents, is_cancelled, money, not_cancelled, rate
from storelens.operators.sequence import next_in_group
from storelens.sources.star import Star


def with_economics(orders: DataFrame) -> DataFrame:
    """Net revenue, realised cost, contribution margin and on-time flag for orders with totals.

    A cancelled order earns nothing and realises no goods cost, but its delivery cost stays.
    """
    earned = "gross_merchandise_value - discount_amount + delivery_fee + packaging_fee - refund_amount"
    return orders.selectExpr(
        "*",
        f"cast(if(status = 'Cancelled', 0, {earned}) as {MONEY}) as net_revenue",
        f"cast(if(status = 'Cancelled', 0, cogs) as {MONEY}) as realized_cogs",
        "coalesce(delivery_minutes <= promised_minutes, false) as is_on_time",
    ).withColumn(
        "contribution_margin", F.expr(f"cast(net_revenue - realized_cogs - estimated_delivery_cost as {MONEY})")
    )


def economics(star: Star) -> DataFrame:
    """Order-level economics with all derived columns; orders without lines drop out."""
    return with_economics(star.orders_with_totals.where(F.col("units").isNotNull()))


def order_economics(star: Star) -> DataFrame:
    """View: every order column plus units, cogs, net revenue, margin and on-time flag."""
    return economics(star).drop("item_revenue", "realized_cogs")


def order_economics_mart(star: Star) -> DataFrame:
    """The economics table as published, with item revenue, realised cost and order date."""
    return economics(star).withColumn("order_date", F.to_date("order_ts"))


def order_sequence(star: Star, extra: tuple[str, ...] = (), slices: int | None = None) -> DataFrame:
    """Each order with the customer's next order time and whether it fell within 30 days.

    Cancelled orders count on both ends; orders at the same time follow their id.
    """
    columns = ["customer_id", "order_id", "order_ts", "delivery_minutes", "status", *extra]
    led = next_in_group(star.orders.select(*columns), "customer_id", "order_ts", "order_id", "next_order_ts", slices)
    return led.withColumn(
        "repeated_within_30d",
        F.coalesce(F.col("next_order_ts") <= F.col("order_ts") + F.expr("interval '30' day"), F.lit(False)),
    )


def customer_order_sequence(star: Star) -> DataFrame:
    """View: the order sequence of every customer."""
    return order_sequence(star)


def daily_store_kpis(star: Star) -> DataFrame:
    """View: service and money per day and store; service figures leave cancelled orders out."""
    return (
        economics(star)
        .groupBy(F.to_date("order_ts").alias("order_date"), "store_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(F.col("status") == "Delivered").alias("delivered_orders"),
            F.sum("gross_merchandise_value").alias("gmv"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("contribution_margin").alias("contribution_margin"),
            average(F.when(not_cancelled(), F.col("delivery_minutes"))).alias("avg_delivery_minutes"),
            rate(F.when(not_cancelled(), F.col("is_on_time"))).alias("on_time_rate"),
            rate(is_cancelled()).alias("cancellation_rate"),
        )
    )


def realized_lines(star: Star) -> DataFrame:
    """Order lines of orders that were not cancelled.

    The order side is unique per id and the line side is what a heavy order would skew; a semi join
    lets AQE split that side freely.
    """
    kept = star.orders.where(not_cancelled()).select("order_id")
    return star.order_items.join(kept, "order_id", "left_semi")


def product_sums(star: Star) -> DataFrame:
    """Units, revenue and gross profit per product over realised lines."""
    quantity = F.col("quantity").cast("bigint")
    revenue, cost = F.sum(quantity * cents("unit_selling_price")), F.sum(quantity * cents("unit_cost"))
    return realized_lines(star).groupBy("product_id").agg(
        F.sum(quantity).alias("units"),
        money(revenue).alias("item_revenue"),
        money(revenue - cost).alias("gross_profit"),
    )


def product_kpis(star: Star, tier: bool = False) -> DataFrame:
    """View: product sums with the product's place in the hierarchy (and brand tier for the mart)."""
    labels = ["category", "subcategory"] + (["brand_tier"] if tier else [])
    named = product_sums(star).join(star.products.select("product_id", *labels), "product_id")
    return named.select("product_id", *labels, "units", "item_revenue", "gross_profit")


def experiment_results(star: Star) -> DataFrame:
    """View: funnel of each experiment variant."""
    return star.sessions.groupBy("experiment_variant").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("converted").alias("conversions"),
        rate(F.col("converted")).alias("conversion_rate"),
        rate(F.col("added_to_cart")).alias("add_to_cart_rate"),
        rate(F.col("checkout_started")).alias("checkout_rate"),
    )
