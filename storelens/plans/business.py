"""The 25 business queries.

Facts are summed per key before they meet a dimension: the join then sees one row per store,
product or customer, however many fact rows one of them holds. Dimensions carry no broadcast hint;
their size decides. Sorts end in a key so that ties have one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions.columns import (
    LATE_AFTER_MINUTES, average, cents, is_cancelled, month_gap, month_start, not_cancelled,
    outcome_of_service, rate, ratio, rounded, week_start, weekend_label, iso_weekday,
)
from storelens.operators.ranks import Key, percentiles, tiles
from storelens.operators.significance import pooled_error
from storelens.plans import views
from storelens.session import write_once
from storelens.sources.star import Star

ROWS = "*"


def q01_exec_snapshot(star: Star) -> DataFrame:
    """Customers are counted apart from the sums, or every sum would travel once per customer."""
    margin, revenue = F.sum("contribution_margin"), F.sum("net_revenue")
    priced = views.economics(star)
    customers = priced.agg(F.count_distinct("customer_id")).scalar()
    return priced.agg(
        F.count(ROWS).alias("orders"),
        F.sum("gross_merchandise_value").alias("gmv"),
        revenue.alias("net_revenue"),
        margin.alias("contribution_margin"),
        rounded(ratio(margin, revenue), 4).alias("margin_rate"),
        rounded(rate(is_cancelled()), 4).alias("cancellation_rate"),
    ).select("orders", customers.alias("customers"), "gmv", "net_revenue", "contribution_margin", "margin_rate", "cancellation_rate")


def _store_money(star: Star) -> DataFrame:
    return views.economics(star).groupBy("store_id").agg(
        F.count(ROWS).alias("orders"),
        F.sum("gross_merchandise_value").alias("gmv"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("contribution_margin").alias("contribution_margin"),
        F.sum(F.when(not_cancelled(), F.col("delivery_minutes"))).alias("minutes"),
        F.count(F.when(not_cancelled(), F.col("delivery_minutes"))).alias("timed"),
        F.count_if(not_cancelled() & F.col("is_on_time")).alias("on_time"),
        F.count_if(not_cancelled()).alias("kept"),
    )


def city_sums(star: Star) -> DataFrame:
    """Order, money and delivery sums per store city."""
    per_store = _store_money(star).join(star.stores.select("store_id", "city"), "store_id")
    names = ["orders", "gmv", "net_revenue", "contribution_margin", "minutes", "timed"]
    return per_store.groupBy("city").agg(*[F.sum(n).alias(n) for n in names])


def q02_city_value(star: Star) -> DataFrame:
    return (
        city_sums(star)
        .select(
            "city", "orders", "gmv", "contribution_margin",
            rounded(ratio(F.col("contribution_margin"), F.col("net_revenue")), 4).alias("margin_rate"),
        )
        .orderBy(F.desc_nulls_last("contribution_margin"), "city")
    )


def q03_store_margin_delivery(star: Star) -> DataFrame:
    return (
        _store_money(star)
        .join(star.stores.select("store_id", "city", "zone"), "store_id")
        .select(
            "store_id", "city", "zone", "orders", "contribution_margin",
            rounded(ratio(F.col("minutes"), F.col("timed")), 2).alias("avg_delivery_minutes"),
            rounded(ratio(F.col("on_time"), F.col("kept")), 4).alias("on_time_rate"),
        )
        .orderBy(F.asc_nulls_last("contribution_margin"), F.asc_nulls_last("on_time_rate"), "store_id")
    )


def q04_category_profit(star: Star) -> DataFrame:
    return (
        views.product_sums(star)
        .join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("units").alias("units"),
            F.sum("item_revenue").alias("item_revenue"),
            F.sum("gross_profit").alias("gross_profit"),
        )
        .orderBy(F.desc_nulls_last("gross_profit"), "category")
    )


def q05_weak_unit_economics(star: Star, top: int = 20, small: int | None = None) -> DataFrame:
    products = write_once(views.product_kpis(star), "product-kpis")
    floor = percentiles(products, {"item_revenue": 0.75}, ["product_id"], small)["item_revenue"]
    return (
        products.where(F.col("item_revenue").cast("double") >= floor)
        .withColumn("gross_margin_rate", rounded(ratio(F.col("gross_profit"), F.col("item_revenue")), 4))
        .orderBy(F.asc_nulls_last("gross_margin_rate"), "product_id")
        .limit(top)
    )


def service_retention(star: Star) -> DataFrame:
    """Orders and 30-day repeat rate per service outcome, over orders old enough to be judged."""
    cutoff = star.orders.agg(F.max("order_ts") - F.expr("interval '30' day")).scalar()
    return (
        views.order_sequence(star)
        .where(F.col("order_ts") <= cutoff)
        .groupBy(outcome_of_service().alias("service_group"))
        .agg(F.count(ROWS).alias("eligible_orders"), rate(F.col("repeated_within_30d")).alias("repeat_30d_rate"))
    )


def q06_service_repeat(star: Star) -> DataFrame:
    return (
        service_retention(star)
        .withColumn("repeat_30d_rate", rounded(F.col("repeat_30d_rate"), 4))
        .orderBy(F.desc("repeat_30d_rate"), "service_group")
    )


def cohort_counts(star: Star) -> DataFrame:
    """Active customers per first-order month and months since, with the size of the cohort.

    Orders shrink to one row per customer and month before anything is grouped by customer, so a
    customer's group is bounded by the calendar.
    """
    months = (
        star.orders.where(not_cancelled()).groupBy("customer_id", month_start("order_ts").alias("month")).agg(F.count(ROWS).alias("n"))
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    # One row per customer and month, so counting rows counts customers; a null id is no customer.
    counted = (
        months.withColumn("cohort_month", first)
        .groupBy("cohort_month", month_gap(F.col("month"), F.col("cohort_month")).alias("month_number"))
        .agg(F.count("customer_id").alias("active_customers"))
    )
    at_start = F.when(F.col("month_number") == 0, F.col("active_customers"))
    return counted.withColumn("cohort_size", F.max(at_start).over(Window.partitionBy("cohort_month")))


def q07_cohort_retention(star: Star) -> DataFrame:
    return (
        cohort_counts(star)
        .select(
            "cohort_month", "month_number", "active_customers",
            rounded(ratio(F.col("active_customers"), F.col("cohort_size")), 4).alias("retention_rate"),
        )
        .orderBy("cohort_month", "month_number")
    )


def q08_rfm_segments(star: Star, small: int | None = None) -> DataFrame:
    value = write_once(
        views.economics(star)
        .where(not_cancelled())
        .groupBy("customer_id")
        .agg(
            F.to_date(F.max("order_ts")).alias("last_day"),
            F.count(ROWS).alias("frequency"),
            F.sum("net_revenue").alias("monetary"),
        ),
        "customer-value",
    )
    # The fewest days since the last order come first, which is the latest day first.
    scored = tiles(value, {
        "recency": ([Key("last_day", descending=True), "customer_id"], 5, "ntile"),
        "f_tile": (["frequency", "customer_id"], 5, "ntile"), "m_tile": (["monetary", "customer_id"], 5, "ntile"),
    }, small)
    score = F.col("score")
    return (
        scored.withColumn("score", 6 - F.col("recency") + F.col("f_tile") + F.col("m_tile"))
        .groupBy(
            F.when(score >= 13, "Champions").when(score >= 10, "Loyal").when(score >= 7, "Needs Attention")
            .otherwise("At Risk").alias("segment")
        )
        .agg(F.count(ROWS).alias("customers"), rounded(average("monetary"), 2).alias("avg_customer_revenue"))
        .orderBy(F.desc("avg_customer_revenue"), "segment")
    )


def q09_discount_bands(star: Star) -> DataFrame:
    discount = F.col("discount_amount")
    band = (
        F.when(discount == 0, "No discount").when(discount < 30, "INR 1-29").when(discount < 60, "INR 30-59")
        .otherwise("INR 60+")
    )
    return (
        views.economics(star)
        .groupBy(band.alias("discount_band"))
        .agg(
            F.count(ROWS).alias("orders"),
            rounded(average("gross_merchandise_value"), 2).alias("aov"),
            rounded(average("contribution_margin"), 2).alias("avg_contribution_margin"),
            F.min("discount_amount").alias("least"),
        )
        .orderBy("least")
        .drop("least")
    )


# Hours of dense traffic, discount bands in q09 and segment cuts in q08.
RUSH_HOURS = (8, 9, 18, 19, 20, 21)


def late(threshold: int = LATE_AFTER_MINUTES):
    return F.col("delivery_minutes") > threshold


def q10_late_drivers(star: Star) -> DataFrame:
    return (
        star.orders.where(not_cancelled())
        .groupBy(
            "weather",
            weekend_label(F.to_date("order_ts")).alias("day_type"),
            F.when(F.hour("order_ts").isin(*RUSH_HOURS), "Rush").otherwise("Non-rush").alias("traffic_window"),
        )
        .agg(
            F.count(ROWS).alias("orders"),
            rounded(average("delivery_minutes"), 2).alias("avg_delivery_minutes"),
            rounded(rate(late()), 4).alias("late_rate"),
        )
        .orderBy(F.desc_nulls_last("late_rate"), "weather", "day_type", "traffic_window")
    )


def q11_rain_impact(star: Star) -> DataFrame:
    return (
        views.economics(star)
        .where(not_cancelled())
        .groupBy("weather")
        .agg(
            F.count(ROWS).alias("orders"),
            rounded(average("delivery_minutes"), 2).alias("avg_delivery_minutes"),
            rounded(average("estimated_delivery_cost"), 2).alias("avg_delivery_cost"),
            rounded(average("contribution_margin"), 2).alias("avg_contribution_margin"),
        )
        .orderBy(F.desc_nulls_last("avg_delivery_minutes"), "weather")
    )


def q12_cancellation_hotspots(star: Star, least_orders: int = 100) -> DataFrame:
    per_store = star.orders.groupBy("store_id").agg(
        F.count(ROWS).alias("orders"), F.count_if(is_cancelled()).alias("cancellations"),
        F.count("status").alias("known"),
    )
    return (
        per_store.join(star.stores.select("store_id", "city", "zone"), "store_id")
        .groupBy("city", "zone")
        .agg(F.sum("orders").alias("orders"), F.sum("cancellations").alias("cancellations"), F.sum("known").alias("known"))
        .where(F.col("orders") >= least_orders)
        .select(
            "city", "zone", "orders", "cancellations",
            rounded(ratio(F.col("cancellations"), F.col("known")), 4).alias("cancellation_rate"),
        )
        .orderBy(F.desc_nulls_last("cancellation_rate"), "city", "zone")
    )


def q13_experiment_funnel(star: Star) -> DataFrame:
    return views.experiment_results(star).orderBy("experiment_variant")


def session_counts(star: Star) -> DataFrame:
    """One row: sessions and conversions of both variants."""
    def seen(variant):
        return F.col("experiment_variant") == variant

    return star.sessions.agg(
        F.count_if(seen("Control")).alias("n_control"),
        F.count_if(seen("Control") & F.col("converted")).alias("x_control"),
        F.count_if(seen("Treatment")).alias("n_treatment"),
        F.count_if(seen("Treatment") & F.col("converted")).alias("x_treatment"),
    )


def q14_experiment_lift(star: Star) -> DataFrame:
    x_c, n_c, x_t, n_t = (F.col(c) for c in ("x_control", "n_control", "x_treatment", "n_treatment"))
    return session_counts(star).select(
        rounded(ratio(x_c, n_c), 4).alias("control_rate"),
        rounded(ratio(x_t, n_t), 4).alias("treatment_rate"),
        rounded(ratio(x_t, n_t) - ratio(x_c, n_c), 4).alias("absolute_lift"),
        rounded(pooled_error(x_c, n_c, x_t, n_t), 6).alias("pooled_standard_error"),
    )


def spend_and_acquired(star: Star) -> DataFrame:
    """Spend and customers acquired within the order period, per city and channel."""
    group = ["city", "acquisition_channel"]
    spend = star.marketing.groupBy(*group).agg(F.sum("spend").alias("spend"))
    first = star.orders.agg(F.to_date(F.min("order_ts"))).scalar()
    last = star.orders.agg(F.to_date(F.max("order_ts"))).scalar()
    acquired = (
        star.customers.where(F.col("signup_date").between(first, last)).groupBy(*group).agg(F.count(ROWS).alias("customers"))
    )
    return spend.join(acquired, group, "left")


def q15_cac_city_channel(star: Star) -> DataFrame:
    return (
        spend_and_acquired(star)
        .withColumn("cac", rounded(ratio(F.col("spend"), F.col("customers")), 2))
        .orderBy(F.desc_nulls_last("cac"), "city", "acquisition_channel")
    )


def q16_margin_to_cac(star: Star) -> DataFrame:
    per_customer = views.economics(star).groupBy("customer_id").agg(F.sum("contribution_margin").alias("margin"))
    value = (
        per_customer.join(star.customers.select("customer_id", "acquisition_channel"), "customer_id")
        .groupBy("acquisition_channel")
        .agg(F.count(ROWS).alias("customers"), F.sum("margin").alias("margin"))
    )
    spend = star.marketing.groupBy("acquisition_channel").agg(F.sum("spend").alias("spend"))
    margin, customers, spent = F.col("margin"), F.col("customers"), F.col("spend")
    return (
        value.join(spend, "acquisition_channel")
        .select(
            "acquisition_channel", "customers",
            rounded(ratio(margin, customers), 2).alias("margin_per_customer"),
            rounded(ratio(spent, customers), 2).alias("blended_cac"),
            rounded(ratio(margin, spent), 2).alias("margin_to_spend_ratio"),
        )
        .orderBy(F.desc_nulls_last("margin_to_spend_ratio"), "acquisition_channel")
    )


def q17_availability_loss(star: Star, top: int = 30) -> DataFrame:
    """Pairs of store and product by stockout. Inventory folds per pair first; pairs without a store
    or product fall out before the cut, so they take no place in it."""
    pairs = star.inventory.groupBy("store_id", "product_id").agg(
        F.sum("stockout_minutes").alias("stockout_minutes"), F.sum("units_sold").alias("units_sold")
    )
    return (
        pairs.join(star.stores.select("store_id", "city", "zone"), "store_id")
        .join(star.products.select("product_id", "category"), "product_id")
        .select("store_id", "city", "zone", "product_id", "category", "stockout_minutes", "units_sold")
        .orderBy(F.desc_nulls_last("stockout_minutes"), "store_id", "product_id")
        .limit(top)
    )


def q18_category_waste(star: Star) -> DataFrame:
    per_product = star.inventory.groupBy("product_id").agg(
        F.sum("units_sold").alias("units_sold"), F.sum("waste_units").alias("waste_units")
    )
    sold, waste = F.sum("units_sold"), F.sum("waste_units")
    return (
        per_product.join(star.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            sold.alias("units_sold"), waste.alias("waste_units"),
            rounded(ratio(waste, sold + waste), 4).alias("waste_rate"),
        )
        .orderBy(F.desc_nulls_last("waste_rate"), "category")
    )


def q19_weekend_stockouts(star: Star) -> DataFrame:
    return (
        star.inventory.groupBy(weekend_label(F.col("inventory_date")).alias("day_type"))
        .agg(
            F.count_if(F.col("stockout_minutes") > 0).alias("stockout_product_days"),
            rounded(average("stockout_minutes"), 2).alias("avg_stockout_minutes"),
            F.sum("units_sold").alias("units_sold"),
        )
        .orderBy("day_type")
    )


def observed_days(star: Star) -> DataFrame:
    """Orders per day on which any order was placed."""
    return star.orders.groupBy(F.to_date("order_ts").alias("order_date")).agg(F.count(ROWS).alias("orders"))


def q20_rolling_daily_orders(star: Star) -> DataFrame:
    """The windows run over one row per day; frames count rows, so missing days are not filled."""
    by_day = Window.partitionBy(F.lit(1)).orderBy("order_date")
    return (
        observed_days(star)
        .select(
            "order_date", "orders",
            rounded(F.avg("orders").over(by_day.rowsBetween(-6, 0)), 2).alias("rolling_7d"),
            (F.col("orders") - F.lag("orders", 7).over(by_day)).alias("change_vs_prior_week"),
        )
        .orderBy("order_date")
    )


def q21_weekday_baseline(star: Star) -> DataFrame:
    return (
        observed_days(star)
        .groupBy(iso_weekday(F.col("order_date")).alias("weekday"))
        .agg(
            rounded(F.avg("orders"), 1).alias("expected_orders"),
            rounded(F.stddev_samp("orders"), 1).alias("demand_stddev"),
        )
        .orderBy("weekday")
    )


def q22_payment_method(star: Star) -> DataFrame:
    return (
        views.economics(star)
        .groupBy("payment_method")
        .agg(
            F.count(ROWS).alias("orders"),
            rounded(average("gross_merchandise_value"), 2).alias("aov"),
            rounded(rate(is_cancelled()), 4).alias("cancellation_rate"),
            F.sum("contribution_margin").alias("contribution_margin"),
        )
        .orderBy(F.desc("orders"), "payment_method")
    )


def q23_margin_concentration(star: Star, small: int | None = None) -> DataFrame:
    margins = write_once(
        views.economics(star).groupBy("customer_id").agg(F.sum("contribution_margin").alias("margin")), "customer-margin"
    )
    tiled = tiles(margins, {"value_quintile": ([Key("margin", descending=True), "customer_id"], 5, "ntile")}, small)
    grouped = tiled.groupBy("value_quintile").agg(
        F.count(ROWS).alias("customers"), F.sum("margin").alias("contribution_margin")
    )
    total = F.sum("contribution_margin").over(Window.partitionBy(F.lit(1)))
    return grouped.withColumn("margin_share", rounded(ratio(F.col("contribution_margin"), total), 4)).orderBy("value_quintile")


def q24_category_refunds(star: Star) -> DataFrame:
    """Refunded value by category, each refund shared out by line value.

    Lines of refunded orders are kept by a semi join, whose line side AQE may split, and fold to one
    row per order and product before they meet the order: the catalogue bounds what one order then
    holds. Categories without refunds come from the products of lines that have an order.
    """
    refunded = star.orders.where(F.col("status") == "Refunded").select(
        "order_id",
        F.col("refund_amount").cast("double").alias("refund"),
        F.col("gross_merchandise_value").cast("double").alias("value"),
    )
    category = star.products.select("product_id", "category")
    line_cents = F.sum(F.col("quantity").cast("bigint") * cents("unit_selling_price"))
    shared = (
        star.order_items.join(refunded.select("order_id"), "order_id", "left_semi")
        .groupBy("order_id", "product_id")
        .agg((line_cents / F.lit(100.0)).alias("line_value"))
        .join(refunded, "order_id")
        .withColumn("allocated", F.col("refund") * F.col("line_value") / F.nullif(F.col("value"), F.lit(0.0)))
        .join(category, "product_id")
        .groupBy("category")
        .agg(F.count_distinct("order_id").alias("refunded_orders"), F.sum("allocated").alias("allocated"))
    )
    placed = star.order_items.select("order_id", "product_id").join(star.orders.select("order_id"), "order_id", "left_semi")
    sold = placed.select("product_id").distinct().join(category, "product_id").select("category").distinct()
    return (
        sold.join(shared, "category", "left")
        .select(
            "category",
            F.coalesce("refunded_orders", F.lit(0)).alias("refunded_orders"),
            rounded(F.col("allocated"), 2).alias("allocated_refund_value"),
        )
        .orderBy(F.desc_nulls_last("allocated_refund_value"), "category")
    )


def q25_store_week_exceptions(star: Star, small: int | None = None) -> DataFrame:
    weeks = write_once(
        views.economics(star)
        .groupBy(week_start("order_ts").alias("week_start"), "store_id")
        .agg(
            F.count(ROWS).alias("orders"),
            rate(is_cancelled()).alias("cancellation_rate"),
            rate(F.when(not_cancelled(), late())).alias("late_rate"),
            F.sum("contribution_margin").alias("contribution_margin"),
        ),
        "store-weeks",
    )
    limit = percentiles(
        weeks, {"cancellation_rate": 0.75, "late_rate": 0.75, "contribution_margin": 0.25},
        ["week_start", "store_id"], small,
    )
    flagged = (
        (F.col("cancellation_rate") >= limit["cancellation_rate"])
        | (F.col("late_rate") >= limit["late_rate"])
        | (F.col("contribution_margin").cast("double") <= limit["contribution_margin"])
    )
    return weeks.where(flagged).orderBy(F.desc("week_start"), F.asc_nulls_last("contribution_margin"), "store_id")
