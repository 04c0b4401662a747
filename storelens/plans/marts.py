"""KPI marts, experiment statistics, forecast inputs and the facts of the executive memo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions.columns import (
    CANCELLED, LATE, ON_TIME, REFUNDED, average, is_cancelled, not_cancelled, rate, ratio, rounded, span_days,
)
from storelens.operators.calendar import fill_days
from storelens.operators.forecast import demand_forecast as forecast_days
from storelens.operators.ranks import tiles
from storelens.operators.significance import two_proportion_test
from storelens.plans import business, views
from storelens.session import write_once
from storelens.sources.star import Star

ROWS = "*"
# RFM score bands (right-closed upper ends) and the order of service groups in charts.
RFM_BANDS = ((5, "At Risk"), (8, "Needs Attention"), (11, "Loyal"), (15, "Champions"))
SERVICE_ORDER = (ON_TIME, LATE, REFUNDED, CANCELLED)
# The two decisions the memo states.
LAUNCH, HOLD = "launch the treatment with monitoring", "do not launch the treatment yet"


def _service_columns() -> dict[str, Column]:
    """Delivery figures; ``on_time_rate`` leaves cancelled orders out, ``on_time_rate_all`` counts
    them as not on time."""
    return {
        "avg_delivery_minutes": average("delivery_minutes"),
        "on_time_rate": rate(F.when(not_cancelled(), F.col("is_on_time"))),
        "on_time_rate_all": rate(F.col("is_on_time")),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def _money_columns() -> dict[str, Column]:
    return {
        "gmv": F.sum("gross_merchandise_value"),
        "net_revenue": F.sum("net_revenue"),
        "contribution_margin": F.sum("contribution_margin"),
    }


def store_kpis(star: Star) -> DataFrame:
    """Customers per store are counted apart, from pairs of ids: beside the sums, every sum would
    travel once per pair."""
    priced = views.economics(star)
    sums = priced.groupBy("store_id").agg(
        F.count(ROWS).alias("orders"), *_named(_money_columns()), *_named(_service_columns()),
        rate(is_cancelled()).alias("cancellation_rate"),
    )
    customers = priced.select("store_id", "customer_id").distinct().groupBy("store_id").agg(F.count("customer_id").alias("customers"))
    return (
        sums.join(customers, "store_id").join(star.stores.select("store_id", "city", "zone"), "store_id")
        .select("store_id", "orders", "customers", *[c for c in sums.columns if c not in ("store_id", "orders")], "city", "zone")
        .withColumn("margin_rate", ratio(F.col("contribution_margin"), F.col("net_revenue")))
    )


def rfm_customers(star: Star, small: int | None = None) -> DataFrame:
    """Recency, frequency and monetary scores per customer, cut at quantiles of their ranks.

    Equal values rank by customer id. Recency counts whole days to one day after the last order of
    any status.
    """
    reference_time = star.orders.agg(F.max("order_ts") + F.expr("interval '1' day")).scalar()
    value = write_once(
        views.economics(star)
        .where(not_cancelled())
        .groupBy("customer_id")
        .agg(
            F.min("order_ts").alias("first_order"),
            F.max("order_ts").alias("last_order"),
            F.count(ROWS).alias("frequency"),
            F.sum("net_revenue").alias("monetary"),
            F.sum("contribution_margin").alias("contribution_margin"),
        )
        .withColumn("recency_days", span_days(reference_time, F.col("last_order"))),
        "customer-rfm",
    )
    by = {"r_score": "recency_days", "f_score": "frequency", "m_score": "monetary"}
    scored = tiles(value, {score: ([name, "customer_id"], 5, "qcut") for score, name in by.items()}, small)
    scored = scored.withColumn("r_score", 6 - F.col("r_score")).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    segment = F.lit(None).cast("string")
    for upper, label in reversed(RFM_BANDS):
        segment = F.when(F.col("rfm_score") <= upper, label).otherwise(segment)
    return scored.withColumn("segment", segment)


def retention_by_service(star: Star) -> DataFrame:
    return business.service_retention(star)


def cohort_matrix(star: Star, indexes: list[int] | None = None) -> DataFrame:
    """Retention per first-order month, one column per month since; 0 where nobody was active.

    Without ``indexes`` the columns run from 0 to the span of the order period in months.
    """
    if indexes is None:
        period = star.orders.where(not_cancelled()).agg(F.min("order_ts").alias("a"), F.max("order_ts").alias("b")).first()
        months = 0 if period["a"] is None else (period["b"].year - period["a"].year) * 12 + period["b"].month - period["a"].month
        indexes = list(range(months + 1))
    share = ratio(F.col("active_customers"), F.col("cohort_size"))
    wide = (
        business.cohort_counts(star)
        .select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"), "month_number", share.alias("share"))
        .groupBy("cohort_month")
        .pivot("month_number", indexes)
        .agg(F.max("share"))
    )
    return wide.na.fill(0.0)


def _variant_sessions(star: Star) -> DataFrame:
    return star.sessions.groupBy("experiment_variant").agg(
        F.count(ROWS).alias("sessions"),
        F.count_if("converted").alias("conversions"),
        rate(F.col("viewed_product")).alias("view_rate"),
        rate(F.col("added_to_cart")).alias("add_to_cart_rate"),
        rate(F.col("checkout_started")).alias("checkout_rate"),
        rate(F.col("converted")).alias("conversion_rate"),
    )


def _variant_economics(star: Star) -> DataFrame:
    return views.economics(star).groupBy("experiment_variant").agg(
        F.sum("contribution_margin").alias("conversion_contribution_margin"),
        average("contribution_margin").alias("avg_margin_per_conversion"),
        average("discount_amount").alias("avg_discount_per_conversion"),
    )


def _of(variant: str, name: str) -> Column:
    """The value of ``name`` on the row of one variant, seen from every row (one row per variant)."""
    return F.max(F.when(F.col("experiment_variant") == variant, F.col(name))).over(Window.partitionBy(F.lit(1)))


def experiment_summary(star: Star, with_p_value: bool = True) -> DataFrame:
    lifted = _variant_sessions(star).withColumn(
        "absolute_lift_vs_control", F.col("conversion_rate") - _of("Control", "conversion_rate")
    )
    if with_p_value:
        counts = lifted
        for variant in ("Control", "Treatment"):
            for name in ("conversions", "sessions"):
                counts = counts.withColumn(f"_{variant}_{name}", _of(variant, name))
        _, p = two_proportion_test(
            F.col("_Control_conversions"), F.col("_Control_sessions"),
            F.col("_Treatment_conversions"), F.col("_Treatment_sessions"),
        )
        lifted = counts.withColumn("p_value", p).select(*lifted.columns, "p_value")
    return lifted.join(_variant_economics(star), "experiment_variant").withColumn(
        "contribution_margin_per_session", ratio(F.col("conversion_contribution_margin"), F.col("sessions"))
    )


def experiment_significance(star: Star) -> DataFrame:
    """One row: z score and two-sided p-value of Treatment over Control."""
    z, p = two_proportion_test(*(F.col(c) for c in ("x_control", "n_control", "x_treatment", "n_treatment")))
    return business.session_counts(star).select("*", z.alias("z_score"), p.alias("p_value"))


def product_kpis(star: Star) -> DataFrame:
    return views.product_kpis(star, tier=True)


def daily_store(star: Star) -> DataFrame:
    return (
        views.economics(star)
        .groupBy(F.to_date("order_ts").alias("order_date"), "store_id")
        .agg(F.count(ROWS).alias("orders"), *_named(_money_columns()), *_named(_service_columns()))
    )


def daily_orders_calendar(star: Star) -> DataFrame:
    """Orders with lines per calendar day, days without any as zero."""
    daily = (
        views.economics(star).groupBy(F.to_date("order_ts").alias("order_date")).agg(F.count(ROWS).alias("orders"))
    )
    return fill_days(daily, "order_date", "orders")


def demand_forecast(star: Star, horizon: int = 28) -> DataFrame:
    return forecast_days(daily_orders_calendar(star), "order_date", "orders", horizon)


def channel_cac(star: Star) -> DataFrame:
    return (
        business.spend_and_acquired(star)
        .withColumnRenamed("customers", "acquired_customers")
        .withColumn("cac", ratio(F.col("spend"), F.col("acquired_customers")))
    )


def _inventory_sums(star: Star, key: str) -> DataFrame:
    names = ("units_sold", "waste_units", "stockout_minutes")
    return star.inventory.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])


def inventory_product_kpis(star: Star) -> DataFrame:
    return (
        _inventory_sums(star, "product_id")
        .join(star.products.select("product_id", "category", "subcategory"), "product_id")
        .withColumn("waste_rate", ratio(F.col("waste_units"), F.col("units_sold") + F.col("waste_units")))
    )


def inventory_store_kpis(star: Star) -> DataFrame:
    return _inventory_sums(star, "store_id").join(star.stores.select("store_id", "city", "zone"), "store_id")


def _order_sums() -> list[Column]:
    """Sums and counts of order-side figures that add up over any groups.

    Orders count every order; money and service count orders with lines.
    """
    with_lines = F.col("units").isNotNull()
    served = with_lines & not_cancelled()

    def total(name: str, condition: Column = with_lines) -> Column:
        return F.sum(F.when(condition, F.col(name)))

    return [
        F.count(ROWS).alias("orders"), total("gross_merchandise_value").alias("gmv"), total("net_revenue").alias("net_revenue"),
        total("contribution_margin").alias("contribution_margin"), F.count_if(with_lines).alias("with_lines"),
        F.count_if(is_cancelled()).alias("cancelled"), F.count("status").alias("known"),
        F.count_if(served & F.col("is_on_time")).alias("on_time"), F.count_if(served).alias("served"),
        *[
            total("contribution_margin", with_lines & (F.col("experiment_variant") == v)).alias(f"{v.lower()}_margin")
            for v in ("Control", "Treatment")
        ],
    ]


def _headline_columns() -> list[Column]:
    return [
        F.col("orders"), F.col("gmv"), F.col("net_revenue"), F.col("contribution_margin"),
        ratio(F.col("cancelled"), F.col("known")).alias("cancellation_rate"),
        ratio(F.col("on_time"), F.col("served")).alias("on_time_rate"), F.col("control_margin"), F.col("treatment_margin"),
    ]


def _customer_count(star: Star) -> DataFrame:
    """Customers are counted apart, from their ids alone: beside the sums, every sum would travel per customer."""
    return star.orders.agg(F.count_distinct("customer_id").alias("customers"))


def _headline(star: Star) -> DataFrame:
    """One row of order-side figures."""
    sums = views.with_economics(star.orders_with_totals).agg(*_order_sums()).select(*_headline_columns())
    return _beside(sums, _customer_count(star))


def _beside(df: DataFrame, *one_rows: DataFrame) -> DataFrame:
    """A one-row table widened by other one-row tables, each read as a scalar subquery."""
    for number, other in enumerate(one_rows):
        name = f"_side{number}"
        df = df.select("*", other.select(F.struct("*")).scalar().alias(name)).select(
            "*", *[F.col(f"{name}.{c}") for c in other.columns]
        ).drop(name)
    return df


def _with_sessions(headline: DataFrame, star: Star) -> DataFrame:
    """Order and session figures side by side, with the test of the two conversion rates."""
    z, p = two_proportion_test(*(F.col(c) for c in ("x_control", "n_control", "x_treatment", "n_treatment")))
    return _beside(headline, business.session_counts(star)).select("*", z.alias("z_score"), p.alias("p_value"))


def _headline_with_sessions(star: Star) -> DataFrame:
    return _with_sessions(_headline(star), star)


def _conversion(variant: str) -> Column:
    return ratio(F.col(f"x_{variant}"), F.col(f"n_{variant}"))


def _margin_per_session(variant: str) -> Column:
    return ratio(F.col(f"{variant}_margin"), F.col(f"n_{variant}"))


def executive_kpis(star: Star) -> DataFrame:
    return _headline_with_sessions(star).select(
        "orders", "customers", "gmv", "net_revenue", "contribution_margin",
        rounded(ratio(F.col("contribution_margin"), F.col("net_revenue")), 4).alias("contribution_margin_rate"),
        rounded(F.col("cancellation_rate"), 4).alias("cancellation_rate"),
        rounded(F.col("on_time_rate"), 4).alias("on_time_rate"),
        rounded(_conversion("control"), 4).alias("control_conversion_rate"),
        rounded(_conversion("treatment"), 4).alias("treatment_conversion_rate"),
        rounded(_conversion("treatment") - _conversion("control"), 4).alias("experiment_absolute_lift"),
        rounded(F.col("z_score"), 3).alias("experiment_z_score"),
        F.col("p_value").alias("experiment_p_value"),
        rounded(_margin_per_session("control"), 2).alias("control_margin_per_session"),
        rounded(_margin_per_session("treatment"), 2).alias("treatment_margin_per_session"),
    )


def _launches() -> Column:
    """Launch on a significant test and a positive margin lift per session; otherwise hold."""
    lift = _margin_per_session("treatment") - _margin_per_session("control")
    return F.coalesce((F.col("p_value") < 0.05) & (lift > 0), F.lit(False))


def launch_decision(star: Star) -> DataFrame:
    return _headline_with_sessions(star).select(
        "p_value",
        (_margin_per_session("treatment") - _margin_per_session("control")).alias("margin_per_session_lift"),
        _launches().alias("launch"),
        F.when(_launches(), LAUNCH).otherwise(HOLD).alias("decision"),
    )


def weakest_stores(star: Star, top: int = 10) -> DataFrame:
    """The stores of lowest contribution margin, weakest first."""
    return (
        views.economics(star)
        .groupBy("store_id")
        .agg(F.sum("contribution_margin").alias("contribution_margin"))
        .join(star.stores.select("store_id", "city", "zone"), "store_id")
        .orderBy(F.asc_nulls_last("contribution_margin"), "store_id")
        .limit(top)
    )


def executive_memo_facts(star: Star) -> DataFrame:
    """One row with every figure the memo states.

    Orders fold once per store; headline and weakest store both come from those rows.
    """
    repeat = retention_by_service(star).agg(
        *[
            F.max(F.when(F.col("service_group") == group, F.col("repeat_30d_rate"))).alias(name)
            for group, name in ((ON_TIME, "on_time_repeat_rate"), (LATE, "late_repeat_rate"))
        ]
    )
    per_store = views.with_economics(star.orders_with_totals).groupBy("store_id").agg(*_order_sums())
    places = star.stores.select(F.col("store_id").alias("_store"), "zone", "city")
    placed = per_store.join(places, F.col("store_id") == F.col("_store"), "left")
    # A store takes part if it is known and has an order with lines; unknown margins come last.
    judged = F.col("_store").isNotNull() & (F.col("with_lines") > 0)
    margin = F.col("contribution_margin")
    weakest = F.min_by(
        F.struct(F.col("store_id").alias("store_id"), F.col("zone"), F.col("city"), margin.alias("margin")),
        F.when(judged, F.struct(margin.isNull(), margin, F.col("store_id"))),
    )
    names = ["orders", "gmv", "net_revenue", "contribution_margin", "cancelled", "known", "on_time", "served", "control_margin", "treatment_margin"]
    folded = placed.agg(*[F.sum(n).alias(n) for n in names], weakest.alias("weakest")).select(
        *_headline_columns(), F.col("weakest.store_id").alias("weakest_store_id"), F.col("weakest.zone").alias("weakest_zone"),
        F.col("weakest.city").alias("weakest_city"), F.col("weakest.margin").alias("weakest_margin"),
    )
    facts = _beside(_with_sessions(_beside(folded, _customer_count(star)), star), repeat)
    return facts.select(
        "orders", "customers", "contribution_margin",
        ratio(F.col("contribution_margin"), F.col("net_revenue")).alias("margin_rate"),
        "on_time_repeat_rate", "late_repeat_rate",
        (F.col("on_time_repeat_rate") - F.col("late_repeat_rate")).alias("repeat_gap"),
        _conversion("treatment").alias("treatment_conversion_rate"),
        _conversion("control").alias("control_conversion_rate"),
        "p_value",
        _margin_per_session("treatment").alias("treatment_margin_per_session"),
        _margin_per_session("control").alias("control_margin_per_session"),
        "weakest_store_id", "weakest_zone", "weakest_city", "weakest_margin",
        F.when(_launches(), LAUNCH).otherwise(HOLD).alias("decision"),
    )


def chart_service_groups(star: Star) -> DataFrame:
    """The four service groups in their fixed order; a group without orders has null figures."""
    order = star.spark.createDataFrame([(i, g) for i, g in enumerate(SERVICE_ORDER)], "position int, service_group string")
    return order.join(retention_by_service(star), "service_group", "left").orderBy("position")


def chart_demand_series(star: Star, horizon: int = 28) -> DataFrame:
    """Actual days followed by forecast days, in one series."""
    daily = daily_orders_calendar(star)
    empty = F.lit(None).cast("double")
    actual = daily.select(
        F.lit("Actual").alias("series"), F.col("order_date").alias("day"), F.col("orders").cast("double").alias("orders"),
        empty.alias("lower_95"), empty.alias("upper_95"),
    )
    ahead = forecast_days(daily, "order_date", "orders", horizon).select(
        F.lit("Forecast").alias("series"), F.col("forecast_date").alias("day"), F.col("forecast_orders").alias("orders"),
        "lower_95", "upper_95",
    )
    return actual.unionByName(ahead)


def units_sold_rollup(star: Star) -> DataFrame:
    """Units per day, store and product from realised order lines beside the inventory's figure."""
    group = ["inventory_date", "store_id", "product_id"]
    kept = star.orders.where(not_cancelled()).select("order_id", "store_id", F.to_date("order_ts").alias("inventory_date"))
    sold = (
        star.order_items.select("order_id", "product_id", "quantity")
        .join(kept, "order_id")
        .groupBy(*group)
        .agg(F.sum("quantity").alias("units_ordered"))
    )
    booked = star.inventory.select(*group, F.col("units_sold").cast("bigint").alias("units_booked"))
    ordered, stocked = F.coalesce("units_ordered", F.lit(0)), F.coalesce("units_booked", F.lit(0))
    return sold.join(booked, group, "full").withColumn("difference", ordered - stocked)
