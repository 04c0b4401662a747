import datetime as dt
from decimal import Decimal as D

import pytest

from storelens.plans import measures


@pytest.fixture(scope="module")
def star(make_star):
    return make_star(
        customers=[dict(customer_id="c1", is_prime=True), dict(customer_id="c2", city="South")],
        stores=[dict(store_id="s1"), dict(store_id="s2", city="South")],
        products=[dict(product_id="p1"), dict(product_id="p2", category="Drink")],
        orders=[
            dict(order_id="a", order_ts=dt.datetime(2025, 1, 5)),
            dict(order_id="b", order_ts=dt.datetime(2025, 2, 5), delivery_minutes=D("40")),
            dict(order_id="c", order_ts=dt.datetime(2025, 4, 5), customer_id="c2", store_id="s2"),
            dict(order_id="d", order_ts=dt.datetime(2025, 4, 6), customer_id="c2", status="Cancelled", delivery_minutes=None),
            dict(order_id="e", order_ts=dt.datetime(2025, 4, 7), store_id="nowhere"),
        ],
        items=[dict(order_id="a"), dict(order_id="b", product_id="p2"), dict(order_id="c"), dict(order_id="d")],
        sessions=[dict(session_id="1", converted=True, added_to_cart=True), dict(session_id="2"), dict(session_id="3", customer_id="c9")],
        inventory=[dict(stockout_minutes=90), dict(product_id="p2", units_sold=0, waste_units=0)],
    )


def test_totals_need_no_grouping(star):
    row = measures.measure(star, ["orders", "cancelled_orders", "customers", "realized_gmv", "aov", "contribution_margin", "on_time_rate",
                                  "average_delivery_minutes"]).first()
    assert (row["orders"], row["cancelled_orders"], row["customers"]) == (5, 1, 2)
    assert row["realized_gmv"] == D("400") and row["aov"] == 100.0
    # The order without lines earns revenue and has no goods cost here.
    assert row["contribution_margin"] == D("400") - D("180") - D("50")
    assert row["on_time_rate"] == 0.75 and row["average_delivery_minutes"] == 25.0


def test_grouped_and_filtered(star):
    rows = measures.measure(star, "orders", by=["stores.city"]).collect()
    assert {r["stores_city"]: r["orders"] for r in rows} == {"North": 3, "South": 1, None: 1}
    prime = measures.measure(star, "orders", by=["date.year_month"], where={"customers.is_prime": True, "status": ["Delivered"]}).collect()
    assert {r["date_year_month"]: r["orders"] for r in prime} == {"2025-01": 1, "2025-02": 1, "2025-04": 1}


def test_facts_join_on_their_groups(star):
    rows = {r["customers_city"]: r for r in measures.measure(star, ["conversion_rate", "orders"], by=["customers.city"]).collect()}
    assert rows["North"]["conversion_rate"] == 0.5 and rows["North"]["orders"] == 3
    assert rows["South"]["conversion_rate"] is None and rows[None]["orders"] is None


def test_zero_denominator_is_null(star):
    rows = {r["products_category"]: r for r in measures.measure(star, ["waste_rate", "stockout_hours"], by=["products.category"]).collect()}
    assert rows["Food"]["waste_rate"] == 0.2 and rows["Food"]["stockout_hours"] == 1.5
    assert rows["Drink"]["waste_rate"] is None


def test_cost_by_product(star):
    rows = {r["products_category"]: r["line_cogs"] for r in measures.measure(star, "line_cogs", by=["products.category"]).collect()}
    assert rows == {"Food": D("120"), "Drink": D("60")}


def test_unrelated_dimension_is_an_error(star):
    with pytest.raises(ValueError):
        measures.measure(star, "orders", by=["products.category"])
    with pytest.raises(ValueError):
        measures.measure(star, "sessions", by=["stores.city"])


def test_repeat_customers(star):
    row = measures.repeat_customers(star).first()
    assert (row["customers"], row["repeat_customers"], row["repeat_customer_rate"]) == (2, 2, 1.0)
    by_city = {r["stores_city"]: r["repeat_customers"] for r in measures.repeat_customers(star, by=["stores.city"]).collect()}
    assert by_city == {"North": 1, "South": 0, None: 0}


def test_previous_month_is_by_calendar(star):
    rows = {r["month"].month: r for r in measures.gmv_month_over_month(star).collect()}
    assert rows[2]["realized_gmv_previous_month"] == D("100") and rows[2]["gmv_mom_pct"] == 0.0
    assert rows[4]["realized_gmv_previous_month"] is None and rows[4]["gmv_mom_pct"] is None
    grouped = measures.gmv_month_over_month(star, by=["customers.city"]).collect()
    assert {(r["customers_city"], r["month"].month) for r in grouped} == {("North", 1), ("North", 2), ("North", 4), ("South", 4)}


def test_row_access(star, spark):
    access = spark.createDataFrame([("ann@example.com", "South"), ("ann@example.com", "South"), ("bob@example.com", "North")], "email string, city string")
    assert [r["store_id"] for r in measures.row_access(star.stores, access, "ann@example.com").collect()] == ["s2"]
    assert measures.row_access(star.stores, access, "eve@example.com").count() == 0


def test_month_before_is_not_filtered_away(star):
    rows = measures.gmv_month_over_month(star, where={"date.year_month": "2025-02"}).collect()
    assert [(r["month"], r["realized_gmv"], r["realized_gmv_previous_month"]) for r in rows] == [(dt.date(2025, 2, 1), D("100"), D("100"))]
    days = measures.gmv_month_over_month(star, where={"date.date": measures.Between(dt.date(2025, 2, 6), None)}).collect()
    assert [(r["month"], r["realized_gmv"], r["realized_gmv_previous_month"]) for r in days] == [(dt.date(2025, 4, 1), D("200"), None)]


def test_the_last_days_of_a_longer_month_count_for_the_next(make_star):
    star = make_star(orders=[dict(order_id="a", order_ts=dt.datetime(2025, 1, 31, 23)), dict(order_id="b", order_ts=dt.datetime(2025, 2, 1))])
    row = measures.gmv_month_over_month(star, where={"date.date": measures.Between(dt.date(2025, 2, 1), dt.date(2025, 2, 28))}).first()
    assert row["realized_gmv_previous_month"] == D("100")


def test_a_repeated_id_counts_once(make_star):
    star = make_star(
        orders=[dict(order_id="a"), dict(order_id="a"), dict(order_id="b", status="Cancelled", delivery_minutes=None)],
        sessions=[dict(session_id="1", converted=True), dict(session_id="1", converted=True), dict(session_id="2")],
    )
    row = measures.measure(star, ["orders", "delivered_orders", "cancelled_orders", "on_time_orders", "cancellation_rate"]).first()
    assert tuple(row) == (2, 1, 1, 1, 0.5)
    assert tuple(measures.measure(star, ["sessions", "conversions", "conversion_rate"]).first()) == (2, 1, 0.5)


def test_ranges_lists_and_values_filter(star):
    def orders(where):
        return measures.measure(star, "orders", where=where).first()["orders"]

    between = measures.Between
    assert orders({"date.date": between(dt.date(2025, 2, 5), dt.date(2025, 4, 5))}) == 2
    assert orders({"date.year_month": between("2025-02", "2025-04")}) == 4
    assert orders({"date.year_month": ["2025-01", "2025-04"]}) == 4
    assert orders({"date.year": 2025, "delivery_minutes": between(None, D("30"))}) == 3
    assert orders({"date.date": dt.date(2025, 4, 7), "stores.city": "North"}) == 0
    assert orders({"date.weekday": "Sun", "customers.is_prime": True}) == 1


def test_dimension_filters_stand_below_the_line_join(star):
    plan = measures.measure(star, "contribution_margin", by=["date.year_month"], where={"customers.is_prime": True})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("LeftOuter") < text.index("LeftSemi")
