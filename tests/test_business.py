"""Hand-made rows for the corners that the generated tables do not reach."""

import datetime as dt
from decimal import Decimal as D

import pytest

from storelens.plans import business, marts, views


def day(n, hour=10):
    return dt.datetime(2025, 3, 1, hour) + dt.timedelta(days=n)


def test_economics_by_status(make_star):
    star = make_star(
        orders=[
            dict(order_id="kept", discount_amount=D("5"), delivery_fee=D("3"), packaging_fee=D("2")),
            dict(order_id="back", status="Refunded", refund_amount=D("60")),
            dict(order_id="lost", status="Cancelled", delivery_minutes=None),
            dict(order_id="bare"),
        ],
        items=[dict(order_id=o) for o in ("kept", "back", "lost")],
    )
    rows = {r["order_id"]: r for r in views.order_economics(star).collect()}
    assert set(rows) == {"kept", "back", "lost"}
    assert (rows["kept"]["net_revenue"], rows["kept"]["contribution_margin"]) == (D("100"), D("30"))
    assert (rows["back"]["net_revenue"], rows["back"]["contribution_margin"]) == (D("40"), D("-30"))
    assert (rows["lost"]["net_revenue"], rows["lost"]["contribution_margin"]) == (D("0"), D("-10"))
    assert rows["lost"]["is_on_time"] is False and rows["lost"]["cogs"] == D("60")
    assert marts.executive_kpis(star).first()["orders"] == 4
    assert business.q01_exec_snapshot(star).first()["orders"] == 3


def test_many_lines_do_not_repeat_the_order(make_star):
    star = make_star(items=[dict(order_id="o1", quantity=5), dict(order_id="o1", quantity=5)])
    row = views.order_economics(star).first()
    assert (row["units"], row["contribution_margin"]) == (10, D("30"))


def test_sequence_ties_edges_and_thirty_days(make_star):
    star = make_star(
        orders=[
            dict(order_id="a", order_ts=day(0)),
            dict(order_id="b", order_ts=day(0)),
            dict(order_id="c", order_ts=day(30)),
            dict(order_id="d", order_ts=day(60) + dt.timedelta(seconds=1)),
            dict(order_id="e", customer_id="c2", order_ts=day(1), status="Cancelled"),
            dict(order_id="f", customer_id="c2", order_ts=day(2)),
        ]
    )
    rows = {r["order_id"]: r for r in views.customer_order_sequence(star).collect()}
    assert rows["a"]["next_order_ts"] == day(0) and rows["b"]["next_order_ts"] == day(30)
    assert [rows[o]["repeated_within_30d"] for o in "abcdef"] == [True, True, False, False, True, False]
    assert rows["d"]["next_order_ts"] is None


def test_service_groups(make_star):
    star = make_star(
        orders=[
            dict(order_id="a", delivery_minutes=D("35"), order_ts=day(0)),
            dict(order_id="b", customer_id="c2", delivery_minutes=D("35.01"), order_ts=day(0)),
            dict(order_id="c", customer_id="c3", delivery_minutes=None, order_ts=day(0)),
            dict(order_id="d", customer_id="c4", order_ts=day(30)),
            dict(order_id="e", customer_id="c5", order_ts=day(31)),
        ]
    )
    got = {r["service_group"]: r["eligible_orders"] for r in business.q06_service_repeat(star).collect()}
    assert got == {"On time (<=35m)": 2, "Late (>35m)": 1}
    chart = marts.chart_service_groups(star).collect()
    assert [r["service_group"] for r in chart] == list(marts.SERVICE_ORDER)
    assert chart[2]["repeat_30d_rate"] is None


def test_retention_starts_at_one(make_star):
    star = make_star(
        orders=[dict(order_id=f"{c}{m}", customer_id=c, order_ts=dt.datetime(2025, m, 5)) for c, m in
                [("x", 1), ("x", 3), ("y", 1), ("y", 2), ("z", 2), ("z", 12)]]
    )
    long = {(r["cohort_month"].month, r["month_number"]): r["retention_rate"] for r in business.q07_cohort_retention(star).collect()}
    assert long == {(1, 0): 1.0, (1, 1): 0.5, (1, 2): 0.5, (2, 0): 1.0, (2, 10): 1.0}
    wide = {r["cohort_month"]: r for r in marts.cohort_matrix(star).collect()}
    assert [wide["2025-01"][str(i)] for i in range(12)] == [1.0, 0.5, 0.5] + [0.0] * 9


def test_hotspots_need_volume(make_star):
    orders = [dict(order_id=f"a{i}", status="Cancelled" if i < 10 else "Delivered") for i in range(100)]
    orders += [dict(order_id=f"b{i}", store_id="s2", status="Cancelled") for i in range(99)]
    star = make_star(stores=[dict(store_id="s1"), dict(store_id="s2", zone="Hill")], orders=orders)
    assert [tuple(r) for r in business.q12_cancellation_hotspots(star).collect()] == [("North", "Dock", 100, 10, 0.1)]


def test_acquisition_without_spend_or_customers(make_star):
    star = make_star(
        customers=[dict(customer_id="c1", signup_date=dt.date(2025, 3, 1)), dict(customer_id="c2", acquisition_channel="Friends")],
        orders=[dict(order_id="o1"), dict(order_id="o2", customer_id="c2", order_ts=day(5))],
        marketing=[dict(), dict(acquisition_channel="Friends", spend=D("0")), dict(city="South", acquisition_channel="Radio")],
    )
    cac = {(r["city"], r["acquisition_channel"]): (r["customers"], r["cac"]) for r in business.q15_cac_city_channel(star).collect()}
    # The second customer signed up before the first order.
    assert cac == {("North", "Search"): (1, 50.0), ("North", "Friends"): (None, None), ("South", "Radio"): (None, None)}
    rows = business.q16_margin_to_cac(star).collect()
    assert [(r["acquisition_channel"], r["margin_to_spend_ratio"]) for r in rows] == [("Search", 0.6), ("Friends", None)]


def test_one_variant_only(make_star):
    star = make_star(sessions=[dict(session_id="a", converted=True), dict(session_id="b")])
    row = business.q14_experiment_lift(star).first()
    assert row["control_rate"] == 0.5
    assert row["treatment_rate"] is None and row["absolute_lift"] is None and row["pooled_standard_error"] is None
    assert marts.launch_decision(star).first()["launch"] is False


def test_launch_needs_significance_and_margin(make_star):
    def sessions(variant, n, x):
        return [dict(session_id=f"{variant}{i}", experiment_variant=variant, converted=i < x) for i in range(n)]

    def star(treatment_value):
        return make_star(
            orders=[dict(order_id="c"), dict(order_id="t", experiment_variant="Treatment", gross_merchandise_value=treatment_value)],
            sessions=sessions("Control", 300, 30) + sessions("Treatment", 300, 90),
        )

    assert marts.launch_decision(star(D("120"))).first()["decision"] == marts.LAUNCH
    assert marts.launch_decision(star(D("80"))).first()["decision"] == marts.HOLD


def test_rolling_days_count_rows(make_star):
    days = [0, 1, 2, 3, 4, 5, 6, 9]
    star = make_star(orders=[dict(order_id=f"{d}-{i}", order_ts=day(d)) for d in days for i in range(d + 1)])
    rows = business.q20_rolling_daily_orders(star).collect()
    assert [r["orders"] for r in rows] == [d + 1 for d in days]
    assert rows[7]["rolling_7d"] == round((2 + 3 + 4 + 5 + 6 + 7 + 10) / 7, 2)
    assert rows[7]["change_vs_prior_week"] == 9 and rows[6]["change_vs_prior_week"] is None
    filled = marts.daily_orders_calendar(star).orderBy("order_date").collect()
    assert [r["orders"] for r in filled] == [1, 2, 3, 4, 5, 6, 7, 0, 0, 10]


def test_refunds_allocate_by_line_value(make_star):
    star = make_star(
        products=[dict(product_id="p1"), dict(product_id="p2", category="Drink"), dict(product_id="p3", category="Home")],
        orders=[dict(order_id="r", status="Refunded", refund_amount=D("50")), dict(order_id="k"),
                dict(order_id="z", status="Refunded", gross_merchandise_value=D("0"), refund_amount=D("5"))],
        items=[dict(order_id="r", quantity=6), dict(order_id="r", product_id="p2", quantity=4), dict(order_id="k", product_id="p3"),
               dict(order_id="z", product_id="p2")],
    )
    got = {r["category"]: (r["refunded_orders"], r["allocated_refund_value"]) for r in business.q24_category_refunds(star).collect()}
    assert got == {"Food": (1, 30.0), "Drink": (2, 20.0), "Home": (0, None)}


@pytest.mark.parametrize("small", [None, 3])
def test_store_week_exceptions(make_star, small):
    """Eight quiet weeks of one store, one with cancellations, one late, one of low margin, one without late rate."""
    orders = []
    for week in range(8):
        orders += [dict(order_id=f"w{week}-{i}", order_ts=day(2 + 7 * week)) for i in range(10)]
    orders += [dict(order_id=f"x{i}", store_id="s2", order_ts=day(2), status="Cancelled" if i < 5 else "Delivered") for i in range(10)]
    orders += [dict(order_id=f"y{i}", store_id="s3", order_ts=day(2), delivery_minutes=D("50")) for i in range(20)]
    orders += [dict(order_id=f"z{i}", store_id="s4", order_ts=day(2)) for i in range(2)]
    orders += [dict(order_id="n0", store_id="s5", order_ts=day(2), status="Cancelled", delivery_minutes=None)]
    star = make_star(orders=orders)
    rows = business.q25_store_week_exceptions(star, small=small).collect()
    flagged = {r["store_id"] for r in rows}
    assert {"s2", "s3", "s4", "s5"} <= flagged
    assert next(r for r in rows if r["store_id"] == "s5")["late_rate"] is None


@pytest.mark.parametrize("small", [None, 4])
def test_rfm_segments_sum_to_customers(make_star, small):
    orders = [dict(order_id=f"{c}-{i}", customer_id=f"c{c:02d}", order_ts=day(c + i)) for c in range(17) for i in range(1 + c % 4)]
    star = make_star(orders=orders)
    assert sum(r["customers"] for r in business.q08_rfm_segments(star, small=small).collect()) == 17
    plain = {r["customer_id"]: r for r in marts.rfm_customers(star).collect()}
    forced = {r["customer_id"]: r for r in marts.rfm_customers(star, small=small).collect()}
    assert plain == forced
    assert all(3 <= r["rfm_score"] <= 15 and r["segment"] for r in plain.values())
    assert plain["c16"]["r_score"] == 5


def test_single_customer(make_star):
    row = marts.rfm_customers(make_star()).first()
    assert (row["r_score"], row["f_score"], row["m_score"], row["recency_days"]) == (5, 1, 1, 1)


@pytest.mark.parametrize("small", [None, 3])
def test_margin_shares_sum_to_one(make_star, small):
    orders = [dict(order_id=f"o{i}", customer_id=f"c{i}", gross_merchandise_value=D(100 + 10 * i)) for i in range(11)]
    rows = business.q23_margin_concentration(make_star(orders=orders), small=small).collect()
    assert [r["customers"] for r in rows] == [3, 2, 2, 2, 2]
    assert sum(r["margin_share"] for r in rows) == pytest.approx(1, abs=2e-4)


def test_units_rollup_compares_both_sides(make_star):
    star = make_star(
        orders=[dict(order_id="o1"), dict(order_id="o2", status="Cancelled")],
        inventory=[dict(units_sold=8), dict(product_id="p9", units_sold=2)],
    )
    got = {r["product_id"]: (r["units_ordered"], r["units_booked"], r["difference"]) for r in marts.units_sold_rollup(star).collect()}
    assert got == {"p1": (10, 8, 2), "p9": (None, 2, -2)}


def test_pairs_without_dimensions_take_no_place_in_the_cut(make_star):
    stock = [dict(product_id=f"ghost{k}", stockout_minutes=500 + k) for k in range(30)]
    star = make_star(inventory=[dict(stockout_minutes=5), *stock, dict(store_id="nowhere", stockout_minutes=900)])
    rows = business.q17_availability_loss(star).collect()
    assert [(r["store_id"], r["product_id"], r["stockout_minutes"]) for r in rows] == [("s1", "p1", 5)]


def test_lines_without_an_order_name_no_category(make_star):
    star = make_star(
        products=[dict(product_id="p1"), dict(product_id="g", category="Ghost")],
        orders=[dict(order_id="a", status="Refunded", refund_amount=D("40.00"))],
        items=[dict(order_id="a"), dict(order_id="a"), dict(order_id="missing", product_id="g")],
    )
    rows = business.q24_category_refunds(star).collect()
    assert [(r["category"], r["refunded_orders"]) for r in rows] == [("Food", 1)]
    assert rows[0]["allocated_refund_value"] == 80.0
