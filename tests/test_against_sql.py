"""Every registered query equals its check SQL, value for value."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from oracle import oracle_queries
from tools.compare import normal, table

FOLDER = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def test_every_query_has_a_check():
    assert set(entry.PLANS) == set(oracle_queries())


@pytest.mark.parametrize("name", list(entry.PLANS))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.collect(), df.columns) == table(result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).first()["orders"] == 1473


# The order that each query promises, nulls where it says.
ORDERS = {
    "q02_city_value": "contribution_margin desc nulls last, city",
    "q03_store_margin_delivery": "contribution_margin nulls last, on_time_rate nulls last, store_id",
    "q04_category_profit": "gross_profit desc nulls last, category",
    "q05_weak_unit_economics": "gross_margin_rate nulls last, product_id",
    "q06_service_repeat": "repeat_30d_rate desc nulls last, service_group",
    "q07_cohort_retention": "cohort_month, month_number",
    "q08_rfm_segments": "avg_customer_revenue desc nulls last, segment",
    "q10_late_drivers": "late_rate desc nulls last, weather, day_type, traffic_window",
    "q11_rain_impact": "avg_delivery_minutes desc nulls last, weather",
    "q12_cancellation_hotspots": "cancellation_rate desc nulls last, city, zone",
    "q13_experiment_funnel": "experiment_variant",
    "q15_cac_city_channel": "cac desc nulls last, city, acquisition_channel",
    "q16_margin_to_cac": "margin_to_spend_ratio desc nulls last, acquisition_channel",
    "q17_availability_loss": "stockout_minutes desc nulls last, store_id, product_id",
    "q18_category_waste": "waste_rate desc nulls last, category",
    "q19_weekend_stockouts": "day_type",
    "q20_rolling_daily_orders": "order_date",
    "q21_weekday_baseline": "weekday",
    "q22_payment_method": "orders desc, payment_method",
    "q23_margin_concentration": "value_quintile",
    "q24_category_refunds": "allocated_refund_value desc nulls last, category",
    "q25_store_week_exceptions": "week_start desc, contribution_margin nulls last, store_id",
}


@pytest.mark.parametrize("name", list(ORDERS))
def test_rows_come_in_the_promised_order(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    result = db.execute(f"select * from ({entry.oracle_sql()[name]}) as answer order by {ORDERS[name]}")
    columns = [d[0] for d in result.description]
    want = [{c: normal(v) for c, v in zip(columns, row)} for row in result.fetchall()]
    assert [{c: normal(r[c]) for c in columns} for r in df.collect()] == want
