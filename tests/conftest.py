import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from storelens.session import build_session  # noqa: E402
from storelens.sources import TableStar  # noqa: E402
from storelens.sources.schemas import TABLES, table_schema  # noqa: E402

DATA = os.environ.get("STORELENS_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "local[8]", cores=8, app_name="tests",
        settings={"spark.sql.warehouse.dir": str(root / "warehouse"), "spark.checkpoint.dir": str(root / "shared")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Values a hand-made row takes unless it says otherwise.
DEFAULTS = {
    "dim_customers": dict(signup_date=dt.date(2025, 1, 1), city="North", acquisition_channel="Search", age_band="25-34", is_prime=False),
    "dim_stores": dict(city="North", zone="Dock", opened_date=dt.date(2024, 1, 1), capacity_orders_per_hour=60, delivery_speed_factor=Decimal("1.000")),
    "dim_products": dict(category="Food", subcategory="Fruit", brand_tier="Mass", unit_cost=Decimal("6.00"), list_price=Decimal("10.00"), shelf_life_days=7),
    "fact_orders": dict(
        customer_id="c1", store_id="s1", order_ts=dt.datetime(2025, 3, 1, 10), delivery_ts=None, status="Delivered",
        promised_minutes=30, delivery_minutes=Decimal("20.00"), distance_km=Decimal("1.00"), weather="Clear",
        payment_method="UPI", campaign_id=None, experiment_variant="Control", gross_merchandise_value=Decimal("100.00"),
        discount_amount=Decimal("0.00"), delivery_fee=Decimal("0.00"), packaging_fee=Decimal("0.00"),
        refund_amount=Decimal("0.00"), estimated_delivery_cost=Decimal("10.00"), is_first_order=False,
    ),
    "fact_order_items": dict(product_id="p1", quantity=10, unit_selling_price=Decimal("10.00"), unit_cost=Decimal("6.00"), item_discount=Decimal("0.00")),
    "fact_sessions": dict(
        customer_id="c1", session_ts=dt.datetime(2025, 3, 1, 9), experiment_variant="Control", viewed_product=True,
        added_to_cart=False, checkout_started=False, converted=False, order_id=None, session_duration_seconds=60, device_type="Web",
    ),
    "fact_inventory_daily": dict(
        inventory_date=dt.date(2025, 3, 1), store_id="s1", product_id="p1", opening_stock=10, units_received=5,
        units_sold=4, waste_units=1, closing_stock=10, stockout_minutes=0,
    ),
    "fact_marketing_spend": dict(
        spend_date=dt.date(2025, 3, 1), city="North", acquisition_channel="Search", campaign_id="m", impressions=10, clicks=1, spend=Decimal("50.00"),
    ),
}


def frame(spark, table, rows):
    """Rows of a star table from partial dictionaries; columns are nullable so bad rows can be planted."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in table_schema(table).fields])
    full = []
    for number, row in enumerate(rows):
        values = {**DEFAULTS[table], **row}
        if table == "fact_order_items":
            values.setdefault("order_item_id", number + 1)
        full.append(tuple(values.get(f.name) for f in schema.fields))
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="session")
def make_star(spark):
    def make(**tables):
        """``orders=[{...}]`` and so on; an order gets one matching line unless items are given."""
        rows = {
            "dim_customers": tables.get("customers", [dict(customer_id="c1")]),
            "dim_stores": tables.get("stores", [dict(store_id="s1")]),
            "dim_products": tables.get("products", [dict(product_id="p1")]),
            "fact_orders": tables.get("orders", [dict(order_id="o1")]),
            "fact_sessions": tables.get("sessions", []),
            "fact_inventory_daily": tables.get("inventory", []),
            "fact_marketing_spend": tables.get("marketing", []),
        }
        rows["fact_order_items"] = tables.get("items", [dict(order_id=o["order_id"]) for o in rows["fact_orders"]])
        return TableStar(spark, {name: frame(spark, name, rows[name]) for name in TABLES})

    return make
