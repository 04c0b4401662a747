"""Declared schemas of the eight star tables, their keys, references and row rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """What one table must look like; ``columns`` is Spark DDL."""

    columns: str
    key: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    rules: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(" ".join(self.columns.split()))

    def column_names(self) -> list[str]:
        return self.schema().names

    def column_types(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.schema()}

    def not_null(self) -> list[str]:
        return [f.name for f in self.schema() if not f.nullable]


# Column names, types, length limits and row rules of the star schema. The rules are
# SQL predicates that every row must meet; a null operand is left to the not-null list.
TABLES: dict[str, TableSpec] = {
    "dim_customers": TableSpec(
        columns="""customer_id string not null, signup_date date not null, city string not null,
            acquisition_channel string not null, age_band string not null, is_prime boolean not null""",
        key=("customer_id",),
        required=("customer_id", "signup_date", "city", "acquisition_channel", "is_prime"),
        lengths={"customer_id": 12, "city": 40, "acquisition_channel": 30, "age_band": 10},
    ),
    "dim_stores": TableSpec(
        columns="""store_id string not null, city string not null, zone string not null, opened_date date not null,
            capacity_orders_per_hour int not null, delivery_speed_factor decimal(5,3) not null""",
        key=("store_id",),
        required=("store_id", "city", "zone", "capacity_orders_per_hour"),
        lengths={"store_id": 10, "city": 40, "zone": 40},
        rules={
            "capacity_positive": "capacity_orders_per_hour > 0",
            "speed_factor_positive": "delivery_speed_factor > 0",
        },
    ),
    "dim_products": TableSpec(
        columns="""product_id string not null, category string not null, subcategory string not null,
            brand_tier string not null, unit_cost decimal(10,2) not null, list_price decimal(10,2) not null,
            shelf_life_days int not null""",
        key=("product_id",),
        required=("product_id", "category", "unit_cost", "list_price", "shelf_life_days"),
        lengths={"product_id": 10, "category": 40, "subcategory": 60, "brand_tier": 20},
        rules={
            "unit_cost_not_negative": "unit_cost >= 0",
            "list_price_covers_cost": "list_price >= unit_cost",
            "shelf_life_positive": "shelf_life_days > 0",
        },
    ),
    "fact_orders": TableSpec(
        columns="""order_id string not null, customer_id string not null, store_id string not null,
            order_ts timestamp_ntz not null, delivery_ts timestamp_ntz, status string not null,
            promised_minutes int not null, delivery_minutes decimal(8,2), distance_km decimal(8,2) not null,
            weather string not null, payment_method string not null, campaign_id string,
            experiment_variant string not null, gross_merchandise_value decimal(12,2) not null,
            discount_amount decimal(12,2) not null, delivery_fee decimal(10,2) not null,
            packaging_fee decimal(10,2) not null, refund_amount decimal(12,2) not null,
            estimated_delivery_cost decimal(10,2) not null, is_first_order boolean not null""",
        key=("order_id",),
        references={"customer_id": ("dim_customers", "customer_id"), "store_id": ("dim_stores", "store_id")},
        required=(
            "order_id", "customer_id", "store_id", "order_ts", "status",
            "gross_merchandise_value", "discount_amount", "refund_amount",
        ),
        lengths={
            "order_id": 14, "customer_id": 12, "store_id": 10, "status": 12, "weather": 12, "payment_method": 20, "campaign_id": 20,
            "experiment_variant": 12,
        },
        rules={
            "status_known": "status in ('Delivered', 'Cancelled', 'Refunded')",
            "variant_known": "experiment_variant in ('Control', 'Treatment')",
        },
    ),
    "fact_order_items": TableSpec(
        columns="""order_item_id bigint not null, order_id string not null, product_id string not null,
            quantity int not null, unit_selling_price decimal(10,2) not null, unit_cost decimal(10,2) not null,
            item_discount decimal(10,2) not null""",
        key=("order_item_id",),
        references={"order_id": ("fact_orders", "order_id"), "product_id": ("dim_products", "product_id")},
        required=("order_item_id", "order_id", "product_id", "quantity", "unit_selling_price", "unit_cost"),
        lengths={"order_id": 14, "product_id": 10},
        rules={
            "quantity_positive": "quantity > 0",
            "selling_price_not_negative": "unit_selling_price >= 0",
            "unit_cost_not_negative": "unit_cost >= 0",
            "item_discount_not_negative": "item_discount >= 0",
        },
    ),
    "fact_sessions": TableSpec(
        columns="""session_id string not null, customer_id string not null, session_ts timestamp_ntz not null,
            experiment_variant string not null, viewed_product boolean not null, added_to_cart boolean not null,
            checkout_started boolean not null, converted boolean not null, order_id string,
            session_duration_seconds int not null, device_type string not null""",
        key=("session_id",),
        references={"customer_id": ("dim_customers", "customer_id"), "order_id": ("fact_orders", "order_id")},
        required=(
            "session_id", "customer_id", "experiment_variant", "viewed_product",
            "added_to_cart", "checkout_started", "converted", "order_id",
        ),
        lengths={"session_id": 16, "customer_id": 12, "experiment_variant": 12, "order_id": 14, "device_type": 12},
        rules={
            "variant_known": "experiment_variant in ('Control', 'Treatment')",
            "duration_positive": "session_duration_seconds > 0",
        },
    ),
    "fact_inventory_daily": TableSpec(
        columns="""inventory_date date not null, store_id string not null, product_id string not null,
            opening_stock int not null, units_received int not null, units_sold int not null,
            waste_units int not null, closing_stock int not null, stockout_minutes int not null""",
        key=("inventory_date", "store_id", "product_id"),
        references={"store_id": ("dim_stores", "store_id"), "product_id": ("dim_products", "product_id")},
        required=(
            "inventory_date", "store_id", "product_id", "opening_stock",
            "units_received", "units_sold", "waste_units", "closing_stock",
        ),
        lengths={"store_id": 10, "product_id": 10},
        rules={
            "opening_not_negative": "opening_stock >= 0",
            "received_not_negative": "units_received >= 0",
            "sold_not_negative": "units_sold >= 0",
            "waste_not_negative": "waste_units >= 0",
            "closing_not_negative": "closing_stock >= 0",
            "stockout_within_day": "stockout_minutes between 0 and 1440",
        },
    ),
    "fact_marketing_spend": TableSpec(
        columns="""spend_date date not null, city string not null, acquisition_channel string not null,
            campaign_id string not null, impressions int not null, clicks int not null, spend decimal(12,2) not null""",
        key=("spend_date", "city", "acquisition_channel"),
        required=("spend_date", "city", "acquisition_channel", "impressions", "clicks", "spend"),
        lengths={"city": 40, "acquisition_channel": 30, "campaign_id": 20},
        rules={
            "impressions_not_negative": "impressions >= 0",
            "clicks_not_negative": "clicks >= 0",
            "spend_not_negative": "spend >= 0",
        },
    ),
}


def table_schema(name: str) -> T.StructType:
    return TABLES[name].schema()


def compatible(declared: T.DataType, found: T.DataType) -> bool:
    """Whether a column of type ``found`` can stand for a declared one: keys and labels may have any
    plain type, numbers any numeric type, times with or without a zone."""
    if isinstance(declared, T.StringType):
        return not isinstance(found, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    if isinstance(declared, T.NumericType):
        return isinstance(found, T.NumericType)
    if isinstance(declared, T.TimestampNTZType):
        return isinstance(found, (T.TimestampNTZType, T.TimestampType))
    return type(declared) is type(found)
