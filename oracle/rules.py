"""What the tables must be, written out from the published DDL and not from the package under test.

Per table: the key, the references, and per column its kind, whether it may be null, its longest text
and the conditions it must meet, each with the name the package reports it under. Fixed values.
"""

from __future__ import annotations

KEYS = {
    "dim_customers": "customer_id", "dim_stores": "store_id", "dim_products": "product_id", "fact_orders": "order_id",
    "fact_order_items": "order_item_id", "fact_sessions": "session_id",
    "fact_inventory_daily": "inventory_date, store_id, product_id", "fact_marketing_spend": "spend_date, city, acquisition_channel",
}

# Child table, column, parent table, and whether the column may be null.
REFERENCES = [
    ("fact_orders", "customer_id", "dim_customers", False), ("fact_orders", "store_id", "dim_stores", False),
    ("fact_order_items", "order_id", "fact_orders", False), ("fact_order_items", "product_id", "dim_products", False),
    ("fact_sessions", "customer_id", "dim_customers", False), ("fact_sessions", "order_id", "fact_orders", True),
    ("fact_inventory_daily", "store_id", "dim_stores", False), ("fact_inventory_daily", "product_id", "dim_products", False),
]

# Column, kind, "null" where it may be null, longest text.
COLUMNS = {
    "dim_customers": "customer_id text 12, signup_date date, city text 40, acquisition_channel text 30, age_band text 10, is_prime flag",
    "dim_stores": "store_id text 10, city text 40, zone text 40, opened_date date, capacity_orders_per_hour int, delivery_speed_factor decimal(5,3)",
    "dim_products": "product_id text 10, category text 40, subcategory text 60, brand_tier text 20, unit_cost decimal(10,2), "
                    "list_price decimal(10,2), shelf_life_days int",
    "fact_orders": "order_id text 14, customer_id text 12, store_id text 10, order_ts time, delivery_ts time null, status text 12, "
                   "promised_minutes int, delivery_minutes decimal(8,2) null, distance_km decimal(8,2), weather text 12, payment_method text 20, "
                   "campaign_id text 20 null, experiment_variant text 12, gross_merchandise_value decimal(12,2), discount_amount decimal(12,2), "
                   "delivery_fee decimal(10,2), packaging_fee decimal(10,2), refund_amount decimal(12,2), estimated_delivery_cost decimal(10,2), "
                   "is_first_order flag",
    "fact_order_items": "order_item_id bigint, order_id text 14, product_id text 10, quantity int, unit_selling_price decimal(10,2), "
                        "unit_cost decimal(10,2), item_discount decimal(10,2)",
    "fact_sessions": "session_id text 16, customer_id text 12, session_ts time, experiment_variant text 12, viewed_product flag, added_to_cart flag, "
                     "checkout_started flag, converted flag, order_id text 14 null, session_duration_seconds int, device_type text 12",
    "fact_inventory_daily": "inventory_date date, store_id text 10, product_id text 10, opening_stock int, units_received int, units_sold int, "
                            "waste_units int, closing_stock int, stockout_minutes int",
    "fact_marketing_spend": "spend_date date, city text 40, acquisition_channel text 30, campaign_id text 20, impressions int, clicks int, spend decimal(12,2)",
}

# Table, reported name, condition that every row meets.
CONDITIONS = [
    ("dim_stores", "capacity_positive", "capacity_orders_per_hour > 0"), ("dim_stores", "speed_factor_positive", "delivery_speed_factor > 0"),
    ("dim_products", "unit_cost_not_negative", "unit_cost >= 0"), ("dim_products", "list_price_covers_cost", "list_price >= unit_cost"),
    ("dim_products", "shelf_life_positive", "shelf_life_days > 0"),
    ("fact_orders", "status_known", "status in ('Delivered', 'Cancelled', 'Refunded')"),
    ("fact_orders", "variant_known", "experiment_variant in ('Control', 'Treatment')"),
    ("fact_order_items", "quantity_positive", "quantity > 0"), ("fact_order_items", "selling_price_not_negative", "unit_selling_price >= 0"),
    ("fact_order_items", "unit_cost_not_negative", "unit_cost >= 0"), ("fact_order_items", "item_discount_not_negative", "item_discount >= 0"),
    ("fact_sessions", "variant_known", "experiment_variant in ('Control', 'Treatment')"),
    ("fact_sessions", "duration_positive", "session_duration_seconds > 0"),
    ("fact_inventory_daily", "opening_not_negative", "opening_stock >= 0"), ("fact_inventory_daily", "received_not_negative", "units_received >= 0"),
    ("fact_inventory_daily", "sold_not_negative", "units_sold >= 0"), ("fact_inventory_daily", "waste_not_negative", "waste_units >= 0"),
    ("fact_inventory_daily", "closing_not_negative", "closing_stock >= 0"),
    ("fact_inventory_daily", "stockout_within_day", "stockout_minutes between 0 and 1440"),
    ("fact_marketing_spend", "impressions_not_negative", "impressions >= 0"), ("fact_marketing_spend", "clicks_not_negative", "clicks >= 0"),
    ("fact_marketing_spend", "spend_not_negative", "spend >= 0"),
]

_SPARK = {"text": "string", "flag": "boolean", "time": "timestamp_ntz"}
_ACCEPTED = {"text": "not like '%[]'", "flag": "= 'BOOLEAN'", "time": "like 'TIMESTAMP%'", "date": "= 'DATE'"}


def columns(table: str) -> list[tuple[str, str, bool, int | None]]:
    """Name, kind, nullable, longest text."""
    found = []
    for part in COLUMNS[table].replace(", ", ",, ").split(",, "):
        name, kind, *rest = part.strip(" ,").split(" ")
        longest = next((int(x) for x in rest if x.isdigit()), None)
        found.append((name, kind, "null" in rest, longest))
    return found


def row_rules() -> list[tuple[str, str, str]]:
    """Table, reported name and the condition of a row that breaks it."""
    rules = []
    for table in COLUMNS:
        rules += [(table, f"{c}_not_null", f"{c} is null") for c, _, nullable, _ in columns(table) if not nullable]
        rules += [(table, f"{c}_length", f"length(cast({c} as varchar)) > {most}") for c, _, _, most in columns(table) if most]
    return rules + [(table, name, f"not ({condition})") for table, name, condition in CONDITIONS]


def violation_counts() -> list[str]:
    """One select per rule: table, reported name, number of rows that break it."""
    return [f"select '{t}' as table_name, '{n}' as rule, count(*) filter ({bad}) as violations from {t}" for t, n, bad in row_rules()]


def violation_samples(samples: int = 4) -> list[str]:
    """The same with the smallest key of each hash class of keys of such rows."""
    parts = []
    for table, rule, bad in row_rules():
        key = "concat_ws('|', " + ", ".join(f"coalesce(cast({c.strip()} as varchar), '')" for c in KEYS[table].split(",")) + ")"
        least = f"select min(k) as k from (select {key} as k from {table} where {bad}) group by cast('0x' || left(md5(k), 8) as bigint) % {samples}"
        parts.append(f"select '{table}' as table_name, '{rule}' as rule, (select count(*) from {table} where {bad}) as violations, "
                     f"coalesce((select string_agg(k, ',' order by k) from ({least})), '') as sample")
    return parts


def type_checks() -> list[str]:
    """One select per column: whether the fixture's type can stand for the declared one."""
    parts = []
    for table in COLUMNS:
        for name, kind, _, _ in columns(table):
            accepted = _ACCEPTED.get(kind, "similar to '(TINYINT|SMALLINT|INTEGER|BIGINT|HUGEINT|FLOAT|DOUBLE|DECIMAL.*)'")
            parts.append(
                f"select '{table}' as table_name, '{name}' as column_name, '{_SPARK.get(kind, kind)}' as declared, true as present, "
                f"coalesce(max(typeof({name})), '') {accepted} as passed from {table}"
            )
    return parts
