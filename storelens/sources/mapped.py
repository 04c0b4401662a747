"""The star schema derived from generic order, line, part, customer and event tables.

Keys stay 64-bit integers. Money is built from whole cents, so no binary rounding enters it.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.columns import MONEY
from storelens.operators.folds import folded
from storelens.sources.star import Star


@lru_cache(maxsize=256)
def _file_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema from the file footers, read once per session rather than once per plan."""
    return spark.read.parquet(path).schema


def _decimal(cents: str, kind: str) -> str:
    return f"cast(cast({cents} as decimal(19,0)) * 0.01 as {kind})"


# The source table that has as many rows as a table, or more.
ROWS_FROM = {
    "dim_customers": "customer", "dim_stores": "supplier", "dim_products": "part", "fact_orders": "orders", "fact_order_items": "lineitem",
    "fact_sessions": "events", "fact_inventory_daily": "lineitem", "fact_marketing_spend": "orders",
}


class MappedStar(Star):
    grouped = frozenset({"fact_inventory_daily", "fact_marketing_spend"})

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(_file_schema(self.spark, path)).parquet(path)

    def row_count(self, name: str):
        """Number of rows of a source table, as a scalar subquery; answered from file footers."""
        return self.source(name).agg(F.count(F.lit(1))).scalar()

    def about_rows(self, name: str) -> int:
        return self.source(ROWS_FROM[name]).count()

    def open(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _places(self) -> DataFrame:
        return self.source("nation").selectExpr("n_nationkey as nation_key", "n_name as city")

    def _dim_customers(self) -> DataFrame:
        people = self.source("customer").withColumnRenamed("c_nationkey", "nation_key")
        return people.join(self._places(), "nation_key").selectExpr(
            "c_custkey as customer_id",
            "date_add(date '1994-09-01', cast(c_custkey * 7919 % 2500 as int)) as signup_date",
            "city",
            "c_mktsegment as acquisition_channel",
            "elt(cast(c_custkey % 5 + 1 as int), '18-24', '25-34', '35-44', '45-54', '55+') as age_band",
            "c_acctbal > 5000 as is_prime",
        )

    def _dim_stores(self) -> DataFrame:
        sites = self.source("supplier").withColumnRenamed("s_nationkey", "nation_key")
        return sites.join(self._places(), "nation_key").selectExpr(
            "s_suppkey as store_id",
            "city",
            "s_name as zone",
            "date_add(date '1992-01-01', cast(s_suppkey * 37 % 900 as int)) as opened_date",
            "cast(45 + s_suppkey % 46 as int) as capacity_orders_per_hour",
            "cast((880 + s_suppkey * 7 % 300) / 1000 as decimal(5,3)) as delivery_speed_factor",
        )

    def _dim_products(self) -> DataFrame:
        cost = "floor(rint(p_retailprice * 100) * (48 + p_partkey % 36) / 100)"
        return self.source("part").selectExpr(
            "p_partkey as product_id",
            "p_type as category",
            "p_brand as subcategory",
            "case when p_size > 40 then 'Premium' when p_size > 14 then 'Mass' else 'Value' end as brand_tier",
            f"{_decimal(cost, 'decimal(10,2)')} as unit_cost",
            f"{_decimal('cast(rint(p_retailprice * 100) as bigint)', 'decimal(10,2)')} as list_price",
            "cast(2 + p_size * 7 as int) as shelf_life_days",
        )

    @cached_property
    def _lines_in_cents(self) -> DataFrame:
        lines = self.source("lineitem").selectExpr(
            "l_orderkey as order_id",
            "l_partkey as product_id",
            "cast(l_quantity as int) as quantity",
            "floor(rint(l_extendedprice * 100) / l_quantity) as price_cents",
            "rint(l_discount * 100) as percent_off",
        )
        return lines.selectExpr("*", "floor(price_cents * (48 + product_id % 36) / 100) as cost_cents")

    def _fact_order_items(self) -> DataFrame:
        """The line number repeats within an order, so the line key is the row's place in the scan.

        That key costs no shuffle and is unique by construction; it is read for uniqueness only.
        """
        return self._lines_in_cents.selectExpr(
            "monotonically_increasing_id() as order_item_id",
            "order_id",
            "product_id",
            "quantity",
            f"{_decimal('price_cents', 'decimal(10,2)')} as unit_selling_price",
            f"{_decimal('cost_cents', 'decimal(10,2)')} as unit_cost",
            f"{_decimal('floor(price_cents * percent_off / 100)', 'decimal(10,2)')} as item_discount",
        )

    @cached_property
    def _totals(self) -> DataFrame:
        summed = self._lines_in_cents.groupBy("order_id").agg(
            F.expr("sum(cast(quantity as bigint)) as units"),
            F.expr("sum(quantity * price_cents) as revenue_cents"),
            F.expr("sum(quantity * cost_cents) as goods_cents"),
        )
        return summed.selectExpr(
            "order_id",
            "units",
            f"{_decimal('revenue_cents', MONEY)} as item_revenue",
            f"{_decimal('goods_cents', MONEY)} as cogs",
        )

    @cached_property
    def _base(self) -> DataFrame:
        seconds = "(7 + o_orderkey * 13 % 16) * 3600 + o_orderkey * 17 % 60 * 60 + o_orderkey * 29 % 60"
        return self.source("orders").withColumn("stores", self.row_count("supplier")).selectExpr(
            "o_orderkey as order_id",
            "o_custkey as customer_id",
            "(o_orderkey * 7 + o_custkey) % stores as store_id",
            f"timestampadd(second, cast({seconds} as int), cast(o_orderdate as timestamp_ntz)) as order_ts",
            """case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 'Cancelled'
                    when o_orderstatus = 'P' and o_orderkey % 10 = 1 then 'Refunded' else 'Delivered' end as status""",
            "case o_orderpriority when '1-URGENT' then 'Rainy' when '2-HIGH' then 'Hot' else 'Clear' end as weather",
            "40 + o_orderkey * 11 % 500 as hundredths",
            "cast(13 + o_orderkey * 7 % 34 as int) as minutes",
        )

    @cached_property
    def _first_orders(self) -> DataFrame:
        """Ids of each customer's earliest order, by time and then id.

        A plain minimum combines before the shuffle, where a per-customer row number would move and
        sort all orders of one customer in one task. The outer grouping repeats the partitioning of
        the join it feeds and tells the optimizer that the ids are unique.
        """
        earliest = self._base.groupBy("customer_id").agg(F.expr("min(struct(order_ts, order_id)) as first"))
        return earliest.groupBy(F.col("first.order_id").alias("order_id")).agg(F.lit(True).alias("opened_account"))

    @cached_property
    def orders_with_totals(self) -> DataFrame:
        return self.narrowed_orders_with_totals(lambda orders: orders)

    def narrowed_orders_with_totals(self, narrow) -> DataFrame:
        joined = narrow(self._base).join(self._totals, "order_id", "left").join(self._first_orders, "order_id", "left")
        return joined.selectExpr(
            "order_id",
            "customer_id",
            "store_id",
            "order_ts",
            "if(status = 'Cancelled', null, timestampadd(minute, minutes, order_ts)) as delivery_ts",
            "status",
            "30 as promised_minutes",
            "if(status = 'Cancelled', null, cast(minutes as decimal(8,2))) as delivery_minutes",
            f"{_decimal('hundredths', 'decimal(8,2)')} as distance_km",
            "weather",
            "elt(cast(order_id div 3 % 4 + 1 as int), 'UPI', 'Card', 'Wallet', 'COD') as payment_method",
            "case order_id % 7 when 0 then 'WELCOME25' when 1 then 'WEEKEND10' end as campaign_id",
            "if(customer_id % 2 = 0, 'Control', 'Treatment') as experiment_variant",
            f"cast(coalesce(item_revenue, 0) as {MONEY}) as gross_merchandise_value",
            "cast(case order_id % 4 when 0 then 0 when 1 then 15 when 2 then 45 else 80 end as decimal(12,2)) as discount_amount",
            "cast(if(customer_id % 3 = 0, 0, 25) as decimal(10,2)) as delivery_fee",
            "cast(5 + order_id % 8 as decimal(10,2)) as packaging_fee",
            f"cast(if(status = 'Refunded', coalesce(item_revenue, 0) * 0.6, 0) as {MONEY}) as refund_amount",
            "cast(29 + hundredths % 40 as decimal(10,2)) as estimated_delivery_cost",
            "coalesce(opened_account, false) as is_first_order",
            "units",
            "item_revenue",
            "cogs",
        )

    def _fact_orders(self) -> DataFrame:
        return self.orders_with_totals.drop("units", "item_revenue", "cogs")

    def _fact_sessions(self) -> DataFrame:
        return self.source("events").withColumn("order_rows", self.row_count("orders")).selectExpr(
            "event_id as session_id",
            "user_id as customer_id",
            "cast(ts as timestamp_ntz) as session_ts",
            "if(user_id % 2 = 0, 'Control', 'Treatment') as experiment_variant",
            "event_type <> 'error' as viewed_product",
            "event_type in ('click', 'signup', 'purchase') as added_to_cart",
            "event_type in ('signup', 'purchase') as checkout_started",
            "event_type = 'purchase' as converted",
            "if(event_type = 'purchase', event_id % order_rows, null) as order_id",
            "cast(20 + floor(value) as int) as session_duration_seconds",
            "elt(cast(user_id % 3 + 1 as int), 'Android', 'iOS', 'Web') as device_type",
        )

    def _fact_inventory_daily(self) -> DataFrame:
        lines = self.source("lineitem").selectExpr(
            "to_date(l_shipdate) as inventory_date", "l_suppkey as store_id", "l_partkey as product_id", "cast(l_quantity as int) as quantity",
        )
        daily = folded(lines, ["inventory_date", "store_id", "product_id"], [F.expr("sum(quantity) as sold")], self.about_rows("fact_inventory_daily"))
        return daily.selectExpr(
            "inventory_date",
            "store_id",
            "product_id",
            "cast(sold + product_id % 20 as int) as opening_stock",
            "cast(store_id % 9 as int) as units_received",
            "cast(sold as int) as units_sold",
            "cast(least(product_id % 4, product_id % 20) as int) as waste_units",
            "cast(product_id % 20 + store_id % 9 - least(product_id % 4, product_id % 20) as int) as closing_stock",
            "cast(if((product_id + store_id) % 6 = 0, 20 + product_id * store_id % 280, 0) as int) as stockout_minutes",
        )

    def _fact_marketing_spend(self) -> DataFrame:
        """Order rows meet customers on the customer key; AQE splits the partition of a heavy one."""
        buyers = (
            self.source("customer")
            .withColumnRenamed("c_nationkey", "nation_key")
            .join(self._places(), "nation_key")
            .selectExpr("c_custkey as buyer_id", "city", "c_mktsegment as acquisition_channel")
        )
        grouped = (
            self.source("orders")
            .selectExpr(
                "o_custkey as buyer_id", "to_date(o_orderdate) as spend_date", "o_orderkey as order_key",
                "cast(rint(o_totalprice * 100) as bigint) as total_cents",
            )
            .join(buyers, "buyer_id")
            .groupBy("spend_date", "city", "acquisition_channel")
            .agg(
                F.expr("sum(order_key % 16000) as seen"),
                F.expr("sum(order_key % 400) as clicked"),
                F.expr("sum(total_cents % 5000000) as spent_cents"),
            )
        )
        return grouped.selectExpr(
            "spend_date",
            "city",
            "acquisition_channel",
            "concat(acquisition_channel, '-', cast(year(spend_date) * 100 + month(spend_date) as string)) as campaign_id",
            "2000 + seen as impressions",
            "50 + clicked as clicks",
            f"""{_decimal("if(acquisition_channel = 'FURNITURE', 0, spent_cents)", MONEY)} as spend""",
        )
