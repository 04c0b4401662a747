"""The star schema as DuckDB common table expressions over the given tables."""

FIXTURES: dict[str, str] = {
    "dim_customers": """
select c_custkey as customer_id,
  cast(timestamp '1994-09-01 00:00:00' + interval 1 day * (c_custkey*7919 % 2500) as date) as signup_date,
  n_name as city, c_mktsegment as acquisition_channel,
  case c_custkey % 5 when 0 then '18-24' when 1 then '25-34' when 2 then '35-44' when 3 then '45-54' else '55+' end as age_band,
  c_acctbal > 5000 as is_prime
from customer join nation on c_nationkey = n_nationkey
""",
    "dim_stores": """
select s_suppkey as store_id, n_name as city, s_name as zone,
  cast(timestamp '1992-01-01 00:00:00' + interval 1 day * (s_suppkey*37 % 900) as date) as opened_date,
  cast(45 + s_suppkey % 46 as int) as capacity_orders_per_hour,
  cast(cast(880 + (s_suppkey*7) % 300 as decimal(6,0)) * cast(0.001 as decimal(4,3)) as decimal(5,3)) as delivery_speed_factor
from supplier join nation on s_nationkey = n_nationkey
""",
    "dim_products": """
select p_partkey as product_id, p_type as category, p_brand as subcategory,
  case when p_size <= 14 then 'Value' when p_size <= 40 then 'Mass' else 'Premium' end as brand_tier,
  cast(cast(floor(round(p_retailprice*100) * (48 + p_partkey % 36) / 100) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as unit_cost,
  cast(cast(round(p_retailprice*100) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as list_price,
  cast(2 + p_size*7 as int) as shelf_life_days
from part
""",
    "fact_order_items": """
select row_number() over () as order_item_id,
  l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
  cast(cast(floor(round(l_extendedprice*100) / l_quantity) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as unit_selling_price,
  cast(cast(floor(floor(round(l_extendedprice*100) / l_quantity) * (48 + l_partkey % 36) / 100) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as unit_cost,
  cast(cast(floor(floor(round(l_extendedprice*100) / l_quantity) * round(l_discount*100) / 100) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as decimal(10,2)) as item_discount
from lineitem
""",
    "order_base": """
select o_orderkey as order_id, o_custkey as customer_id,
  (o_orderkey*7 + o_custkey) % (select count(*) from supplier) as store_id,
  cast(o_orderdate as timestamp) + interval 1 hour * (7 + (o_orderkey*13) % 16)
    + interval 1 minute * ((o_orderkey*17) % 60) + interval 1 second * ((o_orderkey*29) % 60) as order_ts,
  case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 'Cancelled'
       when o_orderstatus = 'P' and o_orderkey % 10 = 1 then 'Refunded' else 'Delivered' end as status,
  case o_orderpriority when '1-URGENT' then 'Rainy' when '2-HIGH' then 'Hot' else 'Clear' end as weather,
  40 + (o_orderkey*11) % 500 as dist100, cast(floor(o_orderkey/3) as bigint) % 4 as pm,
  13 + (o_orderkey*7) % 34 as dmin,
  case when o_custkey % 2 = 0 then 'Control' else 'Treatment' end as experiment_variant
from orders
""",
    "fact_orders": """
select b.order_id, customer_id, store_id, order_ts,
  case when status = 'Cancelled' then null else order_ts + interval 1 minute * dmin end as delivery_ts,
  status, 30 as promised_minutes,
  case when status = 'Cancelled' then null else cast(dmin as decimal(8,2)) end as delivery_minutes,
  cast(cast(dist100 as decimal(8,0)) * cast(0.01 as decimal(3,2)) as decimal(8,2)) as distance_km, weather,
  case pm when 0 then 'UPI' when 1 then 'Card' when 2 then 'Wallet' else 'COD' end as payment_method,
  case when b.order_id % 7 = 0 then 'WELCOME25' when b.order_id % 7 = 1 then 'WEEKEND10' else null end as campaign_id,
  experiment_variant,
  cast(coalesce(g.gmv, 0) as decimal(14,2)) as gross_merchandise_value,
  cast(case b.order_id % 4 when 0 then 0 when 1 then 15 when 2 then 45 else 80 end as decimal(12,2)) as discount_amount,
  cast(case when customer_id % 3 = 0 then 0 else 25 end as decimal(10,2)) as delivery_fee,
  cast(5 + b.order_id % 8 as decimal(10,2)) as packaging_fee,
  cast(case when status = 'Refunded' then coalesce(g.gmv, 0) * cast(0.6 as decimal(2,1)) else 0 end as decimal(14,2)) as refund_amount,
  cast(29 + dist100 % 40 as decimal(10,2)) as estimated_delivery_cost,
  row_number() over (partition by customer_id order by order_ts, b.order_id) = 1 as is_first_order
from order_base b left join (
  select order_id, sum(quantity * unit_selling_price) as gmv from fact_order_items group by order_id
) g on b.order_id = g.order_id
""",
    "fact_sessions": """
select event_id as session_id, user_id as customer_id, ts as session_ts,
  case when user_id % 2 = 0 then 'Control' else 'Treatment' end as experiment_variant,
  event_type <> 'error' as viewed_product,
  event_type in ('click', 'signup', 'purchase') as added_to_cart,
  event_type in ('signup', 'purchase') as checkout_started,
  event_type = 'purchase' as converted,
  case when event_type = 'purchase' then event_id % (select count(*) from orders) end as order_id,
  cast(20 + floor(value) as int) as session_duration_seconds,
  case user_id % 3 when 0 then 'Android' when 1 then 'iOS' else 'Web' end as device_type
from events
""",
    "fact_inventory_daily": """
select inventory_date, store_id, product_id,
  cast(u + product_id % 20 as int) as opening_stock, cast(store_id % 9 as int) as units_received,
  cast(u as int) as units_sold, cast(least(product_id % 4, product_id % 20) as int) as waste_units,
  cast(product_id % 20 + store_id % 9 - least(product_id % 4, product_id % 20) as int) as closing_stock,
  cast(case when (product_id + store_id) % 6 = 0 then 20 + (product_id * store_id) % 280 else 0 end as int) as stockout_minutes
from (select cast(l_shipdate as date) as inventory_date, l_suppkey as store_id, l_partkey as product_id,
        sum(cast(l_quantity as int)) as u
      from lineitem group by cast(l_shipdate as date), l_suppkey, l_partkey) q
""",
    "fact_marketing_spend": """
select cast(o_orderdate as date) as spend_date, n_name as city, c_mktsegment as acquisition_channel,
  c_mktsegment || '-' || cast(year(o_orderdate)*100 + month(o_orderdate) as varchar(6)) as campaign_id,
  cast(2000 + sum(o_orderkey % 16000) as bigint) as impressions,
  cast(50 + sum(o_orderkey % 400) as bigint) as clicks,
  cast(cast(case when c_mktsegment = 'FURNITURE' then 0 else sum(cast(round(o_totalprice*100) as bigint) % 5000000) end as decimal(18,0))
    * cast(0.01 as decimal(3,2)) as decimal(16,2)) as spend
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by o_orderdate, n_name, c_mktsegment
""",
}
