"""Check queries for DuckDB: output columns with their kinds, and the query that yields them."""

from __future__ import annotations

SHARED: dict[str, str] = {
    "line_sums": """
select order_id, sum(quantity) as units, sum(quantity * unit_selling_price) as item_revenue,
  sum(quantity * unit_cost) as cogs
from fact_order_items group by all""",
    "econ": """
select f.*, units, item_revenue, cogs, status = 'Cancelled' as lost,
  if(lost, 0, gross_merchandise_value - discount_amount + delivery_fee + packaging_fee - refund_amount) as net_revenue,
  if(lost, 0, cogs) as realized_cogs,
  net_revenue - realized_cogs - estimated_delivery_cost as contribution_margin,
  coalesce(delivery_minutes <= promised_minutes, false) as is_on_time,
  cast(order_ts as date) as order_date
from fact_orders f inner join line_sums s on s.order_id = f.order_id""",
    "paced": """
select customer_id, order_id, order_ts, delivery_minutes, status, store_id,
  lead(order_ts) over next_one as next_order_ts,
  coalesce(epoch(lead(order_ts) over next_one) - epoch(order_ts) <= 30 * 86400, false) as repeated_within_30d
from fact_orders window next_one as (partition by customer_id order by order_ts, order_id)""",
    "judged": """
select *, case status when 'Cancelled' then 'Cancelled' when 'Refunded' then 'Refunded'
    else if(coalesce(delivery_minutes, 0) > 35, 'Late (>35m)', 'On time (<=35m)') end as service_group
from paced where order_ts <= (select max(order_ts) from fact_orders) - interval 30 day""",
    "sold_lines": """
select i.* from fact_order_items i where i.order_id in (select order_id from fact_orders where status <> 'Cancelled')""",
    "product_sales": """
select product_id, category, subcategory, brand_tier, sum(quantity) as units,
  sum(quantity * unit_selling_price) as item_revenue,
  sum(quantity * unit_selling_price) - sum(quantity * l.unit_cost) as gross_profit
from sold_lines l join dim_products using (product_id) group by all""",
    "cohort_cells": """
with active as (
  select distinct customer_id, cast(date_trunc('month', order_ts) as date) as m from fact_orders where status <> 'Cancelled'
), placed as (
  select customer_id, m, min(m) over (partition by customer_id) as cohort_month from active
)
select cohort_month, date_diff('month', cohort_month, m) as month_number, count(*) as active_customers,
  first_value(count(*)) over (partition by cohort_month order by date_diff('month', cohort_month, m)) as cohort_size
from placed group by cohort_month, date_diff('month', cohort_month, m)""",
    "buyer_value": """
select customer_id, min(order_ts) as first_order, max(order_ts) as last_order, count(*) as frequency,
  sum(net_revenue) as monetary, sum(contribution_margin) as contribution_margin
from econ where not lost group by customer_id""",
    "variant_sessions": """
select experiment_variant, count(*) as sessions, count(*) filter (converted) as conversions,
  count(*) filter (viewed_product) / count(*) as view_rate,
  count(*) filter (added_to_cart) / count(*) as add_to_cart_rate,
  count(*) filter (checkout_started) / count(*) as checkout_rate,
  count(*) filter (converted) / count(*) as conversion_rate
from fact_sessions group by experiment_variant""",
    "trial": """
select max(sessions) filter (experiment_variant = 'Control') as n_control,
  max(conversions) filter (experiment_variant = 'Control') as x_control,
  max(sessions) filter (experiment_variant = 'Treatment') as n_treatment,
  max(conversions) filter (experiment_variant = 'Treatment') as x_treatment,
  (x_control + x_treatment) / (n_control + n_treatment) as common,
  sqrt(common * (1 - common) * (1 / n_control + 1 / n_treatment)) as pooled,
  (x_treatment / n_treatment - x_control / n_control) / pooled as z_score
from variant_sessions""",
    # erfc by Simpson's rule on 4,000 steps, as DuckDB has no such function.
    "trial_p": """
select trial.*, 1 - 2 / sqrt(pi()) * (select sum(
    case when k in (0, 4000) then 1 when k % 2 = 1 then 4 else 2 end * exp(-pow(k * abs(z_score) / sqrt(2) / 4000, 2)))
  from range(4001) steps(k)) * (abs(z_score) / sqrt(2) / 4000) / 3 as p_value
from trial""",
    "variant_money": """
select experiment_variant, sum(contribution_margin) as margin,
  cast(sum(contribution_margin) as double) / count(*) as avg_margin,
  cast(sum(discount_amount) as double) / count(*) as avg_discount
from econ group by experiment_variant""",
    "per_session": """
select max(cast(margin as double) / sessions) filter (experiment_variant = 'Control') as control_mps,
  max(cast(margin as double) / sessions) filter (experiment_variant = 'Treatment') as treatment_mps
from variant_money join variant_sessions using (experiment_variant)""",
    "spend_acquired": """
select city, acquisition_channel, spend, customers from
  (select city, acquisition_channel, sum(spend) as spend from fact_marketing_spend group by all)
left join
  (select city, acquisition_channel, count(*) as customers from dim_customers
   where signup_date >= (select cast(min(order_ts) as date) from fact_orders)
     and signup_date <= (select cast(max(order_ts) as date) from fact_orders) group by all)
using (city, acquisition_channel)""",
    "calendar_orders": """
with counted as (select order_date, count(*) as n from econ group by order_date)
select cast(d as date) as order_date, coalesce(n, 0) as orders
from generate_series((select min(order_date) from counted)::timestamp, (select max(order_date) from counted)::timestamp, interval 1 day) s(d)
left join counted on counted.order_date = cast(d as date)""",
    "day_points": """
select date_diff('day', (select min(order_date) from calendar_orders), order_date) as t, orders as y from calendar_orders""",
    "slot_sums": """
select t % 7 as slot, cast(count(*) as double) as n, cast(sum(t) as double) as st, cast(sum(y) as double) as sy,
  cast(sum(t * t) as double) - st * st / n as wtt, cast(sum(t * y) as double) - st * sy / n as wty,
  cast(sum(y * y) as double) - sy * sy / n as wyy
from day_points group by t % 7""",
    "line_fit": """
select cast(sum(n) as bigint) as days, sum(wty) / sum(wtt) as slope,
  1.96 * sqrt((sum(wyy) - sum(wty) / sum(wtt) * sum(wty)) / (sum(n) - 10)) as half
from slot_sums""",
    "outlook": """
with steps as (
  select cast((select max(order_date) from calendar_orders) + cast(h + 1 as int) as date) as forecast_date,
    greatest(0, sy / n + slope * (days + h - st / n)) as v, half
  from range(28) r(h), line_fit, slot_sums where slot = (days + h) % 7
)
select forecast_date, round_even(v, 1) as forecast_orders, round_even(greatest(0, v - half), 1) as lower_95,
  round_even(v + half, 1) as upper_95
from steps""",
    "store_money": """
select store_id, count(*) as orders, count(distinct customer_id) as customers, sum(gross_merchandise_value) as gmv,
  sum(net_revenue) as net_revenue, sum(contribution_margin) as contribution_margin,
  cast(sum(delivery_minutes) as double) / count(delivery_minutes) as avg_delivery_minutes,
  count(*) filter (is_on_time and not lost) / nullif(count(*) filter (not lost), 0) as on_time_rate,
  count(*) filter (is_on_time) / count(*) as on_time_rate_all, count(*) filter (lost) / count(*) as cancellation_rate
from econ group by store_id""",
    "product_stock": """
select product_id, category, subcategory, sum(units_sold) as units_sold, sum(waste_units) as waste_units,
  sum(stockout_minutes) as stockout_minutes,
  sum(waste_units) / nullif(sum(units_sold) + sum(waste_units), 0) as waste_rate
from fact_inventory_daily join dim_products using (product_id) group by all""",
    "order_measures": """
select strftime(order_ts, '%Y-%m') as ym, store_id, customer_id, order_id, status, status <> 'Cancelled' as kept,
  gross_merchandise_value as gmv, estimated_delivery_cost as cost, delivery_minutes, promised_minutes,
  if(kept, gross_merchandise_value - discount_amount + delivery_fee + packaging_fee - refund_amount, 0) as net,
  if(kept, coalesce(cogs, 0), 0) as goods, coalesce(delivery_minutes <= promised_minutes, false) and kept as punctual
from fact_orders left join line_sums using (order_id)""",
}

_ECON = """order_id:i customer_id:i store_id:i order_ts:t delivery_ts:t status promised_minutes:i delivery_minutes:d
 distance_km:d weather payment_method campaign_id experiment_variant gross_merchandise_value:d discount_amount:d
 delivery_fee:d packaging_fee:d refund_amount:d estimated_delivery_cost:d is_first_order units:i cogs:d
 net_revenue:d contribution_margin:d is_on_time"""

_COHORT_MONTHS = range(80)

BODIES: dict[str, tuple[str, str]] = {
    "v_order_economics": (_ECON, "select * from econ"),
    "v_customer_order_sequence": (
        "customer_id:i order_id:i order_ts:t delivery_minutes:d status next_order_ts:t repeated_within_30d",
        "select * from paced",
    ),
    "v_daily_store_kpis": (
        """order_date store_id:i orders:i delivered_orders:i gmv:d net_revenue:d contribution_margin:d
        avg_delivery_minutes:d on_time_rate:d cancellation_rate:d""",
        """
select order_date, store_id, count(*) as orders, count(*) filter (status = 'Delivered') as delivered_orders,
  sum(gross_merchandise_value) as gmv, sum(net_revenue) as net_revenue, sum(contribution_margin) as contribution_margin,
  cast(sum(delivery_minutes) filter (not lost) as double) / nullif(count(delivery_minutes) filter (not lost), 0) as avg_delivery_minutes,
  count(*) filter (is_on_time and not lost) / nullif(count(*) filter (not lost), 0) as on_time_rate,
  count(*) filter (lost) / count(*) as cancellation_rate
from econ group by all""",
    ),
    "v_product_kpis": (
        "product_id:i category subcategory units:i item_revenue:d gross_profit:d",
        "select * from product_sales",
    ),
    "v_experiment_results": (
        "experiment_variant sessions:i conversions:i conversion_rate:d add_to_cart_rate:d checkout_rate:d",
        "select * from variant_sessions",
    ),
    "q01_exec_snapshot": (
        "orders:i customers:i gmv:d net_revenue:d contribution_margin:d margin_rate:d cancellation_rate:d",
        """
select count(*) as orders, count(distinct customer_id) as customers, sum(gross_merchandise_value) as gmv,
  sum(net_revenue) as net_revenue, sum(contribution_margin) as contribution_margin,
  round(cast(sum(contribution_margin) as double) / cast(sum(net_revenue) as double), 4) as margin_rate,
  round(count(*) filter (lost) / count(*), 4) as cancellation_rate
from econ""",
    ),
    "q02_city_value": (
        "city orders:i gmv:d contribution_margin:d margin_rate:d",
        """
select city, count(*) as orders, sum(gross_merchandise_value) as gmv, sum(contribution_margin) as contribution_margin,
  round(cast(sum(contribution_margin) as double) / cast(sum(net_revenue) as double), 4) as margin_rate
from econ join dim_stores using (store_id) group by city""",
    ),
    "q03_store_margin_delivery": (
        "store_id:i city zone orders:i contribution_margin:d avg_delivery_minutes:d on_time_rate:d",
        """
select store_id, city, zone, orders, contribution_margin, round(avg_delivery_minutes, 2) as avg_delivery_minutes,
  round(on_time_rate, 4) as on_time_rate
from store_money join dim_stores using (store_id)""",
    ),
    "q04_category_profit": (
        "category units:i item_revenue:d gross_profit:d",
        """
select category, sum(units) as units, sum(item_revenue) as item_revenue, sum(gross_profit) as gross_profit
from product_sales group by category""",
    ),
    "q05_weak_unit_economics": (
        "product_id:i category subcategory units:i item_revenue:d gross_profit:d gross_margin_rate:d",
        """
select *, round(cast(gross_profit as double) / cast(item_revenue as double), 4) as gross_margin_rate from product_sales
where cast(item_revenue as double) >= (select quantile_cont(cast(item_revenue as double), 0.75) from product_sales)
order by gross_margin_rate, product_id limit 20""",
    ),
    "q06_service_repeat": (
        "service_group eligible_orders:i repeat_30d_rate:d",
        """
select service_group, count(*) as eligible_orders, round(count(*) filter (repeated_within_30d) / count(*), 4) as repeat_30d_rate
from judged group by service_group""",
    ),
    "q07_cohort_retention": (
        "cohort_month month_number:i active_customers:i retention_rate:d",
        "select *, round(active_customers / cohort_size, 4) as retention_rate from cohort_cells",
    ),
    "q08_rfm_segments": (
        "segment customers:i avg_customer_revenue:d",
        """
with scored as (
  select monetary,
    6 - ntile(5) over (order by date_diff('day', cast(last_order as date), (select cast(max(last_order) as date) from buyer_value)), customer_id)
    + ntile(5) over (order by frequency, customer_id) + ntile(5) over (order by monetary, customer_id) as score
  from buyer_value
)
select case when score < 7 then 'At Risk' when score < 10 then 'Needs Attention' when score < 13 then 'Loyal' else 'Champions' end as segment,
  count(*) as customers, round(cast(sum(monetary) as double) / count(*), 2) as avg_customer_revenue
from scored group by 1""",
    ),
    "q09_discount_bands": (
        "discount_band orders:i aov:d avg_contribution_margin:d",
        """
select case when discount_amount >= 60 then 'INR 60+' when discount_amount >= 30 then 'INR 30-59'
    when discount_amount <> 0 then 'INR 1-29' else 'No discount' end as discount_band, count(*) as orders,
  round(cast(sum(gross_merchandise_value) as double) / count(*), 2) as aov,
  round(cast(sum(contribution_margin) as double) / count(*), 2) as avg_contribution_margin
from econ group by 1""",
    ),
    "q10_late_drivers": (
        "weather day_type traffic_window orders:i avg_delivery_minutes:d late_rate:d",
        """
select weather, if(isodow(order_ts) > 5, 'Weekend', 'Weekday') as day_type,
  if(hour(order_ts) in (8, 9) or hour(order_ts) between 18 and 21, 'Rush', 'Non-rush') as traffic_window,
  count(*) as orders, round(cast(sum(delivery_minutes) as double) / count(delivery_minutes), 2) as avg_delivery_minutes,
  round(count(*) filter (delivery_minutes > 35) / count(delivery_minutes), 4) as late_rate
from fact_orders where status <> 'Cancelled' group by all""",
    ),
    "q11_rain_impact": (
        "weather orders:i avg_delivery_minutes:d avg_delivery_cost:d avg_contribution_margin:d",
        """
select weather, count(*) as orders, round(cast(sum(delivery_minutes) as double) / count(*), 2) as avg_delivery_minutes,
  round(cast(sum(estimated_delivery_cost) as double) / count(*), 2) as avg_delivery_cost,
  round(cast(sum(contribution_margin) as double) / count(*), 2) as avg_contribution_margin
from econ where not lost group by weather""",
    ),
    "q12_cancellation_hotspots": (
        "city zone orders:i cancellations:i cancellation_rate:d",
        """
select city, zone, count(*) as orders, count(*) filter (status = 'Cancelled') as cancellations,
  round(cancellations / orders, 4) as cancellation_rate
from fact_orders join dim_stores using (store_id) group by city, zone having count(*) >= 100""",
    ),
    "q13_experiment_funnel": (
        "experiment_variant sessions:i conversions:i conversion_rate:d add_to_cart_rate:d checkout_rate:d",
        "select * from variant_sessions",
    ),
    "q14_experiment_lift": (
        "control_rate:d treatment_rate:d absolute_lift:d pooled_standard_error:d",
        """
select round(x_control / n_control, 4) as control_rate, round(x_treatment / n_treatment, 4) as treatment_rate,
  round(x_treatment / n_treatment - x_control / n_control, 4) as absolute_lift, round(pooled, 6) as pooled_standard_error
from trial""",
    ),
    "q15_cac_city_channel": (
        "city acquisition_channel spend:d customers:i cac:d",
        "select *, round(cast(spend as double) / customers, 2) as cac from spend_acquired",
    ),
    "q16_margin_to_cac": (
        "acquisition_channel customers:i margin_per_customer:d blended_cac:d margin_to_spend_ratio:d",
        """
with gained as (
  select acquisition_channel, count(distinct customer_id) as customers, cast(sum(contribution_margin) as double) as margin
  from econ join dim_customers using (customer_id) group by acquisition_channel
), paid as (
  select acquisition_channel, cast(sum(spend) as double) as spent from fact_marketing_spend group by acquisition_channel
)
select acquisition_channel, customers, round(margin / customers, 2) as margin_per_customer,
  round(spent / customers, 2) as blended_cac, round(margin / nullif(spent, 0), 2) as margin_to_spend_ratio
from gained join paid using (acquisition_channel)""",
    ),
    "q17_availability_loss": (
        "store_id:i city zone product_id:i category stockout_minutes:i units_sold:i",
        """
select store_id, city, zone, product_id, category, sum(stockout_minutes) as stockout_minutes, sum(units_sold) as units_sold
from fact_inventory_daily join dim_stores using (store_id) join dim_products using (product_id)
group by all order by stockout_minutes desc, store_id, product_id limit 30""",
    ),
    "q18_category_waste": (
        "category units_sold:i waste_units:i waste_rate:d",
        """
select category, sum(units_sold) as units_sold, sum(waste_units) as waste_units,
  round(sum(waste_units) / (sum(units_sold) + sum(waste_units)), 4) as waste_rate
from product_stock group by category""",
    ),
    "q19_weekend_stockouts": (
        "day_type stockout_product_days:i avg_stockout_minutes:d units_sold:i",
        """
select if(isodow(inventory_date) > 5, 'Weekend', 'Weekday') as day_type,
  count(*) filter (stockout_minutes > 0) as stockout_product_days,
  round(sum(stockout_minutes) / count(*), 2) as avg_stockout_minutes, sum(units_sold) as units_sold
from fact_inventory_daily group by 1""",
    ),
    "q20_rolling_daily_orders": (
        "order_date orders:i rolling_7d:d change_vs_prior_week:i",
        """
with counted as (select cast(order_ts as date) as order_date, count(*) as orders from fact_orders group by 1)
select order_date, orders, round(avg(orders) over (order by order_date rows 6 preceding), 2) as rolling_7d,
  orders - lag(orders, 7) over (order by order_date) as change_vs_prior_week
from counted""",
    ),
    "q21_weekday_baseline": (
        "weekday:i expected_orders:d demand_stddev:d",
        """
with counted as (select cast(order_ts as date) as order_date, count(*) as orders from fact_orders group by 1)
select isodow(order_date) as weekday, round(avg(orders), 1) as expected_orders, round(stddev_samp(orders), 1) as demand_stddev
from counted group by 1""",
    ),
    "q22_payment_method": (
        "payment_method orders:i aov:d cancellation_rate:d contribution_margin:d",
        """
select payment_method, count(*) as orders, round(cast(sum(gross_merchandise_value) as double) / count(*), 2) as aov,
  round(count(*) filter (lost) / count(*), 4) as cancellation_rate, sum(contribution_margin) as contribution_margin
from econ group by payment_method""",
    ),
    "q23_margin_concentration": (
        "value_quintile:i customers:i contribution_margin:d margin_share:d",
        """
with tiled as (
  select margin, ntile(5) over (order by margin desc, customer_id) as value_quintile
  from (select customer_id, sum(contribution_margin) as margin from econ group by customer_id)
)
select value_quintile, count(*) as customers, sum(margin) as contribution_margin,
  round(cast(sum(margin) as double) / cast((select sum(margin) from tiled) as double), 4) as margin_share
from tiled group by value_quintile""",
    ),
    "q24_category_refunds": (
        "category refunded_orders:i allocated_refund_value:d",
        """
select category, count(distinct if(status = 'Refunded', order_id, null)) as refunded_orders,
  round(sum(if(status = 'Refunded', cast(refund_amount as double) * cast(quantity * unit_selling_price as double)
    / nullif(cast(gross_merchandise_value as double), 0), null)), 2) as allocated_refund_value
from fact_order_items join fact_orders using (order_id) join dim_products using (product_id) group by category""",
    ),
    "q25_store_week_exceptions": (
        "week_start store_id:i orders:i cancellation_rate:d late_rate:d contribution_margin:d",
        """
with weeks as (
  select cast(date_trunc('week', order_ts) as date) as week_start, store_id, count(*) as orders,
    count(*) filter (lost) / count(*) as cancellation_rate,
    count(*) filter (not lost and delivery_minutes > 35) / nullif(count(*) filter (not lost), 0) as late_rate,
    sum(contribution_margin) as contribution_margin
  from econ group by all
), bounds as (
  select quantile_cont(cancellation_rate, 0.75) as high_cancel, quantile_cont(late_rate, 0.75) as high_late,
    quantile_cont(cast(contribution_margin as double), 0.25) as low_margin
  from weeks
)
select weeks.* from weeks, bounds
where cancellation_rate >= high_cancel or coalesce(late_rate >= high_late, false) or cast(contribution_margin as double) <= low_margin""",
    ),
    "w1_customer_tiles": (
        "customer_id:i monetary:d ntile_up:i ntile_down:i qcut_up:i",
        """
select customer_id, monetary, ntile(5) over (order by monetary, customer_id) as ntile_up,
  ntile(5) over (order by monetary desc, customer_id) as ntile_down,
  greatest(1, ceil(5 * (row_number() over (order by monetary, customer_id) - 1) / (count(*) over () - 1))) as qcut_up
from buyer_value""",
    ),
    "store_kpis": (
        """store_id:i orders:i customers:i gmv:d net_revenue:d contribution_margin:d avg_delivery_minutes:d on_time_rate:d
        on_time_rate_all:d cancellation_rate:d city zone margin_rate:d""",
        """
select *, cast(contribution_margin as double) / cast(net_revenue as double) as margin_rate
from store_money join dim_stores using (store_id)""",
    ),
    "rfm_customers": (
        """customer_id:i first_order:t last_order:t frequency:i monetary:d contribution_margin:d recency_days:i r_score:i
        f_score:i m_score:i rfm_score:i segment""",
        """
with aged as (
  select *, floor((epoch((select max(order_ts) from fact_orders)) + 86400 - epoch(last_order)) / 86400) as recency_days from buyer_value
), placed as (
  select *, count(*) over () as n, row_number() over (order by recency_days, customer_id) as r,
    row_number() over (order by frequency, customer_id) as f, row_number() over (order by monetary, customer_id) as m
  from aged
), scored as (
  select *, 6 - greatest(1, ceil(5 * (r - 1) / (n - 1))) as r_score, greatest(1, ceil(5 * (f - 1) / (n - 1))) as f_score,
    greatest(1, ceil(5 * (m - 1) / (n - 1))) as m_score, r_score + f_score + m_score as rfm_score
  from placed
)
select *, case when rfm_score > 11 then 'Champions' when rfm_score > 8 then 'Loyal' when rfm_score > 5 then 'Needs Attention'
  else 'At Risk' end as segment
from scored""",
    ),
    "retention_by_service": (
        "service_group eligible_orders:i repeat_30d_rate:d",
        """
select service_group, count(*) as eligible_orders, count(*) filter (repeated_within_30d) / count(*) as repeat_30d_rate
from judged group by service_group""",
    ),
    "cohort_matrix": (
        "cohort_month " + " ".join(f"{m}:d" for m in _COHORT_MONTHS),
        "select strftime(cohort_month, '%Y-%m') as cohort_month, "
        + ", ".join(
            f'coalesce(max(active_customers / cohort_size) filter (month_number = {m}), 0) as "{m}"' for m in _COHORT_MONTHS
        )
        + " from cohort_cells group by 1",
    ),
    "experiment_summary": (
        """experiment_variant sessions:i conversions:i view_rate:d add_to_cart_rate:d checkout_rate:d conversion_rate:d
        absolute_lift_vs_control:d p_value:d conversion_contribution_margin:d avg_margin_per_conversion:d
        avg_discount_per_conversion:d contribution_margin_per_session:d""",
        """
select s.*, conversion_rate - x_control / n_control as absolute_lift_vs_control, round(p_value, 9) as p_value,
  margin as conversion_contribution_margin, avg_margin as avg_margin_per_conversion,
  avg_discount as avg_discount_per_conversion, cast(margin as double) / sessions as contribution_margin_per_session
from variant_sessions s join variant_money using (experiment_variant), trial_p""",
    ),
    "experiment_significance": (
        "n_control:i x_control:i n_treatment:i x_treatment:i z_score:d p_value:d",
        "select * replace (round(z_score, 9) as z_score, round(p_value, 9) as p_value) from trial_p",
    ),
    "product_kpis": (
        "product_id:i category subcategory brand_tier units:i item_revenue:d gross_profit:d",
        "select * from product_sales",
    ),
    "daily_store": (
        """order_date store_id:i orders:i gmv:d net_revenue:d contribution_margin:d avg_delivery_minutes:d on_time_rate:d
        on_time_rate_all:d""",
        """
select order_date, store_id, count(*) as orders, sum(gross_merchandise_value) as gmv, sum(net_revenue) as net_revenue,
  sum(contribution_margin) as contribution_margin,
  cast(sum(delivery_minutes) as double) / nullif(count(delivery_minutes), 0) as avg_delivery_minutes,
  count(*) filter (is_on_time and not lost) / nullif(count(*) filter (not lost), 0) as on_time_rate,
  count(*) filter (is_on_time) / count(*) as on_time_rate_all
from econ group by all""",
    ),
    "daily_orders_calendar": ("order_date orders:i", "select * from calendar_orders"),
    "demand_forecast": ("forecast_date forecast_orders:d lower_95:d upper_95:d", "select * from outlook"),
    "channel_cac": (
        "city acquisition_channel spend:d acquired_customers:i cac:d",
        "select *, customers as acquired_customers, cast(spend as double) / customers as cac from spend_acquired",
    ),
    "inventory_product_kpis": (
        "product_id:i units_sold:i waste_units:i stockout_minutes:i category subcategory waste_rate:d",
        "select * from product_stock",
    ),
    "inventory_store_kpis": (
        "store_id:i units_sold:i waste_units:i stockout_minutes:i city zone",
        """
select store_id, city, zone, sum(units_sold) as units_sold, sum(waste_units) as waste_units, sum(stockout_minutes) as stockout_minutes
from fact_inventory_daily join dim_stores using (store_id) group by all""",
    ),
    "publish_marts": (
        "mart rows_written:i rows_read:i",
        """
select mart, n as rows_written, n as rows_read from (
  select 'order_economics' as mart, count(*) as n from econ
  union all select 'store_kpis', count(distinct store_id) from econ
  union all select 'customer_rfm', count(*) from buyer_value
  union all select 'retention_by_service', count(distinct service_group) from judged
  union all select 'cohort_retention', count(distinct cohort_month) from cohort_cells
  union all select 'experiment_summary', count(*) from variant_sessions
  union all select 'product_kpis', count(*) from product_sales
  union all select 'daily_store_kpis', count(*) from (select distinct order_date, store_id from econ)
  union all select 'demand_forecast', 28
  union all select 'channel_cac', count(*) from spend_acquired
  union all select 'inventory_product_kpis', count(*) from product_stock
  union all select 'inventory_store_kpis', count(distinct store_id) from fact_inventory_daily
)""",
    ),
    "executive_kpis": (
        """orders:i customers:i gmv:d net_revenue:d contribution_margin:d contribution_margin_rate:d cancellation_rate:d
        on_time_rate:d control_conversion_rate:d treatment_conversion_rate:d experiment_absolute_lift:d
        experiment_z_score:d experiment_p_value:d control_margin_per_session:d treatment_margin_per_session:d""",
        """
select placed.*, money.*, round(x_control / n_control, 4) as control_conversion_rate,
  round(x_treatment / n_treatment, 4) as treatment_conversion_rate,
  round(x_treatment / n_treatment - x_control / n_control, 4) as experiment_absolute_lift,
  round(z_score, 3) as experiment_z_score, round(p_value, 9) as experiment_p_value,
  round(control_mps, 2) as control_margin_per_session, round(treatment_mps, 2) as treatment_margin_per_session
from (select count(*) as orders, count(distinct customer_id) as customers,
    round(count(*) filter (status = 'Cancelled') / count(*), 4) as cancellation_rate from fact_orders) placed,
  (select sum(gross_merchandise_value) as gmv, sum(net_revenue) as net_revenue, sum(contribution_margin) as contribution_margin,
    round(cast(sum(contribution_margin) as double) / cast(sum(net_revenue) as double), 4) as contribution_margin_rate,
    round(count(*) filter (is_on_time and not lost) / count(*) filter (not lost), 4) as on_time_rate from econ) money,
  trial_p, per_session""",
    ),
    "launch_decision": (
        "p_value:d margin_per_session_lift:d launch decision",
        """
select round(p_value, 9) as p_value, treatment_mps - control_mps as margin_per_session_lift,
  p_value < 0.05 and treatment_mps > control_mps as launch,
  if(launch, 'launch the treatment with monitoring', 'do not launch the treatment yet') as decision
from trial_p, per_session""",
    ),
    "executive_memo_facts": (
        """orders:i customers:i contribution_margin:d margin_rate:d on_time_repeat_rate:d late_repeat_rate:d repeat_gap:d
        treatment_conversion_rate:d control_conversion_rate:d p_value:d treatment_margin_per_session:d
        control_margin_per_session:d weakest_store_id:i weakest_zone weakest_city weakest_margin:d decision""",
        """
select placed.*, money.*, shares.*, on_time_repeat_rate - late_repeat_rate as repeat_gap,
  x_treatment / n_treatment as treatment_conversion_rate, x_control / n_control as control_conversion_rate,
  round(p_value, 9) as p_value, treatment_mps as treatment_margin_per_session, control_mps as control_margin_per_session,
  weak.store_id as weakest_store_id, weak.zone as weakest_zone, weak.city as weakest_city, weak.m as weakest_margin,
  if(p_value < 0.05 and treatment_mps > control_mps, 'launch the treatment with monitoring', 'do not launch the treatment yet') as decision
from (select count(*) as orders, count(distinct customer_id) as customers from fact_orders) placed,
  (select sum(contribution_margin) as contribution_margin,
    cast(sum(contribution_margin) as double) / cast(sum(net_revenue) as double) as margin_rate from econ) money,
  (select count(*) filter (repeated_within_30d and service_group = 'On time (<=35m)')
      / count(*) filter (service_group = 'On time (<=35m)') as on_time_repeat_rate,
    count(*) filter (repeated_within_30d and service_group = 'Late (>35m)')
      / count(*) filter (service_group = 'Late (>35m)') as late_repeat_rate from judged) shares,
  (select store_id, zone, city, contribution_margin as m from store_money join dim_stores using (store_id)
    order by contribution_margin, store_id limit 1) weak,
  trial_p, per_session""",
    ),
    "chart_service_groups": (
        "service_group position:i eligible_orders:i repeat_30d_rate:d",
        """
select service_group, position, eligible_orders, repeat_30d_rate
from (values ('On time (<=35m)', 0), ('Late (>35m)', 1), ('Refunded', 2), ('Cancelled', 3)) o(service_group, position)
left join (select service_group, count(*) as eligible_orders, count(*) filter (repeated_within_30d) / count(*) as repeat_30d_rate
  from judged group by service_group) using (service_group)""",
    ),
    "chart_weakest_stores": (
        "store_id:i contribution_margin:d city zone",
        """
select store_id, contribution_margin, city, zone from store_money join dim_stores using (store_id)
order by contribution_margin, store_id limit 10""",
    ),
    "chart_demand_series": (
        "series day orders:d lower_95:d upper_95:d",
        """
select 'Actual' as series, order_date as day, cast(orders as double) as orders, cast(null as double) as lower_95, cast(null as double) as upper_95
from calendar_orders
union all select 'Forecast', forecast_date, forecast_orders, lower_95, upper_95 from outlook""",
    ),
    "units_sold_rollup": (
        "inventory_date store_id:i product_id:i units_ordered:i units_booked:i difference:i",
        """
select inventory_date, store_id, product_id, units_ordered, units_sold as units_booked,
  coalesce(units_ordered, 0) - coalesce(units_sold, 0) as difference
from (select cast(order_ts as date) as inventory_date, store_id, product_id, sum(quantity) as units_ordered
  from sold_lines join fact_orders using (order_id) group by all)
full join fact_inventory_daily using (inventory_date, store_id, product_id)""",
    ),
    "dq_status_counts": ("status orders:i", "select status, count(*) as orders from fact_orders group by status"),
    "dq_gmv_differences": (
        "order_id:i gross_merchandise_value:d item_revenue:d difference:d broken",
        """
select order_id, gross_merchandise_value, item_revenue, abs(gross_merchandise_value - item_revenue) as difference,
  not coalesce(abs(gross_merchandise_value - item_revenue) <= 0.05, false) as broken
from fact_orders full join line_sums using (order_id)""",
    ),
    "m_order_measures": (
        """date_year_month orders:i delivered_orders:i cancelled_orders:i customers:i placed_gmv:d realized_gmv:d net_revenue:d
        realized_cogs:d delivery_cost:d contribution_margin:d contribution_margin_pct:d aov:d cancellation_rate:d
        on_time_orders:i on_time_rate:d average_delivery_minutes:d""",
        """
select ym as date_year_month, count(distinct order_id) as orders, count(distinct order_id) filter (status = 'Delivered') as delivered_orders,
  count(distinct order_id) filter (not kept) as cancelled_orders, count(distinct customer_id) as customers, sum(gmv) as placed_gmv,
  sum(gmv) filter (kept) as realized_gmv, sum(net) as net_revenue, sum(goods) as realized_cogs, sum(cost) as delivery_cost,
  sum(net) - sum(goods) - sum(cost) as contribution_margin,
  cast(sum(net) - sum(goods) - sum(cost) as double) / cast(sum(net) as double) as contribution_margin_pct,
  cast(sum(gmv) filter (kept) as double) / count(distinct order_id) filter (kept) as aov,
  count(distinct order_id) filter (not kept) / count(distinct order_id) as cancellation_rate,
  count(distinct order_id) filter (punctual) as on_time_orders,
  count(distinct order_id) filter (punctual) / count(distinct order_id) filter (kept) as on_time_rate,
  cast(sum(delivery_minutes) filter (kept) as double) / count(delivery_minutes) filter (kept) as average_delivery_minutes
from order_measures group by ym""",
    ),
    "m_session_measures": (
        "customers_city sessions:i conversions:i conversion_rate:d add_to_cart_rate:d",
        """
select city as customers_city, count(distinct session_id) as sessions, count(distinct session_id) filter (converted) as conversions,
  count(distinct session_id) filter (converted) / count(distinct session_id) as conversion_rate,
  count(distinct session_id) filter (added_to_cart) / count(distinct session_id) as add_to_cart_rate
from fact_sessions left join dim_customers using (customer_id) group by city""",
    ),
    "m_inventory_measures": (
        "stores_city units_sold:i waste_units:i waste_rate:d stockout_hours:d",
        """
select city as stores_city, sum(units_sold) as units_sold, sum(waste_units) as waste_units,
  sum(waste_units) / (sum(units_sold) + sum(waste_units)) as waste_rate, sum(stockout_minutes) / 60 as stockout_hours
from fact_inventory_daily left join dim_stores using (store_id) group by city""",
    ),
    "m_repeat_customers": (
        "stores_city customers:i repeat_customers:i repeat_customer_rate:d",
        """
select city as stores_city, count(*) as customers, count(*) filter (n > 1) as repeat_customers,
  count(*) filter (n > 1) / count(*) as repeat_customer_rate
from (select city, customer_id, count(distinct order_id) as n from fact_orders left join dim_stores using (store_id) group by all)
group by city""",
    ),
    "m_gmv_mom": (
        "month realized_gmv:d realized_gmv_previous_month:d gmv_mom_pct:d",
        """
with monthly as (
  select cast(date_trunc('month', order_ts) as date) as month, sum(gross_merchandise_value) filter (status <> 'Cancelled') as gmv
  from fact_orders group by 1
)
select c.month, c.gmv as realized_gmv, p.gmv as realized_gmv_previous_month,
  cast(c.gmv - p.gmv as double) / cast(p.gmv as double) as gmv_mom_pct
from monthly c left join monthly p on c.month = p.month + interval 1 month""",
    ),
    "m_gmv_mom_filtered": (
        "month realized_gmv:d realized_gmv_previous_month:d gmv_mom_pct:d",
        """
with monthly as (
  select cast(date_trunc('month', order_ts) as date) as month, sum(gross_merchandise_value) filter (status <> 'Cancelled') as gmv
  from fact_orders group by 1
)
select c.month, c.gmv as realized_gmv, p.gmv as realized_gmv_previous_month,
  cast(c.gmv - p.gmv as double) / cast(p.gmv as double) as gmv_mom_pct
from monthly c left join monthly p on c.month = p.month + interval 1 month where c.month = date '1996-03-01'""",
    ),
    "m_orders_in_quarter": (
        "stores_city orders:i customers:i realized_gmv:d aov:d",
        """
select city as stores_city, count(distinct order_id) as orders, count(distinct o.customer_id) as customers,
  sum(gross_merchandise_value) filter (status <> 'Cancelled') as realized_gmv,
  cast(sum(gross_merchandise_value) filter (status <> 'Cancelled') as double) / nullif(count(distinct order_id) filter (status <> 'Cancelled'), 0) as aov
from fact_orders o left join dim_stores using (store_id)
where order_ts >= timestamp '1996-01-01' and order_ts < timestamp '1996-04-01'
  and o.customer_id in (select customer_id from dim_customers where is_prime)
group by city""",
    ),
    "order_economics_mart": (
        "order_id order_date units:i item_revenue:d cogs:d net_revenue:d realized_cogs:d contribution_margin:d is_on_time",
        "select order_id, order_date, units, item_revenue, cogs, net_revenue, realized_cogs, contribution_margin, is_on_time from econ",
    ),
    "m_cogs_by_category": (
        "products_category line_cogs:d",
        """
select category as products_category, sum(quantity * l.unit_cost) as line_cogs
from sold_lines l left join dim_products using (product_id) group by category""",
    ),
    "m_conversion_and_orders_by_city": (
        "customers_city conversion_rate:d orders:i aov:d",
        """
select city as customers_city, conversion_rate, orders, aov from
  (select city, count(*) filter (converted) / count(*) as conversion_rate from fact_sessions left join dim_customers using (customer_id) group by city)
full join
  (select city, count(*) as orders, cast(sum(gross_merchandise_value) filter (status <> 'Cancelled') as double)
    / count(*) filter (status <> 'Cancelled') as aov from fact_orders left join dim_customers using (customer_id) group by city)
using (city)""",
    ),
    "date_dim": (
        "date year:i month_number:i month year_month weekday_number:i weekday is_weekend",
        """
select cast(d as date) as date, year(d) as year, month(d) as month_number, strftime(d, '%b') as month,
  strftime(d, '%Y-%m') as year_month, isodow(d) as weekday_number, strftime(d, '%a') as weekday, isodow(d) > 5 as is_weekend
from generate_series((select date_trunc('day', min(order_ts)) from fact_orders), (select date_trunc('day', max(order_ts)) from fact_orders), interval 1 day) s(d)""",
    ),
    "row_access": (
        "store_id:i city zone",
        "select store_id, city, zone from dim_stores where city in (select n_name from nation where n_regionkey = 1)",
    ),
    "d_revenue_margin_trend": (
        "date_year_month net_revenue:d contribution_margin:d contribution_margin_pct:d",
        """
select ym as date_year_month, sum(net) as net_revenue, sum(net) - sum(goods) - sum(cost) as contribution_margin,
  cast(sum(net) - sum(goods) - sum(cost) as double) / cast(sum(net) as double) as contribution_margin_pct
from order_measures group by ym""",
    ),
    "d_prime_revenue_margin_trend": (
        "date_year_month net_revenue:d contribution_margin:d contribution_margin_pct:d",
        """
select ym as date_year_month, sum(net) as net_revenue, sum(net) - sum(goods) - sum(cost) as contribution_margin,
  cast(sum(net) - sum(goods) - sum(cost) as double) / cast(sum(net) as double) as contribution_margin_pct
from order_measures where customer_id in (select customer_id from dim_customers where is_prime) group by ym""",
    ),
    "d_city_margin_delivery": (
        "city contribution_margin:d margin_rate:d avg_delivery_minutes:d",
        """
select city, sum(contribution_margin) as contribution_margin,
  cast(sum(contribution_margin) as double) / cast(sum(net_revenue) as double) as margin_rate,
  cast(sum(delivery_minutes) filter (not lost) as double) / count(delivery_minutes) filter (not lost) as avg_delivery_minutes
from econ join dim_stores using (store_id) group by city""",
    ),
    "d_store_exceptions": (
        "store_id:i city zone contribution_margin:d cancellation_rate:d on_time_rate:d repeat_30d_rate:d",
        """
select store_id, city, zone, contribution_margin, cancellation_rate, on_time_rate, repeat_30d_rate
from store_money join dim_stores using (store_id)
left join (select store_id, count(*) filter (repeated_within_30d) / count(*) as repeat_30d_rate from judged group by store_id) using (store_id)""",
    ),
    "d_channel_scatter": (
        "acquisition_channel customers:i blended_cac:d margin_per_customer:d",
        """
with gained as (
  select acquisition_channel, count(distinct customer_id) as customers, cast(sum(contribution_margin) as double) as margin
  from econ join dim_customers using (customer_id) group by acquisition_channel
), paid as (
  select acquisition_channel, cast(sum(spend) as double) as spent from fact_marketing_spend group by acquisition_channel
)
select acquisition_channel, customers, round(spent / customers, 2) as blended_cac, round(margin / customers, 2) as margin_per_customer
from gained join paid using (acquisition_channel)""",
    ),
    "d_hour_weekday_heatmap": (
        "hour:i Mon:i Tue:i Wed:i Thu:i Fri:i Sat:i Sun:i",
        "select hour(order_ts) as hour, "
        + ", ".join(
            f'count(*) filter (isodow(order_ts) = {i}) as "{d}"'
            for i, d in enumerate(["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"], 1)
        )
        + " from fact_orders group by 1",
    ),
    "d_stockout_category_store": (
        "category store_id:i zone stockout_minutes:i",
        """
select category, store_id, zone, sum(stockout_minutes) as stockout_minutes
from fact_inventory_daily join dim_products using (product_id) join dim_stores using (store_id) group by all""",
    ),
    "d_replenishment_review": (
        "product_id:i category stockout_minutes:i waste_rate:d gross_profit:d gross_margin_rate:d action",
        """
with both_sides as (
  select s.product_id, s.category, stockout_minutes, waste_rate, gross_profit,
    cast(gross_profit as double) / nullif(cast(item_revenue as double), 0) as gross_margin_rate
  from product_stock s join product_sales p on p.product_id = s.product_id
), bounds as (
  select quantile_cont(cast(stockout_minutes as double), 0.75) as high_out, quantile_cont(waste_rate, 0.75) as high_waste,
    quantile_cont(gross_margin_rate, 0.5) as middle
  from both_sides
)
select both_sides.*, case when stockout_minutes >= high_out and gross_profit > 0 then 'replenish'
  when waste_rate >= high_waste and gross_margin_rate < middle then 'review assortment' end as action
from both_sides, bounds where action is not null""",
    ),
}


def _quality_bodies() -> None:
    """Check queries of the quality rules, from the list written out in ``oracle.rules``."""
    from oracle import rules

    keys = [
        f"select '{table}' as table_name, '{key.replace(', ', '+')}' as key, cast(coalesce(sum(n), 0) as bigint) as rows, "
        f"count(*) filter (n > 1) as violations from (select count(*) as n from {table} group by {key})"
        for table, key in rules.KEYS.items()
    ]
    references = [
        f"select '{table}' as table_name, '{column}' as column_name, count(*) as violations from {table} c "
        f"where {f'c.{column} is not null and ' if nullable else ''}not exists (select 1 from {parent} p where p.{rules.KEYS[parent]} = c.{column})"
        for table, column, parent, nullable in rules.REFERENCES
    ]

    def verdict(parts: list[str]) -> str:
        return "select *, violations = 0 as passed from (" + "\nunion all ".join(parts) + ")"

    BODIES["dq_constraints"] = ("table_name rule violations:i passed", verdict(rules.violation_counts()))
    BODIES["dq_keys"] = ("table_name key rows:i violations:i passed", verdict(keys))
    BODIES["dq_references"] = ("table_name column_name violations:i passed", verdict(references))

    BODIES["dq_types"] = ("table_name column_name declared present passed", "\nunion all ".join(rules.type_checks()))

    checks = []
    for name in rules.KEYS:
        checks.append(f"select '{name}: exists' as \"check\", true as passed, 'present' as detail")
        checks.append(f"select '{name}: required columns', true, 'missing='")
    for check, table in {
        "customer primary key": "dim_customers", "store primary key": "dim_stores", "product primary key": "dim_products",
        "order primary key": "fact_orders", "order-item primary key": "fact_order_items", "session primary key": "fact_sessions",
    }.items():
        key = rules.KEYS[table]
        checks.append(f"select '{check}', count(*) = count(distinct {key}), 'rows=' || count(*) from {table}")
    for check, table, column in (
        ("order customer foreign key", "fact_orders", "customer_id"), ("order store foreign key", "fact_orders", "store_id"),
        ("item order foreign key", "fact_order_items", "order_id"), ("item product foreign key", "fact_order_items", "product_id"),
        ("session customer foreign key", "fact_sessions", "customer_id"),
    ):
        parent = next(p for t, c, p, _ in rules.REFERENCES if (t, c) == (table, column))
        parent_column = rules.KEYS[parent]
        checks.append(
            f"select '{check}', count(*) = 0, 'orphans=' || count(*) from {table} c "
            f"where not exists (select 1 from {parent} p where p.{parent_column} = c.{column})"
        )
    checks += [
        """select 'GMV reconciles to items', count(*) filter (not ok) = 0,
  'orders=' || count(*) filter (not ok) || ';max_absolute_difference=' || printf('%.4f', max(gap)) from (
  select cast(abs(gross_merchandise_value - item_revenue) as double) as gap, coalesce(gap <= 0.05, false) as ok
  from fact_orders full join line_sums using (order_id))""",
        """select 'valid order status', count(*) filter (status not in ('Delivered', 'Cancelled', 'Refunded')) = 0,
  'Delivered=' || count(*) filter (status = 'Delivered') || ';Cancelled=' || count(*) filter (status = 'Cancelled')
  || ';Refunded=' || count(*) filter (status = 'Refunded') || ';other='
  || count(*) filter (status not in ('Delivered', 'Cancelled', 'Refunded')) from fact_orders""",
        """select 'orders span all calendar months', count(distinct strftime(order_ts, '%Y-%m')) = 12,
  'months=' || count(distinct strftime(order_ts, '%Y-%m')) from fact_orders""",
        """select 'non-negative financials', count(*) = 0, 'rows=' || count(*) from fact_orders
where gross_merchandise_value < 0 or discount_amount < 0 or refund_amount < 0""",
        """select 'logical session funnel', count(*) = 0, 'rows=' || count(*) from fact_sessions
where (added_to_cart and not viewed_product) or (checkout_started and not added_to_cart) or (converted and not checkout_started)""",
        """select 'converted sessions link to orders', count(*) = 0, 'unlinked=' || count(*) from fact_sessions s
where converted and not exists (select 1 from fact_orders o where o.order_id = s.order_id)""",
        """select 'balanced experiment assignment', abs(n_control - n_treatment) / (n_control + n_treatment) <= 0.02,
  'Control=' || n_control || ';Treatment=' || n_treatment from trial""",
        """select 'embedded experiment lift', x_treatment / n_treatment - x_control / n_control between 0.035 and 0.045,
  'absolute_lift=' || printf('%.4f', x_treatment / n_treatment - x_control / n_control) from trial""",
        """select 'inventory balance equation', count(*) filter (bad) = 0, 'rows=' || count(*) || ';errors=' || count(*) filter (bad)
from (select opening_stock + units_received - units_sold - waste_units <> closing_stock as bad from fact_inventory_daily)""",
        """select 'non-negative inventory', count(*) = 0, 'rows=' || count(*) from fact_inventory_daily
where opening_stock < 0 or units_received < 0 or units_sold < 0 or waste_units < 0 or closing_stock < 0""",
        """select 'metadata order count', count(*) = (select count(*) from orders), 'expected=' || (select count(*) from orders)
from fact_orders""",
    ]
    numbered = "\nunion all ".join(
        f"select {i} as position, * from ({text})" if i == 0 else f"select {i}, * from ({text})" for i, text in enumerate(checks)
    )
    BODIES["dq_report"] = ("position:i check passed detail", numbered)
    BODIES["dq_summary"] = (
        "checks:i passed:i failed:i all_passed",
        f"select count(*) as checks, count(*) filter (passed) as passed, count(*) filter (not passed) as failed, bool_and(passed) as all_passed from ({numbered})",
    )
    BODIES["dq_constraint_samples"] = ("table_name rule violations:i sample", "\nunion all ".join(rules.violation_samples()))
    BODIES["dq_violating_rows"] = (
        "table_name rule rows:i",
        "\nunion all ".join(f"select table_name, rule, violations as rows from ({part}) where violations > 0" for part in rules.violation_counts()),
    )


_quality_bodies()
# The same question with the rank search made to narrow.
BODIES["w1_customer_tiles_narrowed"] = BODIES["w1_customer_tiles"]
# What was written and read back answers as the tables themselves.
BODIES["csv_late_drivers"] = BODIES["q10_late_drivers"]
BODIES["json_executive_kpis"] = BODIES["executive_kpis"]
STAR = ("dim_customers", "dim_stores", "dim_products", "fact_orders", "fact_order_items", "fact_sessions", "fact_inventory_daily", "fact_marketing_spend")
BODIES["warehouse_counts"] = ("table_name rows:i", "\nunion all ".join(f"select '{t}' as table_name, count(*) as rows from {t}" for t in STAR))
_PROBES = {
    "dim_customers": "count(*) filter (is_prime)", "dim_stores": "sum(capacity_orders_per_hour)", "dim_products": "sum(round(unit_cost * 100))",
    "fact_orders": "count(delivery_ts) + sum(round(gross_merchandise_value * 100))", "fact_order_items": "sum(round(unit_selling_price * 100))",
    "fact_sessions": "count(*) filter (converted) + count(order_id)", "fact_inventory_daily": "sum(closing_stock)", "fact_marketing_spend": "sum(round(spend * 100))",
}
BODIES["csv_bundle"] = (
    "table_name rows:i probe:i", "\nunion all ".join(f"select '{t}' as table_name, count(*) as rows, cast({p} as bigint) as probe from {t}" for t, p in _PROBES.items())
)
# The stated order count is one too many there, so that check fails and the others are as ever.
BODIES["json_quality_report"] = (
    "check passed:i", f"""select "check", case when "check" = 'metadata order count' then 0 else cast(passed as int) end as passed from ({BODIES["dq_report"][1]}) as r"""
)
# One cell of the orders was made unreadable, and one store too many is stated.
BODIES["dq_csv_bundle"] = (
    "check passed:i detail",
    "\nunion all ".join(
        f"select '{t}: readable records' as \"check\", {int(t != 'fact_orders')} as passed, 'records=' || count(*) || ';unreadable={int(t == 'fact_orders')}' as detail from {t} "
        f"union all select '{t}: stated rows', {int(t != 'dim_stores')}, 'stated=' || (count(*) + {int(t == 'dim_stores')}) || ';found=' || count(*) from {t}"
        for t in STAR
    ),
)
