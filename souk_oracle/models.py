"""DuckDB SQL for every model, written from the definitions and not from the Spark code.

Each entry is the body of one common table expression over the driver tables.
"""

from __future__ import annotations


def rnd(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,{digits + 6})), {digits}) as double)"


def ratio(numerator: str, denominator: str, digits: int = 4) -> str:
    return rnd(
        f"cast({numerator} as double) / nullif(cast({denominator} as double), 0)", digits
    )


def avg(value: str, digits: int) -> str:
    return ratio(f"sum({value})", f"count({value})", digits)


def _bucket(value: str, bounds: list[tuple[int, str]], last: str) -> str:
    whens = " ".join(f"when {value} < {bound} then '{label}'" for bound, label in bounds)
    return f"case {whens} else '{last}' end"


WEIGHT = _bucket(
    "billable_weight_g",
    [(500, "light (<500g)"), (2000, "medium (500g-2kg)"), (5000, "heavy (2kg-5kg)")],
    "very heavy (5kg+)",
)
DISTANCE = _bucket(
    "distance_km",
    [(100, "local (<100km)"), (500, "regional (100-500km)"), (1500, "national (500-1500km)")],
    "long distance (1500km+)",
)
PUNCTUALITY = """['early', 'on day', 'late (1-3 days)', 'very late (4+ days)'][
    1 + cast(days_vs_promise >= 0 as int) + cast(days_vs_promise > 0 as int)
      + cast(days_vs_promise > 3 as int)]"""

MONEY = "decimal(28,2)"


def sales(where: str = "true") -> str:
    """Orders and their money over orders that fulfil the condition."""
    kept = f"filter (where {where})"
    return f"""cast(sum(product_revenue) {kept} as {MONEY}) as product_revenue,
  cast(sum(freight) {kept} as {MONEY}) as freight_total,
  cast(sum(paid_value) {kept} as {MONEY}) as gmv"""



MODELS: dict[str, str] = {}

MODELS["order_days"] = """
select * replace (o_orderdate + to_months(
  case strftime(o_orderdate, '%Y-%m') when '1996-05' then 1
    when '1995-01' then cast(o_orderkey % 40 <> 0 as int) else 0 end) as o_orderdate)
from orders
"""

MODELS["ordered_lines"] = "select distinct l_orderkey as line_order from lineitem"

MODELS["order_states"] = """
select o_orderkey as k, o_orderdate as day0,
  case when line_order is null then 'unavailable'
       when o_orderstatus in ('F', 'O') then 'delivered'
       else ['shipped', 'canceled', 'unavailable', 'invoiced', 'processing', 'created',
             'approved'][cast(o_orderkey % 7 as int) + 1] end as order_status
from order_days left join ordered_lines on line_order = o_orderkey
"""

MODELS["stg_orders"] = """
select k as order_id, k as customer_id, order_status,
  day0 + to_minutes(k * 37 % 1440) as purchased_at,
  case when k % 97 <> 0 then day0 + to_minutes(k * 37 % 1440 + k * 13 % 2880) end as approved_at,
  case when order_status not in ('created', 'approved', 'invoiced', 'processing', 'unavailable')
       then day0 + to_hours(48 + k * 31 % 240) end as shipped_at,
  case when order_status = 'delivered' and k % 211 <> 0
       then day0 + to_hours(72 + k * 31 % 240 + k * 17 % 600) end as delivered_at,
  day0 + to_days(cast(12 + k % 25 as int)) as promised_at
from order_states
"""

MODELS["stg_customers"] = """
select o_orderkey as customer_id, c_custkey as customer_uid,
  case when c_custkey % 3 = 0 then 'capital'
    else 'city_' || cast((c_custkey + o_orderkey % 3) % 60 as varchar) end as city,
  n_name as state,
  cast(c_nationkey * 100 + c_custkey % 10 as bigint) as zip_prefix
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
"""

MODELS["stg_order_items"] = """
select l_orderkey as order_id,
  row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
    l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus)
    as item_no,
  l_partkey as product_id, l_suppkey * 20 + l_partkey % 20 as seller_id,
  cast(l_extendedprice as decimal(18,2)) as price,
  cast(l_quantity * 1.25 as decimal(18,2)) as freight
from lineitem
"""

MODELS["stg_payments"] = """
select case when k % 2495 = 0 then -1 - k when k % 499 = 0 then k - 1 else k end as order_id,
  cast(nth + case when k % 499 = 0 then 2 else 0 end as bigint) as payment_seq,
  case when nth = 2 then 'voucher' when k % 4 = 0 then 'boleto' when k % 4 = 1 then 'debit_card'
    else 'credit_card' end as payment_type,
  cast(case when nth = 1 and k % 4 > 1 then 1 + k % 10 else 1 end as bigint) as installments,
  cast(case nth when 1 then total else 25.50 end as decimal(18,2)) as payment_value
from (select o_orderkey as k, o_totalprice as total,
        unnest(case when o_orderkey % 45 = 0 then [1, 2] else [1] end) as nth from orders)
"""

MODELS["stg_reviews"] = """
select event_id as review_id, (event_id * 7919 + shift) % n as order_id,
  cast(1 + cast(floor(value) as bigint) % 5 as bigint) as score,
  '' as title, props as message, ts as created_at, ts as answered_at
from events
cross join (select max(o_orderkey) + 1 + max(o_orderkey) // 50 as n from orders)
cross join (values (0), (1)) as shifts(shift)
where shift = 0 or event_type = 'error'
"""

MODELS["stg_products"] = """
select p_partkey as product_id, category_src, translation.category_en,
  case when p_partkey % 53 <> 0 then cast(p_size as bigint) * p_size * 4 end as weight_g,
  5 + p_partkey % 40 as length_cm, 3 + p_partkey % 23 as height_cm,
  case when p_partkey % 71 <> 0 then 4 + p_partkey % 31 end as width_cm
from (select *, case when p_partkey % 61 <> 0 then p_brand end as category_src from part)
left join (select distinct p_brand, case when p_brand <> 'Brand#7' then lower(p_brand) end
             as category_en from part) as translation on translation.p_brand = category_src
"""

MODELS["stg_sellers"] = """
select s_suppkey * 20 + slot as seller_id,
  'city_' || cast(s_suppkey % 37 as varchar) as city, n_name as state,
  cast(s_nationkey * 100 + s_suppkey % 10 as bigint) as zip_prefix
from supplier join nation on n_nationkey = s_nationkey cross join range(20) as slots(slot)
"""

MODELS["located_customers"] = """
select cast(c_nationkey * 100 + c_custkey % 10
    + case c_nationkey when 24 then 50 else 0 end as bigint) as zip_prefix,
  cast(-30 + 0.9 * c_nationkey + 0.001 * (c_custkey % 100) as decimal(18,3)) as lat,
  cast(-60 + 0.6 * (c_nationkey * 7 % 25) + 0.001 * (c_custkey % 90) as decimal(18,3)) as lng
from customer
"""

MODELS["stg_geolocation"] = """
select zip_prefix, cast(sum(lat) as double) / count(*) as lat,
  cast(sum(lng) as double) / count(*) as lng
from located_customers group by zip_prefix
"""

MODELS["payments_per_order"] = """
select order_id, cast(sum(payment_value) as decimal(18,2)) as order_paid_total,
  max(installments) as max_installments
from stg_payments group by order_id
"""

MODELS["paid_purchases"] = """
select customer_uid, order_id, cast(purchased_at as date) as bought, order_paid_total, city, state,
  row_number() over (partition by customer_uid
    order by cast(purchased_at as date) desc, order_id desc) as recent
from stg_orders join stg_customers using (customer_id) join payments_per_order using (order_id)
where order_status = 'delivered'
"""

MODELS["dim_customers"] = f"""
select customer_uid, max(city) filter (where recent = 1) as city,
  max(state) filter (where recent = 1) as state,
  count(distinct order_id) as order_count,
  cast(sum(order_paid_total) as decimal(18,2)) as paid_total,
  {avg("order_paid_total", 2)} as avg_paid_ticket,
  min(bought) as first_purchase, max(bought) as last_purchase,
  date_diff('day', max(bought), (select cast(max(purchased_at) as date) from stg_orders
                                 where order_status = 'delivered')) as recency_days,
  case when count(distinct order_id) > 1 then 'recurrent' else 'one_time' end as segment,
  cast(date_trunc('month', min(bought)) as date) as cohort_month
from paid_purchases group by customer_uid
"""

MODELS["weighed_products"] = """
select *, length_cm * height_cm * width_cm as volume_cm3,
  case when weight_g is not null and length_cm * height_cm * width_cm is not null
       then greatest(cast(weight_g as double),
                     cast(length_cm * height_cm * width_cm as double) / cast(6 as double)) end
    as billable_weight_g
from stg_products
"""

MODELS["dim_products"] = f"""
select product_id, category_src, coalesce(category_en, 'Uncategorized') as category, weight_g,
  length_cm, height_cm, width_cm, volume_cm3, billable_weight_g, {WEIGHT} as weight_bucket
from weighed_products
"""

MODELS["dim_sellers"] = """
select seller_id, city, state, zip_prefix, lat, lng
from stg_sellers left join stg_geolocation using (zip_prefix)
"""

MODELS["dim_date"] = """
select cast(day as date) as date, year(day) as year, month(day) as month,
  strftime(day, '%Y-%m') as year_month, cast(date_trunc('month', day) as date) as month_start,
  quarter(day) as quarter, dayofweek(day) + 1 as day_of_week, dayname(day) as day_name,
  dayofweek(day) in (0, 6) as is_weekend
from (select unnest(generate_series(
        (select min(purchased_at)::date::timestamp from stg_orders),
        (select max(purchased_at)::date::timestamp from stg_orders), interval 1 day)) as day)
"""

MODELS["order_parts"] = """
select order_id, nullif(count(item_no), 0) as item_count,
  nullif(count(distinct seller_id), 0) as seller_count,
  cast(sum(price) as decimal(28,2)) as product_revenue, cast(sum(freight) as decimal(28,2)) as freight,
  cast(sum(payment_value) as decimal(28,2)) as paid, max(installments) as max_installments,
  cast(sum(score) as double) / count(score) as review_score,
  nullif(count(distinct review_id), 0) as review_count
from (select order_id, item_no, seller_id, price, freight from stg_order_items
      union all by name select order_id, payment_value, installments from stg_payments
      union all by name select order_id, review_id, score from stg_reviews)
group by order_id
"""

MODELS["fact_orders"] = """
select order_id, customer_id, customer_uid, state as customer_state, city as customer_city,
  order_status, bought_on as purchase_date, cast(date_trunc('month', bought_on) as date) as purchase_month,
  approved_at, shipped_at, delivered_at, promised_at,
  item_count, seller_count, product_revenue, freight,
  cast(case when paid is null then product_revenue + freight else paid end as decimal(28,2))
    as paid_value,
  paid is null and product_revenue is not null as paid_imputed, max_installments,
  hours[1] / cast(24 as double) as approval_days, hours[2] / cast(24 as double) as handling_days,
  hours[3] / cast(24 as double) as transit_days,
  arrived_on - bought_on as delivery_days, arrived_on - cast(promised_at as date) as days_vs_promise,
  delivered_at <= promised_at as is_on_time,
  order_status = 'delivered' as is_delivered,
  order_status in ('canceled', 'unavailable') as is_cancelled,
  review_score, review_count
from (select *, cast(purchased_at as date) as bought_on, cast(delivered_at as date) as arrived_on,
        [date_sub('hour', purchased_at, approved_at), date_sub('hour', approved_at, shipped_at),
         date_sub('hour', shipped_at, delivered_at)] as hours from stg_orders)
join stg_customers using (customer_id) left join order_parts using (order_id)
"""

MODELS["fact_order_items"] = """
select i.order_id, i.item_no, f.customer_uid, i.product_id, i.seller_id, f.purchase_date,
  f.purchase_month, p.category, p.weight_bucket, p.billable_weight_g, f.customer_state,
  s.state as seller_state, f.order_status, f.is_delivered, i.price as product_revenue, i.freight,
  case when b.lat is not null and s.lat is not null then round(2 * 6371.0 * asin(least(1.0, sqrt(
      pow(sin(radians(s.lat - b.lat) / 2), 2)
      + cos(radians(b.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lng - b.lng) / 2), 2)))), 6)
  end as distance_km,
  f.delivery_days, f.is_on_time, f.review_score as order_score
from stg_order_items i join fact_orders f using (order_id)
join dim_products p using (product_id) join dim_sellers s using (seller_id)
join stg_customers c on c.customer_id = f.customer_id
left join stg_geolocation b on b.zip_prefix = c.zip_prefix
"""

MODELS["sold_orders"] = "select * from fact_orders where is_delivered"
MODELS["sold_items"] = "select * from fact_order_items where is_delivered"

MODELS["active_months"] = """
select cohort_month, customer_uid, date_diff('month', cohort_month, purchase_month) as distance,
  sum(paid_value) as paid
from dim_customers join sold_orders using (customer_uid) group by all
"""

MODELS["cohort_retention"] = f"""
select cohort_month, distance as months_since_first, founders as cohort_customers,
  active as active_customers, {ratio("active", "founders")} as retention_rate,
  cast(paid as {MONEY}) as period_revenue, {ratio("paid", "founders", 2)} as revenue_per_cohort_customer,
  date_diff('month', cohort_month, (select max(purchase_month) from sold_orders)) as observable_months
from (select cohort_month, distance, count(*) as active, sum(paid) as paid,
        max(case distance when 0 then count(*) end) over (partition by cohort_month) as founders
      from active_months group by cohort_month, distance)
where founders is not null
"""

MODELS["sales_by_city"] = f"""
select customer_city as city, customer_state as state, count(*) as orders, {sales()},
  count(*) >= 100 as is_significant
from sold_orders group by customer_city, customer_state
"""

MODELS["months"] = f"""
select purchase_month as month, count(*) as orders, count(distinct customer_uid) as unique_customers,
  {sales()}, {avg("product_revenue", 2)} as avg_product_ticket
from sold_orders group by purchase_month
"""


def growth(column: str, months: int) -> str:
    """Change against the month that many months before, if both have 100 orders."""
    frame = f"""over (order by month
      range between interval {months} month preceding and interval {months} month preceding)"""
    then = f"max(case when orders >= 100 then {column} end) {frame}"
    return f"case when orders >= 100 then {ratio(f'({column} - {then})', then)} end"


MODELS["monthly_sales"] = f"""
select *, {growth("product_revenue", 1)} as revenue_mom, {growth("orders", 1)} as orders_mom,
  {growth("product_revenue", 12)} as revenue_yoy,
  lag(month) over (order by month) is null or lead(month) over (order by month) is null
    as is_edge_month
from months
"""

MODELS["category_parts"] = """
select category, grouping_id(product_id, seller_id, order_id) as part, count(*) as items,
  count(product_revenue) as priced, sum(product_revenue) as revenue, sum(freight) as freight
from sold_items
group by grouping sets ((category), (category, product_id), (category, seller_id), (category, order_id))
"""

MODELS["sales_by_category"] = f"""
select w.category, w.items, n.orders, n.distinct_products, n.distinct_sellers,
  cast(w.revenue as {MONEY}) as product_revenue, cast(w.freight as {MONEY}) as freight_total,
  {ratio("w.revenue", "w.priced", 2)} as avg_item_price,
  {ratio("w.freight", "w.revenue")} as freight_ratio,
  {ratio("w.revenue", "sum(w.revenue) over ()")} as revenue_share,
  {ratio("sum(w.revenue) over (ranking rows unbounded preceding)", "sum(w.revenue) over ()")}
    as cumulative_share,
  row_number() over ranking as rank
from (select * from category_parts where part = 7) as w
join (select category, count(*) filter (where part = 6) as orders,
        count(*) filter (where part = 3) as distinct_products,
        count(*) filter (where part = 5) as distinct_sellers
      from category_parts group by category) as n on n.category = w.category
window ranking as (order by w.revenue desc, w.category)
"""

MODELS["earners"] = """
select dimension, list(revenue order by revenue desc, entity) as revenues
from (select case grouping(seller_id) when 0 then 'sellers' else 'categories' end as dimension,
        coalesce(cast(seller_id as varchar), category) as entity, sum(product_revenue) as revenue
      from sold_items group by grouping sets ((seller_id), (category)))
group by dimension
"""

MODELS["tier_members"] = """
select dimension, revenues, len(revenues) as entities_total, unnest(['Top 10', 'Top 1%', 'Top 10%', 'Rest'])
    as tier,
  unnest([revenues[:a], revenues[a + 1:b], revenues[b + 1:c], revenues[c + 1:]]) as members
from (select *, greatest(b, cast(ceil(len(revenues) * cast(0.10 as double)) as bigint)) as c
      from (select *, greatest(a, cast(ceil(len(revenues) * cast(0.01 as double)) as bigint)) as b
            from (select *, least(10, len(revenues)) as a from earners)))
"""

MODELS["revenue_concentration"] = f"""
select dimension, tier, entities_total, len(members) as entities_in_tier,
  cast(list_sum(members) as {MONEY}) as revenue,
  {ratio("list_sum(members)", "list_sum(revenues)")} as revenue_share
from tier_members where len(members) > 0
"""

MODELS["distant_orders"] = """
select far.distance_km, far.freight, delivery_days, is_on_time, review_score as order_score
from sold_orders join (
  select order_id, max(distance_km) as distance_km,
    sum(freight) filter (where distance_km is not null) as freight
  from fact_order_items group by order_id) as far using (order_id)
where far.distance_km is not null
"""

MODELS["distance_vs_delivery"] = f"""
select {DISTANCE} as distance_bucket, count(*) as orders,
  {avg("distance_km", 1)} as avg_distance_km, {avg("freight", 2)} as avg_freight,
  {avg("delivery_days", 1)} as avg_delivery_days,
  {ratio("count(*) filter (where not is_on_time)", "count(*)")} as late_rate,
  {avg("order_score", 2)} as avg_score
from distant_orders group by all
"""

MODELS["arrivals"] = f"""
select customer_state as state, {PUNCTUALITY} as punctuality_bucket, review_score
from sold_orders where delivered_at is not null and promised_at is not null
"""

_PUNCTUALITY_FIGURES = f"""count(*) as orders, {avg("review_score", 2)} as avg_score,
  {ratio("count(*) filter (where review_score <= 2)", "count(review_score)")} as negative_rate"""

MODELS["punctuality_vs_score"] = f"""
select state, punctuality_bucket, {_PUNCTUALITY_FIGURES} from arrivals group by all
"""

MODELS["punctuality_national"] = f"""
select punctuality_bucket, {_PUNCTUALITY_FIGURES} from arrivals group by all
"""

MODELS["delivery_time_by_state"] = f"""
select customer_state as state, count(*) as delivered_orders,
  {avg("delivery_days", 1)} as avg_delivery_days,
  quantile_disc(delivery_days, 0.5) as p50_days, quantile_disc(delivery_days, 0.9) as p90_days,
  {avg("approval_days", 2)} as avg_approval_days, {avg("handling_days", 2)} as avg_handling_days,
  {avg("transit_days", 2)} as avg_transit_days,
  {ratio("avg(transit_days)", "avg(delivery_days)")} as courier_share,
  count(*) >= 100 as is_significant
from sold_orders where delivered_at is not null group by customer_state
"""

MODELS["order_status_mix"] = f"""
select order_status, count(*) as orders,
  {ratio("count(*)", "(select count(*) from fact_orders)")} as share
from fact_orders group by order_status
"""

MODELS["score_by_category"] = f"""
select category, count(score) as reviewed_orders, {avg("score", 2)} as avg_score,
  count(*) filter (where score >= 4) as positive, count(*) filter (where score <= 2) as negative,
  count(score) >= 100 as is_significant
from (select category, max(order_score) as score from sold_items group by category, order_id)
group by category having count(score) > 0
"""

MODELS["freight_erosion"] = f"""
select category, weight_bucket, count(*) as items,
  cast(sum(product_revenue) as decimal(28,2)) as product_revenue,
  cast(sum(freight) as decimal(28,2)) as freight_total,
  {ratio("sum(freight)", "sum(product_revenue)")} as freight_ratio,
  {avg("billable_weight_g", 0)} as avg_billable_weight_g
from sold_items where billable_weight_g is not null group by category, weight_bucket
"""

MODELS["seller_baskets"] = """
select seller_id, order_id, bool_or(is_delivered) as sold,
  bool_or(order_status in ('canceled', 'unavailable')) as cancelled,
  sum(product_revenue) as revenue, count(product_revenue) as priced,
  max(delivery_days) as delivery_days, bool_or(is_on_time) as on_time, max(order_score) as score
from fact_order_items group by seller_id, order_id
"""


def when_sold(column: str) -> str:
    return f"case when sold then {column} end"


MODELS["seller_scorecard"] = f"""
select seller_id, city, state, count(*) filter (where sold) as orders,
  cast(sum({when_sold("revenue")}) as {MONEY}) as product_revenue,
  {ratio(f'sum({when_sold("revenue")})', f'sum({when_sold("priced")})', 2)} as avg_item_price,
  {avg(when_sold("delivery_days"), 1)} as avg_delivery_days,
  {ratio("count_if(sold and not on_time)", "count_if(sold)")} as late_rate,
  {avg(when_sold("score"), 2)} as avg_score, count(*) as orders_all_status,
  {ratio("count_if(cancelled)", "count(*)")} as cancel_rate, count_if(sold) >= 20 as is_significant
from seller_baskets join dim_sellers using (seller_id)
group by seller_id, city, state having bool_or(sold)
"""

MODELS["order_methods"] = """
select payment_type, order_id, sum(payment_value) as volume, count(payment_value) as valued,
  sum(installments) as installments, count(installments) as planned,
  count_if(installments > 1) as in_installments
from stg_payments semi join sold_orders using (order_id) group by payment_type, order_id
"""

MODELS["payment_method_mix"] = f"""
select payment_type, count(*) as orders,
  {ratio("count(*)", "(select count(distinct order_id) from order_methods)")} as order_share,
  cast(sum(volume) as {MONEY}) as paid_volume, {ratio("sum(volume)", "sum(valued)", 2)} as avg_transaction,
  case payment_type when 'credit_card' then {ratio("sum(installments)", "sum(planned)", 1)} end
    as avg_installments,
  cast(sum(in_installments) as bigint) as payments_in_installments
from order_methods group by payment_type
"""


def take_rate_figures(commission: str, fee: str = "cast(0.03 as decimal(6,4))") -> str:
    margin = f"(product_revenue * {commission} - gmv * {fee})"
    return f"""cast(round(product_revenue * {commission}, 2) as decimal(28,2)) as commission_income,
  cast(round(gmv * {fee}, 2) as decimal(28,2)) as processing_cost,
  cast(round({margin}, 2) as decimal(28,2)) as platform_margin,
  {ratio(margin, "gmv")} as effective_rate"""


MODELS["take_rate"] = f"""
select month, orders, gmv, product_revenue, cast(0.15 as double) as assumed_commission,
  cast(0.03 as double) as assumed_fee, {take_rate_figures("cast(0.15 as decimal(6,4))")}
from months
"""

MODELS["ticket_by_state"] = f"""
select customer_state as state, count(*) as orders, {avg("paid_value", 2)} as avg_paid_ticket,
  {avg("product_revenue", 2)} as avg_product_ticket,
  {avg("max_installments", 1)} as avg_installments, count(*) >= 100 as is_significant
from sold_orders group by customer_state
"""

_SOLD = "filter (where is_delivered)"


def if_sold(column: str) -> str:
    return f"case when is_delivered then {column} end"


MODELS["executive_summary"] = f"""
select min(purchase_date) {_SOLD} as date_from, max(purchase_date) {_SOLD} as date_to,
  count(*) {_SOLD} as delivered_orders,
  count(distinct customer_uid) {_SOLD} as unique_customers, {sales("is_delivered")},
  {ratio(f"sum(product_revenue) {_SOLD}", "count_if(is_delivered)", 2)} as product_ticket,
  {ratio(f"sum(paid_value) {_SOLD}", "count_if(is_delivered)", 2)} as paid_ticket,
  {ratio("count_if(is_delivered and is_on_time)", f"count(is_on_time) {_SOLD}")} as on_time_rate,
  quantile_disc(delivery_days, 0.9) {_SOLD} as delivery_p90,
  {avg(if_sold("-days_vs_promise"), 1)} as promise_cushion_days,
  {avg(if_sold("review_score"), 2)} as avg_score,
  {ratio("count_if(is_on_time and left_seller)", "count_if(left_seller)")} as on_time_rate_global,
  (select {ratio("count_if(segment = 'recurrent')", "count(*)")} from dim_customers) as recurrent_rate,
  {ratio("count_if(is_cancelled)", "count(*)")} as cancel_rate
from (select *, order_status not in ('created', 'approved', 'invoiced', 'processing') as left_seller
      from fact_orders)
"""
