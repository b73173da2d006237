"""DuckDB SQL for the registered queries: questions, checks and loads over the models."""

from __future__ import annotations

import re

from souk_oracle.models import MODELS, avg, ratio, rnd, sales, take_rate_figures

QUESTIONS: dict[str, str] = {}

QUESTIONS["national_leg_split"] = f"""
with means as (select avg(approval_days) as a, avg(handling_days) as h, avg(transit_days) as t,
                 avg(delivery_days) as d from sold_orders where delivered_at is not null)
select 'approval' as leg, {rnd("a", 2)} as days, {ratio("a", "d")} as share_of_delivery from means
union all select 'handling', {rnd("h", 2)}, {ratio("h", "d")} from means
union all select 'transit', {rnd("t", 2)}, {ratio("t", "d")} from means
"""

QUESTIONS["take_rate_global"] = f"""
select cast(sum(platform_margin) as decimal(28,2)) as platform_margin,
  cast(sum(gmv) as decimal(28,2)) as gmv,
  {ratio("sum(platform_margin)", "sum(gmv)")} as effective_rate,
  {rnd("avg(effective_rate)", 4)} as mean_of_monthly_rates
from take_rate
"""

QUESTIONS["take_rate_scenarios"] = f"""
select cast(commission as double) as commission, gmv,
  {take_rate_figures("commission")}
from (select cast(sum(gmv) as decimal(28,2)) as gmv,
        cast(sum(product_revenue) as decimal(28,2)) as product_revenue from months)
cross join (select cast(unnest([0.10, 0.12, 0.15, 0.18, 0.20]) as decimal(6,4)) as commission)
"""

QUESTIONS["share_over_500km"] = f"""
select count(*) as located_orders, count(*) filter (where distance_km >= 500) as orders_over_500km,
  {ratio("count(*) filter (where distance_km >= 500)", "count(*)")} as share_over_500km
from distant_orders
"""

QUESTIONS["categories_to_80pct"] = """
select min(rank) filter (where cumulative_share >= 0.8) as categories_to_80pct,
  count(*) as categories from sales_by_category
"""

QUESTIONS["concentration_headline"] = f"""
with shares as (select dimension, tier, list_sum(members) as revenue,
                  list_sum(revenues) as all_revenue from tier_members)
select
  (select {ratio("sum(revenue)", "max(all_revenue)")} from shares
   where dimension = 'categories' and tier = 'Top 10') as top10_category_share,
  (select {ratio("sum(revenue)", "max(all_revenue)")} from shares
   where dimension = 'sellers' and tier = 'Top 10%') as seller_tier_top10pct_share,
  (select {ratio("sum(revenue)", "max(all_revenue)")} from shares
   where dimension = 'sellers' and tier in ('Top 10', 'Top 1%', 'Top 10%'))
    as seller_top_decile_share
"""

QUESTIONS["month1_retention_mature"] = """
select cohort_month, cohort_customers, retention_rate, observable_months from cohort_retention
where months_since_first = 1 and observable_months >= 13 order by cohort_month
"""

QUESTIONS["punctuality_national"] = "select * from punctuality_national"

QUESTIONS["status_ranked"] = "select * from order_status_mix order by orders desc, order_status"

_TOP_CITIES = f"""
select city, state, orders, product_revenue, gmv,
  {ratio("gmv", "(select sum(paid_value) from sold_orders)")} as gmv_share
from sales_by_city where {{condition}} order by product_revenue desc, city, state limit 20
"""
QUESTIONS["top_cities"] = _TOP_CITIES.format(condition="is_significant")
QUESTIONS["top_cities_any_size"] = _TOP_CITIES.format(condition="true")

QUESTIONS["states_by_p90"] = """
select state, delivered_orders, avg_delivery_days, p90_days, courier_share
from delivery_time_by_state where is_significant order by p90_days desc, state
"""

QUESTIONS["monthly_trend_clean"] = """
select month, orders, product_revenue, revenue_mom, revenue_yoy from monthly_sales
where not is_edge_month order by month
"""

QUESTIONS["days_without_sales"] = """
select date, day_name, is_weekend from dim_date
where date not in (select purchase_date from fact_orders) order by date
"""

QUESTIONS["segment_counts"] = """
select segment, count(*) as customers from dim_customers group by segment
"""

QUESTIONS["frequency_histogram"] = """
select order_count, count(*) as customers from dim_customers group by order_count
"""

QUESTIONS["rfm_points"] = """
select customer_uid, recency_days, order_count as frequency, paid_total as monetary
from dim_customers
"""

QUESTIONS["score_by_category_significant"] = """
select category, reviewed_orders, avg_score, positive, negative from score_by_category
where is_significant order by avg_score desc, category
"""

QUESTIONS["freight_heatmap"] = """
select category,
  max(freight_ratio) filter (where weight_bucket = 'light (<500g)') as light,
  max(freight_ratio) filter (where weight_bucket = 'medium (500g-2kg)') as medium,
  max(freight_ratio) filter (where weight_bucket = 'heavy (2kg-5kg)') as heavy,
  max(freight_ratio) filter (where weight_bucket = 'very heavy (5kg+)') as very_heavy
from freight_erosion group by category
"""

QUESTIONS["seller_ranking"] = """
select seller_id, product_revenue, orders, avg_delivery_days, late_rate, cancel_rate, avg_score
from seller_scorecard where is_significant order by product_revenue desc, seller_id
"""

QUESTIONS["payment_volume_share"] = """
select payment_type, paid_volume, order_share from payment_method_mix
order by paid_volume desc, payment_type
"""

QUESTIONS["category_by_month"] = """
select category, purchase_month as month, count(*) as items,
  cast(sum(product_revenue) as decimal(28,2)) as product_revenue
from sold_items group by category, purchase_month
"""

QUESTIONS["delay_by_seller_state"] = f"""
select seller_state, count(*) as seller_orders,
  {ratio("count(*) filter (where not is_on_time)", "count(*)")} as late_rate,
  {avg("delivery_days", 1)} as avg_delivery_days
from (select distinct seller_state, seller_id, order_id, is_on_time, delivery_days from sold_items)
group by seller_state
"""

QUESTIONS["ticket_rank_states"] = """
select state, orders, avg_paid_ticket, avg_installments from ticket_by_state
where is_significant order by avg_paid_ticket desc, state
"""

QUESTIONS["orders_per_customer"] = f"""
select delivered_orders, unique_customers,
  {ratio("delivered_orders", "unique_customers")} as orders_per_customer,
  {ratio("freight_total", "gmv")} as freight_share_of_gmv
from executive_summary
"""

QUESTIONS["sales_by_state"] = f"""
select customer_state as state, count(*) as orders, {sales()} from sold_orders group by all
"""

QUESTIONS["promise_vs_actual"] = f"""
select customer_state as state, count(*) as orders,
  {avg("promised_at::date - purchase_date", 1)} as avg_promised_days,
  {avg("delivered_at::date - purchase_date", 1)} as avg_actual_days
from sold_orders where delivered_at is not null and promised_at is not null group by customer_state
"""

QUESTIONS["orders_by_method_count"] = """
select methods, count(*) as orders
from (select count(*) as methods from order_methods group by order_id) group by methods
"""

QUESTIONS["take_rate_override"] = f"""
select month, orders, gmv, product_revenue, cast(0.18 as double) as assumed_commission,
  cast(0.025 as double) as assumed_fee,
  {take_rate_figures("cast(0.18 as decimal(6,4))", "cast(0.025 as decimal(6,4))")}
from months
"""

QUESTIONS["view_statement"] = """
select segment, state, count(*) as customers, cast(sum(paid_total) as decimal(38,2)) as paid
from dim_customers group by segment, state
"""

CHECKS: dict[str, str] = {}

CHECKS["dq_unique"] = """
select 'customer_uid' as "column", cast(customer_uid as varchar) as value, count(*) as failures
from stg_customers group by customer_uid having count(*) > 1
"""

_ORDER_COLUMNS = """order_id customer_id customer_uid customer_state customer_city order_status
purchase_date purchase_month approved_at shipped_at delivered_at promised_at item_count seller_count
product_revenue freight paid_value paid_imputed max_installments approval_days handling_days
transit_days delivery_days days_vs_promise is_on_time is_delivered is_cancelled review_score
review_count""".split()
CHECKS["dq_not_null"] = "select * from (" + " union all ".join(
    f"""select '{c}' as "column", cast(null as varchar) as value,
    count(*) filter (where {c} is null) as failures from fact_orders"""
    for c in _ORDER_COLUMNS
) + ") where failures > 0"

CHECKS["dq_accepted_values"] = """
select 'payment_type' as "column", payment_type as value, count(*) as failures
from stg_payments where payment_type not in ('credit_card', 'boleto') group by payment_type
"""

CHECKS["dq_relationships"] = """
select order_id as value, count(*) as failures from stg_reviews
where order_id not in (select order_id from stg_orders) group by order_id
"""

CHECKS["dq_relationships_payments"] = """
select order_id as value, count(*) as failures from stg_payments
where order_id not in (select order_id from stg_orders) group by order_id
"""

CHECKS["dq_unique_combination"] = """
select l_orderkey, l_linenumber, count(*) as failures from lineitem
group by l_orderkey, l_linenumber having count(*) > 1
"""

CHECKS["dq_one_row"] = """
select count(*) as rows from executive_summary having count(*) <> 1
"""

CHECKS["dq_one_row_violated"] = """
select count(*) as rows from sales_by_city having count(*) <> 1
"""

# The rates that must lie between 0 and 1
_RATES = [
    ("executive_summary", "on_time_rate"),
    ("executive_summary", "on_time_rate_global"),
    ("executive_summary", "recurrent_rate"),
    ("executive_summary", "cancel_rate"),
    ("order_status_mix", "share"),
    ("distance_vs_delivery", "late_rate"),
    ("seller_scorecard", "late_rate"),
    ("seller_scorecard", "cancel_rate"),
    ("punctuality_vs_score", "negative_rate"),
    ("sales_by_category", "revenue_share"),
    ("revenue_concentration", "revenue_share"),
    ("cohort_retention", "retention_rate"),
]
_ALL_RATES = " union all ".join(
    f"select '{model}.{column}' as metric, {column} as value from {model}"
    for model, column in _RATES
)
CHECKS["dq_rates_in_range"] = f"""
select * from ({_ALL_RATES}) where value is not null and (value < 0 or value > 1)
"""
CHECKS["dq_rates_report"] = f"""
select metric, count(*) as figures, count(value) as known, min(value) as lowest,
  max(value) as highest
from ({_ALL_RATES}) group by metric
"""

# The totals that must agree with the item fact
_TOTALS = [
    ("sales_by_city", "sales_by_city", "sum(product_revenue)", "revenue"),
    ("monthly_sales", "monthly_sales", "sum(product_revenue)", "revenue"),
    ("sales_by_category", "sales_by_category", "sum(product_revenue)", "revenue"),
    ("executive_summary", "executive_summary", "sum(product_revenue)", "revenue"),
    ("take_rate", "take_rate", "sum(product_revenue)", "revenue"),
    ("sales_by_city.orders", "sales_by_city", "sum(orders)", "orders"),
    ("monthly_sales.orders", "monthly_sales", "sum(orders)", "orders"),
    ("executive_summary.orders", "executive_summary", "sum(delivered_orders)", "orders"),
]
_TRUTH = {"revenue": "sum(product_revenue)", "orders": "count(distinct order_id)"}
_COMPARISONS = " union all ".join(
    f"""select '{name}' as mart, cast((select {total} from {model}) as decimal(38,2)) as value,
    cast((select {_TRUTH[truth]} from sold_items) as decimal(38,2)) as expected"""
    for name, model, total, truth in _TOTALS
)
CHECKS["dq_reconciliation_report"] = f"""
select *, cast(value - expected as decimal(38,2)) as difference from ({_COMPARISONS})
"""
CHECKS["dq_reconciliation"] = f"""
select * from (select *, cast(value - expected as decimal(38,2)) as difference
               from ({_COMPARISONS}))
where difference is null or abs(difference) > 0.01
"""


def suite_sql(declared: dict) -> str:
    """One row per declared check, by the same rules as the single checks above."""
    parts = []

    def part(check: str, model: str, columns: str, failures: str) -> None:
        parts.append(
            f"""select '{check}' as "check", '{model}' as model, '{columns}' as columns,
            cast(({failures}) as bigint) as failures"""
        )

    for model, checks in declared.items():
        for c in checks.not_null:
            part("not_null", model, c, f"select count(*) from {model} where {c} is null")
        for c in checks.unique:
            part("unique", model, c, f"""select count(*) from (select {c} from {model}
                where {c} is not null group by {c} having count(*) > 1)""")
        for c, values in checks.accepted.items():
            listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
            part("accepted_values", model, c, f"""select count(*) from {model}
                where {c} is not null and {c} not in ({listed})""")
        for c, (parent, key) in checks.relationships.items():
            part("relationships", model, c, f"""select count(*) from {model} child
                where {c} is not null and not exists
                  (select 1 from {parent} parent where parent.{key} = child.{c})""")
        for columns in checks.combinations:
            listed = ", ".join(columns)
            part("unique_combination", model, listed, f"""select count(*) from
                (select {listed} from {model} group by {listed} having count(*) > 1)""")
    part("one_row", "executive_summary", "", "select count(*) from dq_one_row")
    part("rates_in_range", "", "", "select count(*) from dq_rates_in_range")
    part("reconciliation", "fact_order_items", "", "select count(*) from dq_reconciliation")
    return " union all ".join(parts)


# Loads read the CSV files derived from the raw tables. Per fifty item records one is too
# long (skipped), one lacks its freight and one has NA for its price; of the reviews, one in
# forty has the wrong width (skipped).
LOADS: dict[str, str] = {}

_SPOT = "(order_id * 7 + item_no) % 50"
LOADS["loaded_items"] = f"""
select cast(order_id as varchar) as order_id, cast(item_no as varchar) as order_item_id,
  cast(product_id as varchar) as product_id, cast(seller_id as varchar) as seller_id,
  case when {_SPOT} <> 2 then cast(price as varchar) end as price,
  case when {_SPOT} <> 1 then cast(freight as varchar) end as freight_value
from stg_order_items where {_SPOT} <> 0
"""
LOADS["loaded_reviews"] = r"""
select cast(review_id as varchar) as review_id, cast(order_id as varchar) as order_id,
  cast(score as varchar) as review_score, '' as review_comment_title,
  'said "' || message || '",' || chr(10) || 'score ' || cast(score as varchar)
    as review_comment_message,
  cast(created_at as varchar) as review_creation_date,
  cast(answered_at as varchar) as review_answer_timestamp
from stg_reviews where review_id % 40 <> 3
"""

LOAD_QUERIES: dict[str, str] = {}
LOAD_QUERIES["ingest_tolerant"] = "select * from loaded_items"
LOAD_QUERIES["ingest_strict"] = "select * from loaded_reviews"
LOAD_QUERIES["ingest_quarantine"] = f"""
select 'raw_order_items' as "table", concat_ws(',', order_id, item_no, product_id, seller_id,
  price, freight, 'surplus') as record
from stg_order_items where {_SPOT} = 0
union all
select 'raw_reviews', concat_ws(',', review_id, order_id, score, cast(created_at as varchar),
  cast(answered_at as varchar)) || case when review_id % 80 = 3 then '' else ',a,b,c' end
from stg_reviews where review_id % 40 = 3
"""


def _load_stats() -> str:
    whole = [
        ("raw_orders", "stg_orders"),
        ("raw_customers", "stg_customers"),
        ("raw_payments", "stg_payments"),
        ("raw_products", "stg_products"),
        ("raw_sellers", "stg_sellers"),
        ("raw_geolocation", "located_customers"),
    ]
    parts = [
        f"""select '{table}' as "table", count(*) as loaded, 0 as skipped from {model}"""
        for table, model in whole
    ]
    parts.append(
        """select 'raw_category_translation', count(distinct p_brand), 0 from part"""
    )
    parts.append(
        f"""select 'raw_order_items', count(*) filter (where {_SPOT} <> 0),
        count(*) filter (where {_SPOT} = 0) from stg_order_items"""
    )
    parts.append(
        """select 'raw_reviews', count(*) filter (where review_id % 40 <> 3),
        count(*) filter (where review_id % 40 = 3) from stg_reviews"""
    )
    return f"""
    select "table", loaded as rows_loaded, skipped as rows_skipped,
      {ratio("skipped * 100", "(loaded + skipped)", 1)} as skipped_pct
    from ({" union all ".join(parts)})
    """


LOAD_QUERIES["ingest_load_stats"] = _load_stats()
LOAD_QUERIES["full_replace"] = "select order_status, count(*) as orders from stg_orders group by 1"

# The same chain of models over the tables as loaded from the files
LOADED_ITEMS = f"""
select order_id, item_no, product_id, seller_id,
  case when {_SPOT} <> 2 then price end as price,
  case when {_SPOT} <> 1 then freight end as freight
from delivered_items where {_SPOT} <> 0
"""
LOADED_REVIEWS = "select * from delivered_reviews where review_id % 40 <> 3"


def loaded_models() -> dict[str, str]:
    return {
        **MODELS,
        "delivered_items": MODELS["stg_order_items"],
        "delivered_reviews": MODELS["stg_reviews"],
        "stg_order_items": LOADED_ITEMS,
        "stg_reviews": LOADED_REVIEWS,
    }


def complete(query: str, parts: dict[str, str]) -> str:
    """The query with every part it needs, as common table expressions in order."""
    needed: dict[str, None] = {}

    def visit(sql: str, owner: str | None) -> None:
        words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", sql)))
        for name in parts:
            if name in words and name != owner and name not in needed:
                visit(parts[name], name)
                needed[name] = None

    visit(query, None)
    if not needed:
        return query.strip()
    ctes = ",\n".join(f"{name} as materialized ({parts[name].strip()})" for name in needed)
    return f"with {ctes}\nselect * from ({query.strip()})"
