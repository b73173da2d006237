"""Questions that reports ask of the models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import half_up, mean, ratio, rows
from souk.operators import order_marts
from souk.operators.order_marts import delivered, total
from souk.plans.warehouse import Warehouse

# Commission values offered by the scenario question
SCENARIO_COMMISSIONS = [0.10, 0.12, 0.15, 0.18, 0.20]
# Rates of the override question
OTHER_COMMISSION, OTHER_PAYMENT_FEE = 0.18, 0.025
MATURE_MONTHS = 13
TOP_CITIES = 20


def national_leg_split(w: Warehouse) -> DataFrame:
    """Mean days of each delivery leg over all orders, and its part of the whole."""
    means = (
        delivered(w["fact_orders"])
        .where("delivered_at is not null")
        .agg(
            F.avg("approval_days").alias("approval"),
            F.avg("handling_days").alias("handling"),
            F.avg("transit_days").alias("transit"),
            F.avg("delivery_days").alias("delivery"),
        )
    )
    legs = [
        F.struct(
            F.lit(leg).alias("leg"),
            half_up(F.col(leg), 2).alias("days"),
            ratio(F.col(leg), F.col("delivery")).alias("share_of_delivery"),
        )
        for leg in ["approval", "handling", "transit"]
    ]
    return means.select(F.inline(F.array(*legs)))


def take_rate_global(w: Warehouse) -> DataFrame:
    """Ratio of sums, next to the plain mean that over-weights small months."""
    return w["take_rate"].agg(
        total("platform_margin").alias("platform_margin"),
        total("gmv").alias("gmv"),
        ratio(F.sum("platform_margin"), F.sum("gmv")).alias("effective_rate"),
        half_up(F.avg("effective_rate"), 4).alias("mean_of_monthly_rates"),
    )


def take_rate_scenarios(w: Warehouse) -> DataFrame:
    base = w["take_rate"].agg(
        total("gmv").alias("gmv"), total("product_revenue").alias("product_revenue")
    )
    rates = F.array(*[order_marts.rate(c) for c in SCENARIO_COMMISSIONS])
    scenarios = base.withColumn("rate", F.explode(rates))
    return order_marts.with_take_rate(
        scenarios, F.col("rate"), order_marts.rate(w.payment_fee)
    ).select(
        F.col("rate").cast("double").alias("commission"),
        "gmv",
        "commission_income",
        "processing_cost",
        "platform_margin",
        "effective_rate",
    )


def share_over_500km(w: Warehouse) -> DataFrame:
    far = F.col("distance_bucket").isin(labels.bucket_labels(labels.DISTANCE_BUCKETS)[2:])
    far_orders = F.coalesce(F.sum(F.when(far, F.col("orders"))), F.lit(0))
    return w["distance_vs_delivery"].agg(
        F.sum("orders").alias("located_orders"),
        far_orders.alias("orders_over_500km"),
        ratio(far_orders, F.sum("orders")).alias("share_over_500km"),
    )


def categories_to_80pct(w: Warehouse) -> DataFrame:
    return w["sales_by_category"].agg(
        F.min(F.when(F.col("cumulative_share") >= 0.8, F.col("rank"))).alias("categories_to_80pct"),
        rows().alias("categories"),
    )


def concentration_headline(w: Warehouse) -> DataFrame:
    """Tiers are disjoint, so the top tenth is reported both without and with those above."""
    tier, dimension = F.col("tier"), F.col("dimension")
    categories = dimension == labels.DIMENSION_CATEGORIES
    sellers = dimension == labels.DIMENSION_SELLERS
    revenue = F.col("revenue")

    def share(of, condition):
        held = F.coalesce(F.sum(F.when(of & condition, revenue)), F.lit(0))
        return ratio(held, F.sum(F.when(of, revenue)))

    return w["revenue_concentration"].agg(
        share(categories, tier == labels.TIER_TOP_10).alias("top10_category_share"),
        share(sellers, tier == labels.TIER_TOP_10_PCT).alias("seller_tier_top10pct_share"),
        share(sellers, tier != labels.TIER_REST).alias("seller_top_decile_share"),
    )


def month1_retention_mature(w: Warehouse) -> DataFrame:
    return (
        w["cohort_retention"]
        .where(
            (F.col("months_since_first") == 1) & (F.col("observable_months") >= MATURE_MONTHS)
        )
        .select("cohort_month", "cohort_customers", "retention_rate", "observable_months")
        .orderBy("cohort_month")
    )


def punctuality_national(w: Warehouse) -> DataFrame:
    return (
        order_marts.scored_punctuality(w["fact_orders"])
        .groupBy("punctuality_bucket")
        .agg(*order_marts.punctuality_figures())
    )


def status_ranked(w: Warehouse) -> DataFrame:
    return w["order_status_mix"].orderBy(F.desc("orders"), "order_status")


def top_cities(w: Warehouse) -> DataFrame:
    """The highest-revenue cities among the significant ones, with their part of all GMV."""
    return _ranked_cities(w, w["sales_by_city"].where("is_significant"))


def top_cities_any_size(w: Warehouse) -> DataFrame:
    return _ranked_cities(w, w["sales_by_city"])


def _ranked_cities(w: Warehouse, cities: DataFrame) -> DataFrame:
    gmv = delivered(w["fact_orders"]).agg(F.sum("paid_value")).scalar()
    return (
        cities.orderBy(F.desc("product_revenue"), "city", "state")
        .limit(TOP_CITIES)
        .select(
            "city", "state", "orders", "product_revenue", "gmv",
            ratio(F.col("gmv"), gmv).alias("gmv_share"),
        )
    )


def states_by_p90(w: Warehouse) -> DataFrame:
    return (
        w["delivery_time_by_state"]
        .where("is_significant")
        .select("state", "delivered_orders", "avg_delivery_days", "p90_days", "courier_share")
        .orderBy(F.desc("p90_days"), "state")
    )


def monthly_trend_clean(w: Warehouse) -> DataFrame:
    return (
        w["monthly_sales"]
        .where("not is_edge_month")
        .select("month", "orders", "product_revenue", "revenue_mom", "revenue_yoy")
        .orderBy("month")
    )


def days_without_sales(w: Warehouse) -> DataFrame:
    days = w["fact_orders"].select(F.col("purchase_date").alias("date")).distinct()
    return (
        w["dim_date"]
        .join(days, "date", "left_anti")
        .select("date", "day_name", "is_weekend")
        .orderBy("date")
    )


def segment_counts(w: Warehouse) -> DataFrame:
    return w["dim_customers"].groupBy("segment").agg(rows().alias("customers"))


def frequency_histogram(w: Warehouse) -> DataFrame:
    return w["dim_customers"].groupBy("order_count").agg(rows().alias("customers"))


def rfm_points(w: Warehouse) -> DataFrame:
    return w["dim_customers"].select(
        "customer_uid", "recency_days", F.col("order_count").alias("frequency"),
        F.col("paid_total").alias("monetary"),
    )


def score_by_category_significant(w: Warehouse) -> DataFrame:
    return (
        w["score_by_category"]
        .where("is_significant")
        .select("category", "reviewed_orders", "avg_score", "positive", "negative")
        .orderBy(F.desc("avg_score"), "category")
    )


def freight_heatmap(w: Warehouse) -> DataFrame:
    columns = ["light", "medium", "heavy", "very_heavy"]
    buckets = labels.bucket_labels(labels.WEIGHT_BUCKETS)
    grid = (
        w["freight_erosion"]
        .groupBy("category")
        .pivot("weight_bucket", buckets)
        .agg(F.max("freight_ratio"))
    )
    return grid.toDF("category", *columns)


def seller_ranking(w: Warehouse) -> DataFrame:
    return (
        w["seller_scorecard"]
        .where("is_significant")
        .select(
            "seller_id", "product_revenue", "orders", "avg_delivery_days", "late_rate",
            "cancel_rate", "avg_score",
        )
        .orderBy(F.desc("product_revenue"), "seller_id")
    )


def payment_volume_share(w: Warehouse) -> DataFrame:
    return (
        w["payment_method_mix"]
        .select("payment_type", "paid_volume", "order_share")
        .orderBy(F.desc("paid_volume"), "payment_type")
    )


def category_by_month(w: Warehouse) -> DataFrame:
    return (
        delivered(w["fact_order_items"])
        .groupBy("category", F.col("purchase_month").alias("month"))
        .agg(rows().alias("items"), total("product_revenue").alias("product_revenue"))
    )


def delay_by_seller_state(w: Warehouse) -> DataFrame:
    """Late share of the orders each seller state took part in."""
    items = delivered(w["fact_order_items"])
    per_order = items.groupBy("seller_state", "seller_id", "order_id").agg(
        F.max("is_on_time").alias("is_on_time"), F.max("delivery_days").alias("delivery_days")
    )
    return per_order.groupBy("seller_state").agg(
        rows().alias("seller_orders"),
        ratio(F.count_if(~F.col("is_on_time")), rows()).alias("late_rate"),
        mean(F.col("delivery_days"), 1).alias("avg_delivery_days"),
    )


def ticket_rank_states(w: Warehouse) -> DataFrame:
    return (
        w["ticket_by_state"]
        .where("is_significant")
        .select("state", "orders", "avg_paid_ticket", "avg_installments")
        .orderBy(F.desc("avg_paid_ticket"), "state")
    )


def orders_per_customer(w: Warehouse) -> DataFrame:
    return w["executive_summary"].select(
        "delivered_orders",
        "unique_customers",
        ratio(F.col("delivered_orders"), F.col("unique_customers")).alias("orders_per_customer"),
        ratio(F.col("freight_total"), F.col("gmv")).alias("freight_share_of_gmv"),
    )


def sales_by_state(w: Warehouse) -> DataFrame:
    return (
        w["sales_by_city"]
        .groupBy("state")
        .agg(
            F.sum("orders").alias("orders"),
            *[total(c).alias(c) for c in ["product_revenue", "freight_total", "gmv"]],
        )
    )


def promise_vs_actual(w: Warehouse) -> DataFrame:
    """Mean days promised and taken by state, over orders that have both dates."""
    promised = F.date_diff(F.to_date("promised_at"), "purchase_date")
    return (
        delivered(w["fact_orders"])
        .where("delivered_at is not null and promised_at is not null")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            rows().alias("orders"),
            mean(promised, 1).alias("avg_promised_days"),
            mean(F.col("delivery_days"), 1).alias("avg_actual_days"),
        )
    )


def orders_by_method_count(w: Warehouse) -> DataFrame:
    """Delivered orders by the number of payment methods they were paid with."""
    methods = w["stg_payments"].select("order_id", "payment_type").distinct()
    return (
        methods.join(delivered(w["order_base"]).select("order_id"), "order_id", "left_semi")
        .groupBy("order_id")
        .agg(rows().alias("methods"))
        .groupBy("methods")
        .agg(rows().alias("orders"))
    )


def take_rate_override(w: Warehouse) -> DataFrame:
    """The take rate under other rates than the assumed ones."""
    return order_marts.take_rate(w["fact_orders"], OTHER_COMMISSION, OTHER_PAYMENT_FEE)


def view_statement(w: Warehouse) -> DataFrame:
    """A statement over a published view."""
    w.publish(["dim_customers"])
    return w.spark.sql(
        """select segment, state, count(*) as customers,
             cast(sum(paid_total) as decimal(38,2)) as paid
           from dim_customers group by segment, state"""
    )


QUESTIONS: dict[str, Callable[[Warehouse], DataFrame]] = {
    f.__name__: f
    for f in [
        national_leg_split,
        take_rate_global,
        take_rate_scenarios,
        share_over_500km,
        categories_to_80pct,
        concentration_headline,
        month1_retention_mature,
        punctuality_national,
        status_ranked,
        top_cities,
        top_cities_any_size,
        states_by_p90,
        monthly_trend_clean,
        days_without_sales,
        segment_counts,
        frequency_histogram,
        rfm_points,
        score_by_category_significant,
        freight_heatmap,
        seller_ranking,
        payment_volume_share,
        category_by_month,
        delay_by_seller_state,
        ticket_rank_states,
        orders_per_customer,
        sales_by_state,
        promise_vs_actual,
        orders_by_method_count,
        take_rate_override,
        view_statement,
    ]
}
