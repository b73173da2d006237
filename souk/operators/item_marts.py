"""Aggregates that follow from the item fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import bucketed, mean, mean_if, ratio, rows
from souk.operators.numbering import running_count
from souk.operators.order_marts import delivered, significant, total


def sales_by_category(items: DataFrame) -> DataFrame:
    """Category ranking with shares.

    Three distinct counts in one aggregation would multiply every row by four. Instead the
    order count comes from one row per (category, order), and the product and seller counts
    from one row per (category, product, seller), which is far fewer than the items.
    """
    sold = delivered(items)
    by_order = (
        sold.groupBy("category", "order_id")
        .agg(
            rows().alias("items"),
            F.sum("product_revenue").alias("product_revenue"),
            F.count("product_revenue").alias("priced"),
            F.sum("freight").alias("freight"),
        )
        .groupBy("category")
        .agg(
            F.sum("items").alias("items"),
            rows().alias("orders"),
            total("product_revenue").alias("product_revenue"),
            total("freight").alias("freight_total"),
            ratio(F.sum("product_revenue"), F.sum("priced"), 2).alias("avg_item_price"),
            ratio(F.sum("freight"), F.sum("product_revenue")).alias("freight_ratio"),
        )
    )
    offers = (
        sold.select("category", "product_id", "seller_id")
        .distinct()
        .groupBy("category")
        .agg(
            F.countDistinct("product_id").alias("distinct_products"),
            F.countDistinct("seller_id").alias("distinct_sellers"),
        )
    )
    # From here on there is one row per category.
    ranked = Window.orderBy(F.desc("product_revenue"), "category")
    so_far = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = F.sum("product_revenue").over(Window.partitionBy())
    return by_order.join(offers, "category").select(
        "category",
        "items",
        "orders",
        "distinct_products",
        "distinct_sellers",
        "product_revenue",
        "freight_total",
        "avg_item_price",
        "freight_ratio",
        ratio(F.col("product_revenue"), everything).alias("revenue_share"),
        ratio(F.sum("product_revenue").over(so_far), everything).alias("cumulative_share"),
        F.row_number().over(ranked).cast("long").alias("rank"),
    )


def revenue_concentration(items: DataFrame) -> DataFrame:
    """Share of revenue held by the top sellers and categories, in disjoint tiers.

    A tier depends on how many entities earn more, never on which of several equal earners
    comes first. So entities of equal revenue become one row that covers a range of ranks,
    and each tier takes the part of the range it overlaps. Sellers may be many: ranks come
    from banded totals instead of one global sort.
    """
    earned = (
        delivered(items)
        .groupBy("seller_id", "category")
        .agg(F.sum("product_revenue").alias("revenue"))
    )

    def entities(dimension: str, key: str) -> DataFrame:
        return (
            earned.groupBy(key)
            .agg(total("revenue").alias("revenue"))
            .select(F.lit(dimension).alias("dimension"), "revenue")
        )

    equal_earners = (
        entities(labels.DIMENSION_SELLERS, "seller_id")
        .unionByName(entities(labels.DIMENSION_CATEGORIES, "category"))
        .groupBy("dimension", "revenue")
        .agg(rows().alias("entities"))
    )
    ranked = running_count(
        equal_earners, "dimension", "revenue", "entities", "ranks_above", "entities_total"
    )
    n = F.col("entities_total")
    top_10 = F.lit(10).cast("long")
    top_1_pct = F.greatest(top_10, F.ceil(n * 0.01))
    top_10_pct = F.greatest(top_1_pct, F.ceil(n * 0.10))
    above, here = F.col("ranks_above"), F.col("entities")

    def tier(name: str, after, until):
        overlap = F.least(above + here, until) - F.greatest(above, after)
        return F.struct(F.lit(name).alias("tier"), F.greatest(overlap, F.lit(0)).alias("members"))

    tiers = F.array(
        tier(labels.TIER_TOP_10, F.lit(0), top_10),
        tier(labels.TIER_TOP_1_PCT, top_10, top_1_pct),
        tier(labels.TIER_TOP_10_PCT, top_1_pct, top_10_pct),
        tier(labels.TIER_REST, top_10_pct, F.greatest(top_10_pct, n)),
    )
    per_tier = (
        ranked.select("dimension", "entities_total", "revenue", F.inline(tiers))
        .where("members > 0")
        .groupBy("dimension", "tier")
        .agg(
            F.max("entities_total").alias("entities_total"),
            F.sum("members").alias("entities_in_tier"),
            F.sum(F.col("revenue") * F.col("members")).cast("decimal(28,2)").alias("revenue"),
        )
    )
    # At most four rows per dimension.
    all_revenue = F.sum("revenue").over(Window.partitionBy("dimension"))
    return per_tier.select(
        "dimension",
        "tier",
        "entities_total",
        "entities_in_tier",
        "revenue",
        ratio(F.col("revenue"), all_revenue).alias("revenue_share"),
    )


def located_orders(items: DataFrame) -> DataFrame:
    """Delivered orders with a known distance, one row each; the farthest item sets it."""
    return (
        delivered(items)
        .where("distance_km is not null")
        .groupBy("order_id")
        .agg(
            F.max("distance_km").alias("distance_km"),
            F.sum("freight").alias("freight"),
            F.max("delivery_days").alias("delivery_days"),
            F.max("is_on_time").alias("is_on_time"),
            F.max("order_score").alias("order_score"),
        )
    )


def distance_vs_delivery(items: DataFrame) -> DataFrame:
    return (
        located_orders(items)
        .groupBy(bucketed(F.col("distance_km"), labels.DISTANCE_BUCKETS).alias("distance_bucket"))
        .agg(
            rows().alias("orders"),
            mean(F.col("distance_km"), 1).alias("avg_distance_km"),
            mean(F.col("freight"), 2).alias("avg_freight"),
            mean(F.col("delivery_days"), 1).alias("avg_delivery_days"),
            # An unknown arrival is not late, yet it counts below the line.
            ratio(F.count_if(~F.col("is_on_time")), rows()).alias("late_rate"),
            mean(F.col("order_score"), 2).alias("avg_score"),
        )
    )


def score_by_category(
    items: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS
) -> DataFrame:
    """An order's score counts once for each category it contains."""
    score = F.col("order_score")
    return (
        delivered(items)
        .where("order_score is not null")
        .groupBy("order_id", "category")
        .agg(F.max("order_score").alias("order_score"))
        .groupBy("category")
        .agg(
            rows().alias("reviewed_orders"),
            mean(score, 2).alias("avg_score"),
            F.count_if(score >= labels.POSITIVE_SCORE).alias("positive"),
            F.count_if(score <= labels.NEGATIVE_SCORE).alias("negative"),
        )
        .withColumn("is_significant", significant(F.col("reviewed_orders"), threshold))
    )


def freight_erosion(items: DataFrame) -> DataFrame:
    return (
        delivered(items)
        .where("billable_weight_g is not null")
        .groupBy("category", "weight_bucket")
        .agg(
            rows().alias("items"),
            total("product_revenue").alias("product_revenue"),
            total("freight").alias("freight_total"),
            ratio(F.sum("freight"), F.sum("product_revenue")).alias("freight_ratio"),
            mean(F.col("billable_weight_g"), 0).alias("avg_billable_weight_g"),
        )
    )


def seller_orders(items: DataFrame) -> DataFrame:
    """One row per (seller, order) of any status. Order attributes are the same on every
    line of an order, so any of them will do."""
    return items.groupBy("seller_id", "order_id").agg(
        rows().alias("lines"),
        F.count("product_revenue").alias("priced"),
        F.sum("product_revenue").alias("product_revenue"),
        F.max("is_delivered").alias("is_delivered"),
        F.max(F.col("order_status").isin(labels.CANCELLED_STATUSES)).alias("is_cancelled"),
        F.max("is_on_time").alias("is_on_time"),
        F.max("delivery_days").alias("delivery_days"),
        F.max("order_score").alias("order_score"),
    )


def seller_scorecard(
    items: DataFrame, sellers: DataFrame, threshold: int = labels.SIGNIFICANT_SELLER_ORDERS
) -> DataFrame:
    """Sellers with at least one delivered item.

    Revenue is at item grain, quality at (seller, order) grain, cancellations over all
    statuses. One pass serves all three: items become one row per (seller, order) first.
    """
    sold = F.col("is_delivered")
    scores = (
        seller_orders(items)
        .groupBy("seller_id")
        .agg(
            F.count_if(sold).alias("orders"),
            F.sum(F.when(sold, F.col("product_revenue"))).cast("decimal(28,2)").alias("product_revenue"),
            ratio(
                F.sum(F.when(sold, F.col("product_revenue"))), F.sum(F.when(sold, F.col("priced"))), 2
            ).alias("avg_item_price"),
            mean_if(sold, F.col("delivery_days"), 1).alias("avg_delivery_days"),
            ratio(F.count_if(sold & ~F.col("is_on_time")), F.count_if(sold)).alias("late_rate"),
            mean_if(sold, F.col("order_score"), 2).alias("avg_score"),
            rows().alias("orders_all_status"),
            ratio(F.count_if(F.col("is_cancelled")), rows()).alias("cancel_rate"),
        )
        .where("orders > 0")
    )
    return scores.join(sellers.select("seller_id", "city", "state"), "seller_id").select(
        "seller_id",
        "city",
        "state",
        "orders",
        "product_revenue",
        "avg_item_price",
        "avg_delivery_days",
        "late_rate",
        "avg_score",
        "orders_all_status",
        "cancel_rate",
        significant(F.col("orders"), threshold).alias("is_significant"),
    )
