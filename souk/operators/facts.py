"""Facts at order grain, item grain and cohort-cell grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import (
    distance_km,
    leg_days,
    money_sum,
    month_offset,
    month_start,
    ratio,
    rows,
)
from souk.operators.numbering import HOT_GROUP

# Columns of the order fact; `order_base` carries a few more for the models built on it.
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "customer_uid",
    "customer_state",
    "customer_city",
    "order_status",
    "purchase_date",
    "purchase_month",
    "approved_at",
    "shipped_at",
    "delivered_at",
    "promised_at",
    "item_count",
    "seller_count",
    "product_revenue",
    "freight",
    "paid_value",
    "paid_imputed",
    "max_installments",
    "approval_days",
    "handling_days",
    "transit_days",
    "delivery_days",
    "days_vs_promise",
    "is_on_time",
    "is_delivered",
    "is_cancelled",
    "review_score",
    "review_count",
]


def hot_orders(items: DataFrame) -> DataFrame:
    """Orders with more lines than one task should hold."""
    held = items.groupBy(F.col("order_id").alias("hot_order")).agg(rows().alias("lines"))
    return held.where(F.col("lines") > HOT_GROUP).select("hot_order")


def items_per_order(items: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Item totals per order.

    Totals per (order, seller) come first, which leaves the seller count as a plain count. Where
    the hot orders are given, the lines of all others meet in one shuffle by order; lines of an
    order of any size are reduced to one per seller before they meet.
    """
    if hot is None:
        return _totals(items)
    same = F.col("order_id").eqNullSafe(F.col("hot_order"))
    few = items.join(hot, same, "left_anti").repartition("order_id")
    return _totals(few).unionAll(_totals(items.join(hot, same, "left_semi")))


def _totals(items: DataFrame) -> DataFrame:
    per_seller = items.groupBy("order_id", "seller_id").agg(
        rows().alias("lines"),
        F.sum("price").alias("price"),
        F.sum("freight").alias("freight"),
    )
    return per_seller.groupBy("order_id").agg(
        F.sum("lines").alias("item_count"),
        F.count("seller_id").alias("seller_count"),
        money_sum(F.sum("price")).alias("product_revenue"),
        money_sum(F.sum("freight")).alias("freight"),
    )


def scores_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("score").alias("review_score"),
        F.countDistinct("review_id").alias("review_count"),
    )


def order_base(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    geolocation: DataFrame,
) -> DataFrame:
    """The order table from rows that are not yet reduced to orders, `payments` aside."""
    return order_table(
        orders, items_per_order(items), payments, scores_per_order(reviews), customers, geolocation
    )


def order_table(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    scores: DataFrame,
    customers: DataFrame,
    geolocation: DataFrame,
) -> DataFrame:
    """One row per order of any status: the order fact plus the buyer's centroid and payment.

    Items, payments and scores are one row per order already, so no join here multiplies rows
    or meets a hot key on both sides. They come first: where the four tables are stored by order,
    the three joins need no shuffle.
    """
    buyers = customers.join(geolocation, "zip_prefix", "left").select(
        "customer_id",
        "customer_uid",
        F.col("state").alias("customer_state"),
        F.col("city").alias("customer_city"),
        F.col("lat").alias("buyer_lat"),
        F.col("lng").alias("buyer_lng"),
    )
    paid = payments.withColumn("has_payment", F.lit(True))
    joined = (
        orders.join(items, "order_id", "left")
        .join(paid, "order_id", "left")
        .join(scores, "order_id", "left")
        .join(buyers, "customer_id")
    )
    purchase_date = F.to_date("purchased_at")
    delivery_date = F.to_date("delivered_at")
    return joined.withColumns(
        {
            "purchase_date": purchase_date,
            "purchase_month": month_start(purchase_date),
            "has_payment": F.coalesce("has_payment", F.lit(False)),
            "paid_value": F.coalesce(
                "order_paid_total", money_sum(F.col("product_revenue") + F.col("freight"))
            ),
            "paid_imputed": F.col("order_paid_total").isNull() & F.col("product_revenue").isNotNull(),
            "approval_days": leg_days(F.col("purchased_at"), F.col("approved_at")),
            "handling_days": leg_days(F.col("approved_at"), F.col("shipped_at")),
            "transit_days": leg_days(F.col("shipped_at"), F.col("delivered_at")),
            "delivery_days": F.datediff(delivery_date, purchase_date).cast("long"),
            "days_vs_promise": F.datediff(delivery_date, F.to_date("promised_at")).cast("long"),
            "is_on_time": F.col("delivered_at") <= F.col("promised_at"),
            "is_delivered": F.col("order_status") == labels.DELIVERED,
            "is_cancelled": F.col("order_status").isin(labels.CANCELLED_STATUSES),
        }
    ).select(*ORDER_COLUMNS, "order_paid_total", "has_payment", "buyer_lat", "buyer_lng")


def fact_orders(base: DataFrame) -> DataFrame:
    return base.select(*ORDER_COLUMNS)


def fact_order_items(
    items: DataFrame, base: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """One row per order line, with the attributes of its order, product and seller.

    The few columns of products and sellers come first, so that their joins shuffle narrow
    lines; the many of the order come last.
    """
    return sold_items(offered_items(items, products, sellers), base)


def offered_items(items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Order lines with the attributes of their product and seller."""
    product_side = products.select("product_id", "category", "weight_bucket", "billable_weight_g")
    seller_side = sellers.select(
        "seller_id",
        F.col("state").alias("seller_state"),
        F.col("lat").alias("seller_lat"),
        F.col("lng").alias("seller_lng"),
    )
    return items.join(product_side, "product_id").join(seller_side, "seller_id")


def sold_items(offered: DataFrame, base: DataFrame) -> DataFrame:
    """Lines of `offered_items` with the attributes of their order.

    Buyer and seller centroids arrive with the order and the seller, so coordinates need no
    further join at this grain. Order attributes are carried for filtering: they must not be
    averaged before the lines are reduced to orders.
    """
    order_side = base.select(
        "order_id",
        "customer_uid",
        "purchase_date",
        "purchase_month",
        "customer_state",
        "order_status",
        "is_delivered",
        "delivery_days",
        "is_on_time",
        F.col("review_score").alias("order_score"),
        "buyer_lat",
        "buyer_lng",
    )
    return offered.join(order_side, "order_id").select(
        "order_id",
        "item_no",
        "customer_uid",
        "product_id",
        "seller_id",
        "purchase_date",
        "purchase_month",
        "category",
        "weight_bucket",
        "billable_weight_g",
        "customer_state",
        "seller_state",
        "order_status",
        "is_delivered",
        F.col("price").alias("product_revenue"),
        "freight",
        distance_km(
            F.col("buyer_lat"), F.col("buyer_lng"), F.col("seller_lat"), F.col("seller_lng")
        ).alias("distance_km"),
        "delivery_days",
        "is_on_time",
        "order_score",
    )


def cohort_retention(base: DataFrame, customers: DataFrame) -> DataFrame:
    """Activity of each acquisition cohort by months since the first purchase.

    Orders shrink to one row per customer and month before the join: a customer with very
    many orders stays small, and active customers are a count of rows. Only cells with
    activity appear. Offsets may be negative, as cohorts ignore unpaid orders and this does
    not.
    """
    delivered = base.where("is_delivered")
    last_month = delivered.agg(F.max("purchase_month")).scalar()
    activity = delivered.groupBy("customer_uid", "purchase_month").agg(
        F.sum("paid_value").alias("paid")
    )
    cells = (
        activity.join(customers.select("customer_uid", "cohort_month"), "customer_uid")
        .groupBy(
            "cohort_month",
            month_offset(F.col("purchase_month"), F.col("cohort_month")).alias("months_since_first"),
        )
        .agg(
            rows().alias("active_customers"),
            F.sum("paid").cast("decimal(28,2)").alias("period_revenue"),
        )
    )
    # A cohort has at most one cell per calendar month.
    cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers"))).over(cohort)
    return (
        cells.withColumn("cohort_customers", size)
        .where(F.col("cohort_customers").isNotNull())
        .select(
            "cohort_month",
            "months_since_first",
            "cohort_customers",
            "active_customers",
            ratio(F.col("active_customers"), F.col("cohort_customers")).alias("retention_rate"),
            "period_revenue",
            ratio(F.col("period_revenue"), F.col("cohort_customers"), 2).alias(
                "revenue_per_cohort_customer"
            ),
            month_offset(last_month, F.col("cohort_month")).alias("observable_months"),
        )
    )
