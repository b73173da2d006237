"""Dimensions: customers, products, sellers, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import bucketed, money_sum, month_start, ratio, rows, strict_greatest


def dim_customers(order_base: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per person with a delivered, paid order.

    `order_base` has one row per order, so counting rows counts distinct orders. The place
    is that of the latest purchase; of two on one day, the one with the larger order id.
    """
    paid = order_base.where(F.col("is_delivered") & F.col("has_payment"))
    latest = F.max_by(
        F.struct(F.col("customer_city").alias("city"), F.col("customer_state").alias("state")),
        F.struct("purchase_date", "order_id"),
    )
    people = paid.groupBy("customer_uid").agg(
        latest.alias("place"),
        rows().alias("order_count"),
        money_sum(F.sum("order_paid_total")).alias("paid_total"),
        ratio(F.sum("order_paid_total"), F.count("order_paid_total"), 2).alias("avg_paid_ticket"),
        F.min("purchase_date").alias("first_purchase"),
        F.max("purchase_date").alias("last_purchase"),
    )
    # The data is a closed history: recency counts back from its last delivered purchase.
    reference_date = (
        orders.where(F.col("order_status") == labels.DELIVERED)
        .agg(F.max(F.to_date("purchased_at")))
        .scalar()
    )
    return people.select(
        "customer_uid",
        "place.city",
        "place.state",
        "order_count",
        "paid_total",
        "avg_paid_ticket",
        "first_purchase",
        "last_purchase",
        F.datediff(reference_date, F.col("last_purchase")).cast("long").alias("recency_days"),
        F.when(F.col("order_count") > 1, labels.SEGMENT_RECURRENT)
        .otherwise(labels.SEGMENT_ONE_TIME)
        .alias("segment"),
        month_start(F.col("first_purchase")).alias("cohort_month"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    volume = F.col("length_cm") * F.col("height_cm") * F.col("width_cm")
    return (
        products.withColumn("volume_cm3", volume)
        .withColumn(
            "billable_weight_g",
            strict_greatest(
                F.col("weight_g").cast("double"),
                F.col("volume_cm3") / F.lit(labels.VOLUME_CM3_PER_GRAM),
            ),
        )
        .select(
            "product_id",
            "category_src",
            F.coalesce("category_en", F.lit(labels.NO_CATEGORY)).alias("category"),
            "weight_g",
            "length_cm",
            "height_cm",
            "width_cm",
            "volume_cm3",
            "billable_weight_g",
            bucketed(F.col("billable_weight_g"), labels.WEIGHT_BUCKETS).alias("weight_bucket"),
        )
    )


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    return sellers.join(geolocation, "zip_prefix", "left").select(
        "seller_id", "city", "state", "zip_prefix", "lat", "lng"
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last purchase, with or without orders."""
    span = orders.agg(
        F.to_date(F.min("purchased_at")).alias("first"),
        F.to_date(F.max("purchased_at")).alias("last"),
    ).where(F.col("first").isNotNull())
    day = F.col("date")
    weekday = F.dayofweek(day)
    return span.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        "date",
        F.year(day).cast("long").alias("year"),
        F.month(day).cast("long").alias("month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        month_start(day).alias("month_start"),
        F.quarter(day).cast("long").alias("quarter"),
        weekday.cast("long").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday.isin(1, 7).alias("is_weekend"),
    )
