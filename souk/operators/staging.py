"""Staging: rename and cast, one function per raw table. Grain stays that of the raw table,
except for coordinates, which become one centroid per postal prefix.

Times are kept as `timestamp_ntz` in UTC, so no result depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.expressions import money, money_sum

# Enough digits for any latitude or longitude a double can tell apart.
_DEGREES = "decimal(20,15)"


def _time(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def _whole(df: DataFrame, name: str) -> Column:
    """Long from a number or its text; fractions round half away from zero."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).cast("long")
    return F.round(F.col(name).cast("decimal(38,6)"), 0).cast("long")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        _time("order_purchase_timestamp").alias("purchased_at"),
        _time("order_approved_at").alias("approved_at"),
        _time("order_delivered_carrier_date").alias("shipped_at"),
        _time("order_delivered_customer_date").alias("delivered_at"),
        _time("order_estimated_delivery_date").alias("promised_at"),
    )


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id",
        F.col("customer_unique_id").alias("customer_uid"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        _whole(raw_customers, "customer_zip_code_prefix").alias("zip_prefix"),
    )


def stg_order_items(raw_order_items: DataFrame) -> DataFrame:
    return raw_order_items.select(
        "order_id",
        _whole(raw_order_items, "order_item_id").alias("item_no"),
        "product_id",
        "seller_id",
        money(F.col("price")).alias("price"),
        money(F.col("freight_value")).alias("freight"),
    )


def stg_payments(raw_payments: DataFrame) -> DataFrame:
    return raw_payments.select(
        "order_id",
        _whole(raw_payments, "payment_sequential").alias("payment_seq"),
        "payment_type",
        _whole(raw_payments, "payment_installments").alias("installments"),
        money(F.col("payment_value")).alias("payment_value"),
    )


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    """No de-duplication: one review may cover several orders, one order have several."""
    return raw_reviews.select(
        "review_id",
        "order_id",
        _whole(raw_reviews, "review_score").alias("score"),
        F.col("review_comment_title").alias("title"),
        F.col("review_comment_message").alias("message"),
        _time("review_creation_date").alias("created_at"),
        _time("review_answer_timestamp").alias("answered_at"),
    )


def stg_products(raw_products: DataFrame, raw_category_translation: DataFrame) -> DataFrame:
    translation = raw_category_translation.select(
        "product_category_name", F.col("product_category_name_english").alias("category_en")
    )
    return raw_products.join(translation, "product_category_name", "left").select(
        "product_id",
        F.col("product_category_name").alias("category_src"),
        "category_en",
        _whole(raw_products, "product_weight_g").alias("weight_g"),
        _whole(raw_products, "product_length_cm").alias("length_cm"),
        _whole(raw_products, "product_height_cm").alias("height_cm"),
        _whole(raw_products, "product_width_cm").alias("width_cm"),
    )


def stg_sellers(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select(
        "seller_id",
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        _whole(raw_sellers, "seller_zip_code_prefix").alias("zip_prefix"),
    )


def stg_geolocation(raw_geolocation: DataFrame) -> DataFrame:
    """Centroid per postal prefix. Decimal sums make it the same in every run."""

    def centre(name: str) -> Column:
        degrees = F.col(name).cast("double").cast(_DEGREES)
        return F.sum(degrees).cast("double") / F.count(degrees).cast("double")

    return raw_geolocation.groupBy(_whole(raw_geolocation, "geolocation_zip_code_prefix").alias("zip_prefix")).agg(
        centre("geolocation_lat").alias("lat"), centre("geolocation_lng").alias("lng")
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        money_sum(F.sum("payment_value")).alias("order_paid_total"),
        F.max("installments").alias("max_installments"),
    )
