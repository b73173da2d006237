"""The nine raw tables: which they are, how their files are read, what must be in them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RawTable:
    """`strict` drops every record whose width differs from the header (free-text tables);
    the others drop only over-long records and read NA-like text as NULL."""

    name: str
    columns: tuple[str, ...]
    strict: bool = False


# Table names and the columns the staging layer reads
RAW_TABLES = {
    table.name: table
    for table in [
        RawTable(
            "raw_orders",
            (
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        ),
        RawTable(
            "raw_customers",
            (
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            ),
        ),
        RawTable(
            "raw_order_items",
            ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        ),
        RawTable(
            "raw_payments",
            (
                "order_id",
                "payment_sequential",
                "payment_type",
                "payment_installments",
                "payment_value",
            ),
        ),
        RawTable(
            "raw_products",
            (
                "product_id",
                "product_category_name",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        ),
        RawTable(
            "raw_sellers",
            ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ),
        RawTable(
            "raw_category_translation",
            ("product_category_name", "product_category_name_english"),
        ),
        RawTable(
            "raw_reviews",
            (
                "review_id",
                "order_id",
                "review_score",
                "review_comment_title",
                "review_comment_message",
                "review_creation_date",
                "review_answer_timestamp",
            ),
            strict=True,
        ),
        RawTable(
            "raw_geolocation",
            ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        ),
    ]
}
