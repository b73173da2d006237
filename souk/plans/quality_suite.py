"""The declared checks on the models, and the runs over them."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import rows
from souk.operators import quality
from souk.plans.warehouse import RATES, TOTALS, Warehouse


@dataclass(frozen=True)
class Checks:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, list] = field(default_factory=dict)
    # child key -> (parent model, parent key)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)
    combinations: tuple[tuple[str, ...], ...] = ()


WEIGHTS = labels.bucket_labels(labels.WEIGHT_BUCKETS)
DISTANCES = labels.bucket_labels(labels.DISTANCE_BUCKETS)
PUNCTUALITIES = labels.bucket_labels(labels.PUNCTUALITY_BUCKETS)
ORDER = ("stg_orders", "order_id")

# The checks every build has to pass
DECLARED: dict[str, Checks] = {
    "stg_orders": Checks(
        unique=("order_id",),
        not_null=("order_id", "customer_id"),
        accepted={"order_status": labels.ORDER_STATUSES},
    ),
    "stg_customers": Checks(unique=("customer_id",), not_null=("customer_id", "customer_uid")),
    "stg_order_items": Checks(
        not_null=("seller_id", "price"),
        relationships={
            "order_id": ORDER,
            "product_id": ("stg_products", "product_id"),
            "seller_id": ("stg_sellers", "seller_id"),
        },
    ),
    "stg_reviews": Checks(
        not_null=("review_id", "order_id", "score"),
        accepted={"score": labels.REVIEW_SCORES},
        relationships={"order_id": ORDER},
        combinations=(("review_id", "order_id"),),
    ),
    "stg_payments": Checks(
        not_null=("order_id", "payment_type", "payment_value"),
        accepted={"payment_type": labels.PAYMENT_TYPES},
        relationships={"order_id": ORDER},
    ),
    "stg_products": Checks(unique=("product_id",), not_null=("product_id",)),
    "stg_sellers": Checks(unique=("seller_id",), not_null=("seller_id",)),
    "stg_geolocation": Checks(unique=("zip_prefix",), not_null=("zip_prefix", "lat", "lng")),
    "payments_per_order": Checks(
        unique=("order_id",),
        not_null=("order_id", "order_paid_total"),
        relationships={"order_id": ORDER},
    ),
    "dim_customers": Checks(
        unique=("customer_uid",),
        not_null=(
            "customer_uid",
            "order_count",
            "paid_total",
            "first_purchase",
            "last_purchase",
            "recency_days",
            "segment",
            "cohort_month",
        ),
        accepted={"segment": labels.SEGMENTS},
    ),
    "dim_products": Checks(
        unique=("product_id",),
        not_null=("product_id", "category"),
        accepted={"weight_bucket": WEIGHTS},
    ),
    "dim_sellers": Checks(unique=("seller_id",), not_null=("seller_id",)),
    "dim_date": Checks(unique=("date",), not_null=("date", "is_weekend")),
    "fact_orders": Checks(
        unique=("order_id",),
        not_null=(
            "order_id",
            "customer_uid",
            "order_status",
            "purchase_date",
            "is_delivered",
            "is_cancelled",
        ),
        accepted={"order_status": labels.ORDER_STATUSES},
    ),
    "fact_order_items": Checks(
        not_null=(
            "order_id",
            "item_no",
            "customer_uid",
            "product_id",
            "seller_id",
            "product_revenue",
        ),
        combinations=(("order_id", "item_no"),),
    ),
    "cohort_retention": Checks(
        not_null=(
            "cohort_month",
            "months_since_first",
            "cohort_customers",
            "active_customers",
            "retention_rate",
            "observable_months",
        ),
        combinations=(("cohort_month", "months_since_first"),),
    ),
    "executive_summary": Checks(
        not_null=(
            "date_from",
            "date_to",
            "delivered_orders",
            "unique_customers",
            "product_revenue",
            "freight_total",
            "gmv",
            "product_ticket",
            "paid_ticket",
            "on_time_rate",
            "on_time_rate_global",
            "delivery_p90",
            "promise_cushion_days",
            "avg_score",
            "recurrent_rate",
            "cancel_rate",
        ),
    ),
    "sales_by_city": Checks(
        not_null=("orders", "product_revenue", "freight_total", "gmv", "is_significant"),
        combinations=(("city", "state"),),
    ),
    "ticket_by_state": Checks(
        unique=("state",), not_null=("state", "orders", "avg_paid_ticket", "is_significant")
    ),
    "monthly_sales": Checks(
        unique=("month",),
        not_null=("month", "orders", "unique_customers", "product_revenue", "gmv", "is_edge_month"),
    ),
    "sales_by_category": Checks(
        unique=("category", "rank"),
        not_null=(
            "category",
            "items",
            "orders",
            "product_revenue",
            "revenue_share",
            "cumulative_share",
            "rank",
        ),
    ),
    "revenue_concentration": Checks(
        not_null=("dimension", "tier", "entities_in_tier", "revenue_share"),
        accepted={"dimension": labels.DIMENSIONS},
        combinations=(("dimension", "tier"),),
    ),
    "delivery_time_by_state": Checks(
        unique=("state",),
        not_null=("state", "delivered_orders", "avg_delivery_days", "is_significant"),
    ),
    "order_status_mix": Checks(
        unique=("order_status",),
        not_null=("order_status", "orders", "share"),
        accepted={"order_status": labels.ORDER_STATUSES},
    ),
    "score_by_category": Checks(
        unique=("category",),
        not_null=("category", "reviewed_orders", "avg_score", "is_significant"),
    ),
    "punctuality_vs_score": Checks(
        not_null=("state", "punctuality_bucket", "orders"),
        accepted={"punctuality_bucket": PUNCTUALITIES},
        combinations=(("state", "punctuality_bucket"),),
    ),
    "distance_vs_delivery": Checks(
        unique=("distance_bucket",),
        not_null=(
            "distance_bucket",
            "orders",
            "avg_distance_km",
            "avg_freight",
            "avg_delivery_days",
            "late_rate",
        ),
        accepted={"distance_bucket": DISTANCES},
    ),
    "freight_erosion": Checks(
        not_null=("category", "weight_bucket", "items", "product_revenue", "freight_total"),
        accepted={"weight_bucket": WEIGHTS},
        combinations=(("category", "weight_bucket"),),
    ),
    "seller_scorecard": Checks(
        unique=("seller_id",),
        not_null=(
            "seller_id",
            "orders",
            "product_revenue",
            "orders_all_status",
            "cancel_rate",
            "is_significant",
        ),
    ),
    "payment_method_mix": Checks(
        unique=("payment_type",),
        not_null=("payment_type", "orders", "order_share", "paid_volume"),
        accepted={"payment_type": labels.PAYMENT_TYPES},
    ),
    "take_rate": Checks(
        unique=("month",),
        not_null=(
            "month",
            "gmv",
            "product_revenue",
            "assumed_commission",
            "assumed_fee",
            "commission_income",
            "platform_margin",
            "effective_rate",
        ),
    ),
}

def rates_report(w: Warehouse) -> DataFrame:
    """(metric, figures, known, lowest, highest) of each rate, as observed when its table was
    written."""
    rows = []
    for model, columns in RATES:
        own = w.figures(model)
        for c in columns:
            known = [own[f"{c}.{figure}"] for figure in ("rows", "known")]
            ends = [own[f"{c}.{figure}"] for figure in ("lowest", "highest")]
            rows.append((f"{model}.{c}", *map(int, known), *[None if x is None else float(x) for x in ends]))
    return w.spark.createDataFrame(
        rows, "metric string, figures long, known long, lowest double, highest double"
    )


def rates_in_range(w: Warehouse) -> DataFrame:
    """(metric, value) of known rates below 0 or above 1. Only tables with some are read."""
    failing = []
    for model, columns in RATES:
        own = w.figures(model)
        outside = [c for c in columns if int(own[f"{c}.outside"])]
        if outside:
            failing.append((model, w.table(model), outside))
    if not failing:
        return w.spark.createDataFrame([], "metric string, value double")
    return quality.rates_out_of_range(failing)


def revenue_truth(w: Warehouse) -> DataFrame:
    """What the item fact says: its revenue as observed when it was written, and its orders."""
    revenue = w.figures("fact_order_items")["revenue.total"]
    sold = w["fact_order_items"].where("is_delivered")
    return sold.agg(
        F.lit(revenue).cast("decimal(38,2)").alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
    )


def reconciled_totals(w: Warehouse) -> list[tuple[str, Decimal | None, str]]:
    """(mart, total, column of the truth) of each mart that has to agree with the item fact."""
    out = []
    for figure in ("revenue", "orders"):
        for model, totals in TOTALS.items():
            if figure in totals:
                value = w.figures(model)[f"{figure}.total"]
                name = model if figure == "revenue" else f"{model}.{figure}"
                out.append((name, None if value is None else Decimal(value), figure))
    return out


def reconciliation_report(w: Warehouse) -> DataFrame:
    """(mart, value, expected, difference) of each mart."""
    totals = w.spark.createDataFrame(
        reconciled_totals(w), "mart string, value decimal(38,2), truth string"
    )
    truth = revenue_truth(w)
    expected = truth.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("truth"), F.col(c).cast("decimal(38,2)").alias("expected"))
                    for c in truth.columns
                ]
            )
        )
    )
    return totals.join(expected, "truth", "left").select(
        "mart", "value", "expected",
        (F.col("value") - F.col("expected")).cast("decimal(38,2)").alias("difference"),
    )


def reconciliation(w: Warehouse) -> DataFrame:
    return quality.beyond_tolerance(reconciliation_report(w))


def one_row(w: Warehouse) -> DataFrame:
    return quality.not_one_row(w["executive_summary"])


def _report(check: str, model: str, columns: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check"),
        F.lit(model).alias("model"),
        F.lit(columns).alias("columns"),
        "failures",
    )


def _failing_rows(failing: DataFrame) -> DataFrame:
    return failing.agg(rows().alias("failures"))


def table_checks(w: Warehouse, model: str) -> quality.TableChecks:
    checks = DECLARED[model]
    failing = {("not_null", c): quality.column(c).isNull() for c in checks.not_null}
    failing |= {
        ("accepted_values", c): quality.outside(c, values) for c, values in checks.accepted.items()
    }
    return quality.TableChecks(
        w[model], failing, checks.unique, checks.combinations, checks.relationships
    )


def declared_report(w: Warehouse) -> DataFrame:
    """(check, model, columns, failures) of every check that is declared for a model.

    Failures are rows with a NULL, rows with a value outside its list, values or key tuples
    that repeat, and rows whose key has no parent.
    """
    return quality.all_failures({model: table_checks(w, model) for model in DECLARED})


def suite_report(w: Warehouse) -> DataFrame:
    """Every declared check with its number of failures, over written tables."""
    w.tables(DECLARED)
    singles = [
        ("one_row", "executive_summary", "", one_row(w)),
        ("rates_in_range", "", "", rates_in_range(w)),
        ("reconciliation", "fact_order_items", "", reconciliation(w)),
    ]
    reports = [_report(c, m, cols, _failing_rows(df)) for c, m, cols, df in singles]
    return quality.union_all([declared_report(w), *reports])
