"""Aggregates and the report that follow from the order fact (and payments)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import bucketed, half_up, mean, ratio, rows


def delivered(fact: DataFrame) -> DataFrame:
    return fact.where("is_delivered")


def total(name: str) -> Column:
    """Exact money total; sums of decimals do not depend on row order."""
    return F.sum(name).cast("decimal(28,2)")


def significant(orders: Column, threshold: int) -> Column:
    return orders >= threshold


# Cells of the order fact that the marts below add up: their keys, by name
CITY, MONTH, DAYS, STATUS = "city", "month", "days", "status"
CELLS = {
    CITY: ["customer_city", "customer_state"],
    MONTH: ["purchase_month", "customer_uid"],
    DAYS: ["customer_state", "delivery_days"],
    STATUS: ["order_status"],
}
STATE = ["customer_state"]


_ADDED_UP = ("product_revenue", "freight", "paid_value", "max_installments")
_LEGS = ("approval_days", "handling_days", "transit_days")
# What a cell holds: numbers and sums alone, so that cells add up to larger ones
MEASURES = [
    "orders",
    "arrived",
    *(f"{kind}_{name}" for name in (*_ADDED_UP, *_LEGS) for kind in ("sum", "with")),
]


_MONEY = ["orders", "sum_product_revenue", "with_product_revenue", "sum_freight", "sum_paid_value"]


def _measure(name: str) -> Column:
    if name == "orders":
        return rows().alias(name)
    if name == "arrived":
        return F.count("delivered_at").alias(name)
    kind, column = name.split("_", 1)
    value = F.col(column)
    if column in _LEGS:
        value = F.when(F.col("delivered_at").isNotNull(), value)
    return (F.sum(value) if kind == "sum" else F.count(value)).alias(name)


def cells(
    fact: DataFrame,
    name: str,
    keys: list[str] | None = None,
    measures: list[str] | None = None,
) -> DataFrame:
    """The cells of one kind, or coarser ones by the given keys; of delivered orders, unless they
    are by status."""
    counted = fact if name == STATUS else delivered(fact)
    return counted.groupBy(*(keys or CELLS[name])).agg(*map(_measure, measures or MEASURES))


def all_cells(fact: DataFrame) -> DataFrame:
    """The cells of all kinds in one pass over the fact, told apart by the column `cells`."""
    sold = "is_delivered"
    sets = [[*([] if name == STATUS else [sold]), *keys] for name, keys in CELLS.items()]
    keys = list(dict.fromkeys(key for own in sets for key in own))
    kind = F.lit(DAYS)
    for name, mark in ((CITY, "customer_city"), (MONTH, "customer_uid"), (STATUS, "order_status")):
        kind = F.when(F.grouping(mark) == 0, name).otherwise(kind)
    found = fact.groupingSets(sets, *keys).agg(*map(_measure, MEASURES), kind.alias("cells"))
    return found.where((F.col("cells") == STATUS) | F.col(sold)).drop(sold)


def _mean(name: str, digits: int) -> Column:
    return ratio(F.sum(f"sum_{name}"), F.sum(f"with_{name}"), digits)


def sales_by_city(fact: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS) -> DataFrame:
    return sales_by_city_of(cells(fact, CITY, measures=_MONEY), threshold)


def sales_by_city_of(
    cities: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS
) -> DataFrame:
    return (
        cities.groupBy(F.col("customer_city").alias("city"), F.col("customer_state").alias("state"))
        .agg(
            F.sum("orders").alias("orders"),
            total("sum_product_revenue").alias("product_revenue"),
            total("sum_freight").alias("freight_total"),
            total("sum_paid_value").alias("gmv"),
        )
        .withColumn("is_significant", significant(F.col("orders"), threshold))
    )


def monthly_sales(fact: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS) -> DataFrame:
    return monthly_sales_of(cells(fact, MONTH, measures=_MONEY), threshold)


def monthly_sales_of(
    buyers: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS
) -> DataFrame:
    """Monthly levels, and changes against the month and the year before, from the cells by month
    and customer.

    The comparison months are found on the calendar, not as earlier rows: a month without
    orders has no row, and a comparison with it has no result.
    """
    months = buyers.groupBy(F.col("purchase_month").alias("month")).agg(
        F.sum("orders").alias("orders"),
        F.count("customer_uid").alias("unique_customers"),
        total("sum_product_revenue").alias("product_revenue"),
        total("sum_freight").alias("freight_total"),
        total("sum_paid_value").alias("gmv"),
        _mean("product_revenue", 2).alias("avg_product_ticket"),
    )
    # One row per calendar month, so one ordered pass over all of them is small. The frames
    # reach back one and twelve months by value, and a missing month leaves its frame empty.
    index = F.year("month") * 12 + F.month("month")
    calendar = Window.orderBy("month_index")
    one_back = calendar.rangeBetween(-1, -1)
    year_back = calendar.rangeBetween(-12, -12)
    everything = Window.partitionBy()

    def change(now: str, before: Column, orders_before: Column) -> Column:
        comparable = (F.col("orders") >= threshold) & (orders_before >= threshold)
        return F.when(comparable, ratio(F.col(now) - before, before))

    month_orders = F.max("orders").over(one_back)
    month_revenue = F.max("product_revenue").over(one_back)
    year_orders = F.max("orders").over(year_back)
    year_revenue = F.max("product_revenue").over(year_back)
    return (
        months.withColumn("month_index", index)
        .withColumns(
            {
                "revenue_mom": change("product_revenue", month_revenue, month_orders),
                "orders_mom": change("orders", month_orders, month_orders),
                "revenue_yoy": change("product_revenue", year_revenue, year_orders),
                "is_edge_month": (F.col("month") == F.min("month").over(everything))
                | (F.col("month") == F.max("month").over(everything)),
            }
        )
        .drop("month_index")
    )


def punctuality_vs_score(fact: DataFrame) -> DataFrame:
    return (
        scored_punctuality(fact)
        .groupBy(F.col("customer_state").alias("state"), "punctuality_bucket")
        .agg(*punctuality_figures())
    )


def scored_punctuality(fact: DataFrame) -> DataFrame:
    return (
        delivered(fact)
        .where("delivered_at is not null and promised_at is not null")
        .select(
            "customer_state",
            bucketed(F.col("days_vs_promise"), labels.PUNCTUALITY_BUCKETS).alias(
                "punctuality_bucket"
            ),
            "review_score",
        )
    )


def punctuality_figures() -> list[Column]:
    score = F.col("review_score")
    return [
        rows().alias("orders"),
        mean(score, 2).alias("avg_score"),
        ratio(F.count_if(score <= labels.NEGATIVE_SCORE), F.count(score)).alias("negative_rate"),
    ]


def delivery_time_by_state(
    fact: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS
) -> DataFrame:
    return delivery_time_by_state_of(cells(fact, DAYS), threshold)


def delivery_time_by_state_of(
    days: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS
) -> DataFrame:
    """From the cells by state and days, which are a histogram: percentiles are exact, and no
    state of theirs is kept over the orders."""
    known = F.when(F.col("delivery_days").isNotNull(), F.col("arrived"))
    all_days = F.sum(F.col("delivery_days") * known)
    return (
        days.where("arrived > 0")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.sum("arrived").alias("delivered_orders"),
            ratio(all_days, F.sum(known), 1).alias("avg_delivery_days"),
            days_percentile(50).alias("p50_days"),
            days_percentile(90).alias("p90_days"),
            _mean("approval_days", 2).alias("avg_approval_days"),
            _mean("handling_days", 2).alias("avg_handling_days"),
            _mean("transit_days", 2).alias("avg_transit_days"),
            ratio(
                F.sum("sum_transit_days") / F.sum("with_transit_days"), all_days / F.sum(known)
            ).alias("courier_share"),
        )
        .withColumn("is_significant", significant(F.col("delivered_orders"), threshold))
    )


def days_percentile(percent: int) -> Column:
    """The least number of days that this part of the orders in cells did not take longer than.

    Gathers one entry for each cell, so for each different number of days (and state).
    """
    day = F.struct(F.col("delivery_days").alias("day"), F.col("arrived").alias("n"))
    histogram = F.array_sort(F.collect_list(F.when(F.col("delivery_days").isNotNull(), day)))
    need = F.sum(F.when(F.col("delivery_days").isNotNull(), F.col("arrived"))) * percent
    start = F.struct(F.lit(0).cast("long").alias("so_far"), F.lit(None).cast("long").alias("day"))

    def step(state: Column, own: Column) -> Column:
        so_far = state["so_far"] + own["n"]
        reached = F.when(so_far * 100 >= need, own["day"])
        return F.struct(so_far.alias("so_far"), F.coalesce(state["day"], reached).alias("day"))

    return F.aggregate(histogram, start, step, lambda state: state["day"])


def order_status_mix(fact: DataFrame) -> DataFrame:
    return order_status_mix_of(cells(fact, STATUS, measures=["orders"]))


def order_status_mix_of(statuses: DataFrame) -> DataFrame:
    counts = statuses.groupBy("order_status").agg(F.sum("orders").alias("orders"))
    # One row per status: the total over all of them is a handful of rows.
    everything = Window.partitionBy()
    return counts.withColumn("share", ratio(F.col("orders"), F.sum("orders").over(everything)))


def payment_method_mix(payments: DataFrame, base: DataFrame) -> DataFrame:
    """Payments of delivered orders by method.

    One row per (order, method) is built first, so orders per method are a row count. An
    order paid in two ways counts under both; shares refer to distinct orders and add up to
    more than one.
    """
    sold = delivered(base)
    per_order = payments.groupBy("order_id", "payment_type").agg(
        F.count("payment_value").alias("values"),
        F.sum("payment_value").alias("value"),
        F.count("installments").alias("with_installments"),
        F.sum("installments").alias("installments"),
        F.count_if(F.col("installments") > 1).alias("split"),
    )
    paid_orders = sold.where("has_payment").agg(rows()).scalar()
    card_installments = ratio(F.sum("installments"), F.sum("with_installments"), 1)
    return (
        per_order.join(sold.select("order_id"), "order_id", "left_semi")
        .groupBy("payment_type")
        .agg(
            rows().alias("orders"),
            total("value").alias("paid_volume"),
            ratio(F.sum("value"), F.sum("values"), 2).alias("avg_transaction"),
            card_installments.alias("all_installments"),
            F.sum("split").alias("payments_in_installments"),
        )
        .select(
            "payment_type",
            "orders",
            ratio(F.col("orders"), paid_orders).alias("order_share"),
            "paid_volume",
            "avg_transaction",
            F.when(F.col("payment_type") == labels.CREDIT_CARD, F.col("all_installments")).alias(
                "avg_installments"
            ),
            "payments_in_installments",
        )
    )


def take_rate(
    fact: DataFrame,
    commission: float = labels.COMMISSION,
    payment_fee: float = labels.PAYMENT_FEE,
) -> DataFrame:
    months = cells(fact, MONTH, ["purchase_month"], _MONEY)
    return take_rate_of(months, commission, payment_fee)


def take_rate_of(
    buyers: DataFrame,
    commission: float = labels.COMMISSION,
    payment_fee: float = labels.PAYMENT_FEE,
) -> DataFrame:
    """Estimated platform income per month, from two assumed rates.

    Commission is charged on merchandise, the fee on everything paid.
    """
    months = buyers.groupBy(F.col("purchase_month").alias("month")).agg(
        F.sum("orders").alias("orders"),
        total("sum_paid_value").alias("gmv"),
        total("sum_product_revenue").alias("product_revenue"),
    )
    return with_take_rate(months, rate(commission), rate(payment_fee)).select(
        "month",
        "orders",
        "gmv",
        "product_revenue",
        F.lit(float(commission)).alias("assumed_commission"),
        F.lit(float(payment_fee)).alias("assumed_fee"),
        "commission_income",
        "processing_cost",
        "platform_margin",
        "effective_rate",
    )


def rate(value: float) -> Column:
    """Exact decimal for a rate given as a number, so money stays exact."""
    return F.lit(str(value)).cast("decimal(6,4)")


def with_take_rate(months: DataFrame, commission: Column, payment_fee: Column) -> DataFrame:
    income = F.col("product_revenue") * commission
    cost = F.col("gmv") * payment_fee
    return months.withColumns(
        {
            "commission_income": F.round(income, 2).cast("decimal(28,2)"),
            "processing_cost": F.round(cost, 2).cast("decimal(28,2)"),
            "platform_margin": F.round(income - cost, 2).cast("decimal(28,2)"),
            "effective_rate": ratio(income - cost, F.col("gmv")),
        }
    )


def ticket_by_state(fact: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS) -> DataFrame:
    return ticket_by_state_of(cells(fact, DAYS, STATE), threshold)


def ticket_by_state_of(
    states: DataFrame, threshold: int = labels.SIGNIFICANT_ORDERS
) -> DataFrame:
    return (
        states.groupBy(F.col("customer_state").alias("state"))
        .agg(
            F.sum("orders").alias("orders"),
            _mean("paid_value", 2).alias("avg_paid_ticket"),
            _mean("product_revenue", 2).alias("avg_product_ticket"),
            _mean("max_installments", 1).alias("avg_installments"),
        )
        .withColumn("is_significant", significant(F.col("orders"), threshold))
    )


def executive_summary(
    fact: DataFrame, customers: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """One row of headline figures.

    Everything at order grain comes from one pass; the customer figures and the percentile are
    scalar subqueries, since distinct customers, the customer dimension and the cells by days
    have their own grain.
    """
    sold = F.col("is_delivered")

    def if_sold(name: str) -> Column:
        return F.when(sold, F.col(name))

    on_time = F.col("is_on_time")
    both_dates = F.col("delivered_at").isNotNull() & F.col("promised_at").isNotNull()
    due = ~F.col("order_status").isin(labels.NOT_YET_SHIPPABLE_STATUSES)
    orders = F.count_if(sold)
    days = cells(fact, DAYS, ["delivery_days"], ["arrived"]) if days is None else days
    p90 = days.where("arrived > 0").agg(days_percentile(90)).scalar()
    figures = fact.agg(
        F.min(if_sold("purchase_date")).alias("date_from"),
        F.max(if_sold("purchase_date")).alias("date_to"),
        orders.alias("delivered_orders"),
        F.sum(if_sold("product_revenue")).cast("decimal(28,2)").alias("product_revenue"),
        F.sum(if_sold("freight")).cast("decimal(28,2)").alias("freight_total"),
        F.sum(if_sold("paid_value")).cast("decimal(28,2)").alias("gmv"),
        ratio(F.sum(if_sold("product_revenue")), orders, 2).alias("product_ticket"),
        ratio(F.sum(if_sold("paid_value")), orders, 2).alias("paid_ticket"),
        ratio(F.count_if(sold & on_time), F.count_if(sold & both_dates)).alias("on_time_rate"),
        half_up(F.avg(-if_sold("days_vs_promise")), 1).alias("promise_cushion_days"),
        mean(if_sold("review_score"), 2).alias("avg_score"),
        ratio(F.count_if(due & on_time), F.count_if(due)).alias("on_time_rate_global"),
        ratio(F.count_if(F.col("is_cancelled")), rows()).alias("cancel_rate"),
    )
    unique_customers = fact.where("is_delivered").agg(F.countDistinct("customer_uid")).scalar()
    recurrent_rate = customers.agg(
        ratio(F.count_if(F.col("segment") == labels.SEGMENT_RECURRENT), rows())
    ).scalar()
    return figures.select(
        "date_from",
        "date_to",
        "delivered_orders",
        unique_customers.alias("unique_customers"),
        "product_revenue",
        "freight_total",
        "gmv",
        "product_ticket",
        "paid_ticket",
        "on_time_rate",
        p90.alias("delivery_p90"),
        "promise_cushion_days",
        "avg_score",
        "on_time_rate_global",
        recurrent_rate.alias("recurrent_rate"),
        "cancel_rate",
    )
