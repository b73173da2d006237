"""The nine raw tables, derived from order-processing tables in Parquet.

Each function states one raw table as a projection or join of the given tables, and keeps
every row of them. The gaps and oddities a real marketplace shows (a month without orders,
unpaid orders, several reviews of one order, buyers without coordinates) come from moving rows
by fixed arithmetic on the keys: to the next month, to another order, to another prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.expressions import MONEY
from souk.operators.numbering import number_within
from souk.sources.store import TableStore

# Fixed values of the mapping
GAP_MONTH = ("1996-05-01", "1996-06-01")
PILOT_MONTH = ("1995-01-01", "1995-02-01")
PILOT_KEEPS_EVERY = 40
PENDING_STATUSES = [
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
SELLERS_PER_SUPPLIER = 20
UNTRANSLATED_BRAND = "Brand#7"
UNLOCATED_NATION = 24
# Buyers of a state that live in its one large city
CAPITAL_HAS_EVERY = 3
PAID_ELSEWHERE_EVERY = 499
UNKNOWN_ORDER_EVERY = 5 * PAID_ELSEWHERE_EVERY
# All that an item has besides its order and number: rows equal in these are equal items.
ITEM_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
]


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(mins=n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def _order_day() -> Column:
    """The order's day; orders of the gap month, and most of the pilot month, a month later."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey")

    def within(month: tuple[str, str]) -> Column:
        first, after = (F.lit(x).cast("timestamp_ntz") for x in month)
        return (day >= first) & (day < after)

    later = within(GAP_MONTH) | (within(PILOT_MONTH) & (key % PILOT_KEEPS_EVERY != 0))
    return F.when(later, day + F.make_ym_interval(months=F.lit(1))).otherwise(day)


class DriverTables:
    """Raw tables by name, over `<folder>/<table>.parquet`.

    The two tables that need joins or numbering are written once per application, as a load
    job would; the rest are narrow projections and stay lazy.
    """

    LANDED = ("raw_orders", "raw_order_items", "raw_customers")

    def __init__(self, spark: SparkSession, folder: str, scratch: TableStore):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.scratch = scratch
        self._base: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._base[name]

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            df = getattr(self, name)()
            self._raw[name] = self.scratch.replace(df, name) if name in self.LANDED else df
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.raw(name)

    def raw_orders(self) -> DataFrame:
        with_items = self.base("lineitem").select(F.col("l_orderkey").alias("item_order")).distinct()
        key = F.col("o_orderkey")
        pending = F.element_at(
            F.array(*[F.lit(s) for s in PENDING_STATUSES]), (key % 7 + 1).cast("int")
        )
        status = (
            F.when(F.col("item_order").isNull(), "unavailable")
            .when(F.col("o_orderstatus").isin("F", "O"), "delivered")
            .otherwise(pending)
        )
        day = _order_day()
        bought = key * 37 % 1440
        dispatched = key * 31 % 240
        no_dispatch = F.col("order_status").isin(
            "created", "approved", "invoiced", "processing", "unavailable"
        )
        arrived = (F.col("order_status") == "delivered") & (key % 211 != 0)
        return (
            self.base("orders")
            .join(with_items, F.col("o_orderkey") == F.col("item_order"), "left")
            .withColumn("order_status", status)
            .select(
                key.alias("order_id"),
                key.alias("customer_id"),
                "order_status",
                (day + _minutes(bought)).alias("order_purchase_timestamp"),
                F.when(key % 97 != 0, day + _minutes(bought + key * 13 % 2880)).alias(
                    "order_approved_at"
                ),
                F.when(~no_dispatch, day + _hours(48 + dispatched)).alias(
                    "order_delivered_carrier_date"
                ),
                F.when(arrived, day + _hours(72 + dispatched + key * 17 % 600)).alias(
                    "order_delivered_customer_date"
                ),
                (day + _days(12 + key % 25)).alias("order_estimated_delivery_date"),
            )
        )

    def raw_customers(self) -> DataFrame:
        orders = self.base("orders").select("o_orderkey", "o_custkey")
        buyers = self.base("customer").join(
            self.base("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        key, cust = F.col("o_orderkey"), F.col("c_custkey")
        return orders.join(buyers, F.col("o_custkey") == cust).select(
            key.alias("customer_id"),
            cust.alias("customer_unique_id"),
            (F.col("c_nationkey") * 100 + cust % 10).cast("long").alias("customer_zip_code_prefix"),
            F.when(cust % CAPITAL_HAS_EVERY == 0, "capital")
            .otherwise(F.concat(F.lit("city_"), ((cust + key % 3) % 60).cast("string")))
            .alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    def raw_order_items(self) -> DataFrame:
        lines = self.base("lineitem").select("l_orderkey", *ITEM_ORDER)
        numbered = number_within(
            lines, "l_orderkey", ITEM_ORDER, "item_no", self.scratch, "ordered_lines"
        )
        return numbered.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("item_no").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            (F.col("l_suppkey") * SELLERS_PER_SUPPLIER + F.col("l_partkey") % SELLERS_PER_SUPPLIER).alias(
                "seller_id"
            ),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            (F.col("l_quantity") * 1.25).cast(MONEY).alias("freight_value"),
        )

    def raw_payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        kind = key % 4
        # Some orders are paid with another one, and some payments name no order there is.
        elsewhere = key % PAID_ELSEWHERE_EVERY == 0
        paid_order = (
            F.when(key % UNKNOWN_ORDER_EVERY == 0, -1 - key)
            .when(elsewhere, key - 1)
            .otherwise(key)
        )
        first = F.when(elsewhere, F.lit(3)).otherwise(F.lit(1)).cast("long")
        method = (
            F.when(kind == 0, "boleto").when(kind == 1, "debit_card").otherwise("credit_card")
        )
        main = F.struct(
            first.alias("payment_sequential"),
            method.alias("payment_type"),
            F.when(kind >= 2, key % 10 + 1).otherwise(F.lit(1).cast("long")).alias(
                "payment_installments"
            ),
            F.col("o_totalprice").cast(MONEY).alias("payment_value"),
        )
        extra = F.struct(
            (first + 1).alias("payment_sequential"),
            F.lit("voucher").alias("payment_type"),
            F.lit(1).cast("long").alias("payment_installments"),
            F.lit("25.50").cast(MONEY).alias("payment_value"),
        )
        payments = F.when(key % 45 == 0, F.array(main, extra)).otherwise(F.array(main))
        return self.base("orders").select(paid_order.alias("order_id"), F.inline(payments))

    def raw_reviews(self) -> DataFrame:
        # The range goes beyond the last order, so that some reviews name no order there is.
        last = F.max("o_orderkey")
        order_range = self.base("orders").agg(last + 1 + F.floor(last / 50)).scalar()
        first = F.col("event_id") * 7919
        reviewed = F.when(
            F.col("event_type") == "error",
            F.array(first % F.col("n"), (first + 1) % F.col("n")),
        ).otherwise(F.array(first % F.col("n")))
        return (
            self.base("events")
            .withColumn("n", order_range)
            .select(
                F.col("event_id").alias("review_id"),
                F.explode(reviewed).alias("order_id"),
                (1 + F.floor("value") % 5).cast("long").alias("review_score"),
                F.lit("").alias("review_comment_title"),
                F.col("props").alias("review_comment_message"),
                F.col("ts").alias("review_creation_date"),
                F.col("ts").alias("review_answer_timestamp"),
            )
        )

    def raw_products(self) -> DataFrame:
        key = F.col("p_partkey")
        size = F.col("p_size").cast("long")
        return self.base("part").select(
            key.alias("product_id"),
            F.when(key % 61 != 0, F.col("p_brand")).alias("product_category_name"),
            F.when(key % 53 != 0, size * size * 4).alias("product_weight_g"),
            (5 + key % 40).alias("product_length_cm"),
            (3 + key % 23).alias("product_height_cm"),
            F.when(key % 71 != 0, 4 + key % 31).alias("product_width_cm"),
        )

    def raw_category_translation(self) -> DataFrame:
        brand = F.col("product_category_name")
        english = F.when(brand != UNTRANSLATED_BRAND, F.lower(brand))
        return (
            self.base("part")
            .select(F.col("p_brand").alias("product_category_name"))
            .distinct()
            .withColumn("product_category_name_english", english)
        )

    def raw_sellers(self) -> DataFrame:
        shops = self.base("supplier").join(
            self.base("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        key = F.col("s_suppkey")
        slots = F.sequence(F.lit(0).cast("long"), F.lit(SELLERS_PER_SUPPLIER - 1).cast("long"))
        return shops.withColumn("slot", F.explode(slots)).select(
            (key * SELLERS_PER_SUPPLIER + F.col("slot")).alias("seller_id"),
            (F.col("s_nationkey") * 100 + key % 10).cast("long").alias("seller_zip_code_prefix"),
            F.concat(F.lit("city_"), (key % 37).cast("string")).alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )

    def raw_geolocation(self) -> DataFrame:
        nation, cust = F.col("c_nationkey").cast("long"), F.col("c_custkey")

        def degrees(base: int, step: str, scale: Column, fine: Column) -> Column:
            exact = F.lit(base) + F.lit(step).cast("decimal(3,1)") * scale + fine * F.lit(
                "0.001"
            ).cast("decimal(4,3)")
            return exact.cast("double")

        # Prefixes of this nation's coordinates are those of no buyer or seller.
        elsewhere = F.when(nation == UNLOCATED_NATION, 50).otherwise(0)
        return self.base("customer").select(
            (nation * 100 + cust % 10 + elsewhere).alias("geolocation_zip_code_prefix"),
            degrees(-30, "0.9", nation, cust % 100).alias("geolocation_lat"),
            degrees(-60, "0.6", nation * 7 % 25, cust % 90).alias("geolocation_lng"),
        )
