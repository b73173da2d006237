"""All models over one set of raw tables.

Staging models are lazy views. The few tables that many models read are written once, to
shared storage: a mart then scans only its columns of one table, and a lost executor costs
a re-read. Every other model is a plan over those tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions import labels
from souk.operators import dimensions, facts, item_marts, order_marts, staging
from souk.session import shuffle_partitions
from souk.sources.store import PLAIN, Layout, TableStore

# model -> how it follows from the warehouse, in build order
MODELS: dict[str, Callable[["Warehouse"], DataFrame]] = {
    "stg_orders": lambda w: staging.stg_orders(w.raw["raw_orders"]),
    "stg_customers": lambda w: staging.stg_customers(w.raw["raw_customers"]),
    "stg_order_items": lambda w: staging.stg_order_items(w.raw["raw_order_items"]),
    "stg_payments": lambda w: staging.stg_payments(w.raw["raw_payments"]),
    "stg_reviews": lambda w: staging.stg_reviews(w.raw["raw_reviews"]),
    "stg_products": lambda w: staging.stg_products(
        w.raw["raw_products"], w.raw["raw_category_translation"]
    ),
    "stg_sellers": lambda w: staging.stg_sellers(w.raw["raw_sellers"]),
    "stg_geolocation": lambda w: staging.stg_geolocation(w.raw["raw_geolocation"]),
    "payments_per_order": lambda w: staging.payments_per_order(w["stg_payments"]),
    "order_base": lambda w: facts.order_table(
        *w.by_order().values(), w["stg_customers"], w["stg_geolocation"]
    ),
    "dim_customers": lambda w: dimensions.dim_customers(w["order_base"], w["stg_orders"]),
    "dim_products": lambda w: dimensions.dim_products(w["stg_products"]),
    "dim_sellers": lambda w: dimensions.dim_sellers(w["stg_sellers"], w["stg_geolocation"]),
    "dim_date": lambda w: dimensions.dim_date(w["stg_orders"]),
    "fact_orders": lambda w: facts.fact_orders(w["order_base"]),
    "fact_order_items": lambda w: facts.fact_order_items(
        w["stg_order_items"], w["order_base"], w["dim_products"], w["dim_sellers"]
    ),
    "cohort_retention": lambda w: facts.cohort_retention(w["order_base"], w["dim_customers"]),
    "sales_by_city": lambda w: order_marts.sales_by_city_of(w.cells(order_marts.CITY)),
    "monthly_sales": lambda w: order_marts.monthly_sales_of(w.cells(order_marts.MONTH)),
    "sales_by_category": lambda w: item_marts.sales_by_category(w["fact_order_items"]),
    "revenue_concentration": lambda w: item_marts.revenue_concentration(w["fact_order_items"]),
    "distance_vs_delivery": lambda w: item_marts.distance_vs_delivery(w["fact_order_items"]),
    "punctuality_vs_score": lambda w: order_marts.punctuality_vs_score(w["fact_orders"]),
    "delivery_time_by_state": lambda w: order_marts.delivery_time_by_state_of(
        w.cells(order_marts.DAYS)
    ),
    "order_status_mix": lambda w: order_marts.order_status_mix_of(w.cells(order_marts.STATUS)),
    "score_by_category": lambda w: item_marts.score_by_category(w["fact_order_items"]),
    "freight_erosion": lambda w: item_marts.freight_erosion(w["fact_order_items"]),
    "seller_scorecard": lambda w: item_marts.seller_scorecard(
        w["fact_order_items"], w["dim_sellers"]
    ),
    "payment_method_mix": lambda w: order_marts.payment_method_mix(
        w["stg_payments"], w["order_base"]
    ),
    "take_rate": lambda w: order_marts.take_rate_of(
        w.cells(order_marts.MONTH, ["purchase_month"]), w.commission, w.payment_fee
    ),
    "ticket_by_state": lambda w: order_marts.ticket_by_state_of(
        w.cells(order_marts.DAYS, order_marts.STATE)
    ),
    "executive_summary": lambda w: order_marts.executive_summary(
        w["fact_orders"], w["dim_customers"], w.cells(order_marts.DAYS, ["delivery_days"])
    ),
}

VIEWS = [name for name in MODELS if name.startswith("stg_") and name != "stg_geolocation"] + [
    "payments_per_order",
    "fact_orders",
]
TABLES = [name for name in MODELS if name not in VIEWS]

# Written as soon as anything reads them; the other tables are written by a build.
SHARED = ("stg_geolocation", "order_base", "dim_customers", "fact_order_items")

# What the order table joins by order, stored by it: one row per order, so no bucket is hot.
BY_ORDER: dict[str, Callable[["Warehouse"], DataFrame]] = {
    "orders_by_order": lambda w: w["stg_orders"].repartition(w.buckets, "order_id"),
    "items_by_order": lambda w: facts.items_per_order(w["stg_order_items"], w.hot_orders()),
    "payments_by_order": lambda w: w["payments_per_order"],
    "scores_by_order": lambda w: facts.scores_per_order(w["stg_reviews"]),
}

HOT_ORDERS = "hot_orders"

# The facts have a folder for each month, so that a question about some months reads only those.
BY_MONTH = Layout(partition_by=("purchase_month",))
LAYOUTS = {"order_base": BY_MONTH, "fact_order_items": BY_MONTH}

# Marts that add up cells of the order fact. A build that writes several of them writes the cells
# first, in one pass over the fact.
OF_CELLS = {
    "sales_by_city",
    "monthly_sales",
    "delivery_time_by_state",
    "order_status_mix",
    "take_rate",
    "ticket_by_state",
    "executive_summary",
}
ORDER_CELLS = "order_cells"

# Marts that shuffle the item fact, each enough work for a cluster: one is written after another,
# so that the shuffle files of one are gone before the next begins.
OF_ITEMS = (
    "sales_by_category",
    "revenue_concentration",
    "distance_vs_delivery",
    "score_by_category",
    "freight_erosion",
    "seller_scorecard",
)

# Lines on their way into the item fact, written after the joins by product and seller and after
# that by order. The shuffles before each are gone when the next begins; the tables go at the end.
OFFERED_ITEMS, SOLD_ITEMS = "offered_items", "sold_items"

# What the models of the last build are
DEFINITIONS = "definitions"

# Tables that a build writes at the same time
WRITERS = 8


def rate_figures(columns: Iterable[str]) -> dict[str, Column]:
    """What the range checks need of rate columns."""
    out = {}
    for name in columns:
        value = F.col(name).cast("double")
        out |= {
            f"{name}.rows": F.count(F.lit(1)),
            f"{name}.known": F.count(value),
            f"{name}.outside": F.count_if((value < 0) | (value > 1)),
            f"{name}.lowest": F.min(value),
            f"{name}.highest": F.max(value),
        }
    return out


def total_figures(totals: dict[str, Column]) -> dict[str, Column]:
    return {f"{name}.total": total.cast("decimal(38,2)") for name, total in totals.items()}


# The shares and totals that are checked, observed while their table is written
RATES: list[tuple[str, list[str]]] = [
    (
        "executive_summary",
        ["on_time_rate", "on_time_rate_global", "recurrent_rate", "cancel_rate"],
    ),
    ("order_status_mix", ["share"]),
    ("distance_vs_delivery", ["late_rate"]),
    ("seller_scorecard", ["late_rate", "cancel_rate"]),
    ("punctuality_vs_score", ["negative_rate"]),
    ("sales_by_category", ["revenue_share"]),
    ("revenue_concentration", ["revenue_share"]),
    ("cohort_retention", ["retention_rate"]),
]
# table -> name of the figure -> summed column
TOTALS: dict[str, dict[str, str]] = {
    "sales_by_city": {"revenue": "product_revenue", "orders": "orders"},
    "monthly_sales": {"revenue": "product_revenue", "orders": "orders"},
    "sales_by_category": {"revenue": "product_revenue"},
    "executive_summary": {"revenue": "product_revenue", "orders": "delivered_orders"},
    "take_rate": {"revenue": "product_revenue"},
}


def figures_of(name: str) -> dict[str, Column]:
    totals = {figure: F.sum(column) for figure, column in TOTALS.get(name, {}).items()}
    if name == "fact_order_items":
        totals["revenue"] = F.sum(F.when(F.col("is_delivered"), F.col("product_revenue")))
    return rate_figures(dict(RATES).get(name, [])) | total_figures(totals)


class Warehouse:
    """`warehouse["sales_by_city"]` is a DataFrame; nothing but the shared tables is run."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        store: TableStore,
        commission: float = labels.COMMISSION,
        payment_fee: float = labels.PAYMENT_FEE,
        built: bool = False,
    ):
        """With `built`, tables are read as an earlier build wrote them."""
        self.spark = spark
        self.raw = raw
        self.store = store
        self.built = built
        self.commission = commission
        self.payment_fee = payment_fee
        self._kept: set[str] = set()
        self._models: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        self._by_order: dict[str, DataFrame] = {}
        # Cells of the order fact once written, and while a build reads them
        self._written_cells: DataFrame | None = None
        self._cells: DataFrame | None = None

    def plan(self, name: str) -> DataFrame:
        """The model as a plan over the tables it reads, whether or not it is written."""
        return MODELS[name](self)

    def __getitem__(self, name: str) -> DataFrame:
        if name in SHARED or name in self._tables or self.built and name in TABLES:
            return self.table(name)
        if name not in self._models:
            self._models[name] = self.plan(name)
        return self._models[name]

    def table(self, name: str) -> DataFrame:
        """The model as a written table; views stay as they are."""
        if name in VIEWS:
            return self[name]
        if name not in self._tables:
            written = self.built or name in self._kept
            self._tables[name] = self.store.read(name) if written else self._write(name)
        return self._tables[name]

    def _write(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        """The model's rows, or the given ones, as its table."""
        # Tables by order that a plan was made of before stay for it.
        in_use = bool(self._by_order)
        if rows is None:
            rows = self._item_fact() if name == "fact_order_items" else self.plan(name)
        layout = LAYOUTS.get(name, PLAIN)
        written = self.store.replace(rows, name, layout=layout, figures=figures_of(name))
        if name == "fact_order_items":
            self.store.drop(SOLD_ITEMS)
        elif name == "order_base" and not in_use:
            for part in [*BY_ORDER, HOT_ORDERS]:
                self.store.drop(part)
            self._by_order = {}
        return written

    def _item_fact(self) -> DataFrame:
        """The item fact as its plan has it, with the lines written between its shuffles."""
        offered = facts.offered_items(
            self["stg_order_items"], self["dim_products"], self["dim_sellers"]
        )
        offered = self.store.replace(offered, OFFERED_ITEMS)
        sold = self.store.replace(facts.sold_items(offered, self["order_base"]), SOLD_ITEMS)
        self.store.drop(OFFERED_ITEMS)
        return sold

    def tables(self, names: Iterable[str]) -> None:
        """Write tables that are not written yet, several at a time: most are too small to fill
        a cluster. The shared ones come before, in their order."""
        names = [name for name in names if name not in VIEWS]
        for name in SHARED:
            if name in names or len(names) > 1:
                self.table(name)
        due = [name for name in names if name not in self._tables and name not in self._kept]
        if not self.built and len(OF_CELLS & set(due)) > 1:
            if self._written_cells is None:
                every = order_marts.all_cells(self["fact_orders"])
                layout = Layout(("cells",))
                self._written_cells = self.store.replace(every, ORDER_CELLS, layout=layout)
            self._cells = self._written_cells
        for name in due:
            # Plans of before the cells were there
            self._models.pop(name, None)
        try:
            # All plans come before the first write (see `shuffles_dropped`).
            plans = {} if self.built else {name: self.plan(name) for name in due}
        finally:
            # A plan made later is again one over the order fact.
            self._cells = None

        def write(some: list[str]) -> None:
            for name in some:
                self._tables[name] = self._write(name, plans[name])

        one_by_one = [name for name in plans if name in OF_ITEMS]
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(write, [one_by_one, *([n] for n in plans if n not in OF_ITEMS)]))
        for name in names:
            self.table(name)

    @property
    def buckets(self) -> int:
        return shuffle_partitions(self.spark)

    def hot_orders(self) -> DataFrame:
        """Written, as few rows are broadcast only from a table."""
        return self.store.replace(facts.hot_orders(self["stg_order_items"]), HOT_ORDERS)

    def by_order(self) -> dict[str, DataFrame]:
        """The tables of `BY_ORDER`, written by order once for this warehouse."""
        layout = Layout(bucket_by="order_id", buckets=self.buckets)

        def write(name: str) -> DataFrame:
            return self.store.replace(plans[name], name, layout=layout)

        if not self._by_order:
            # All plans come before the first write (see `shuffles_dropped`).
            plans = {name: plan(self) for name, plan in BY_ORDER.items()}
            with ThreadPoolExecutor(WRITERS) as pool:
                self._by_order = dict(zip(BY_ORDER, pool.map(write, BY_ORDER)))
        return self._by_order

    def cells(self, name: str, keys: list[str] | None = None) -> DataFrame:
        """Cells of the order fact, as a build wrote them; else coarse ones, by the given keys."""
        if self._cells is None:
            return order_marts.cells(self["fact_orders"], name, keys)
        return self._cells.where(F.col("cells") == name)

    def figures(self, name: str) -> dict[str, str | None]:
        """The figures of a table, which is written if it is not."""
        table, kept = self.table(name), self.store.figures(name)
        if kept is None:
            # Written by something that observed none
            row = table.agg(*[f.alias(key) for key, f in figures_of(name).items()]).first()
            kept = {key: None if v is None else str(v) for key, v in row.asDict().items()}
        return kept

    @classmethod
    def opened(cls, spark: SparkSession, raw: Mapping[str, DataFrame], store: TableStore) -> "Warehouse":
        """The last build of a store, with the rates it was built with. Nothing is written."""
        kept = json.loads(store.read_note(DEFINITIONS) or "{}")
        return cls(spark, raw, store, built=True, **kept.get("rates", {}))

    def define(self) -> None:
        """Keeps what every model is beside the tables, for sessions to come: a table that was
        written, or a view over others, and the columns of both."""
        models = {
            name: {"kind": "view" if name in VIEWS else "table", "columns": self[name].schema.simpleString()}
            for name in MODELS
            if name in VIEWS or self.store.has(name)
        }
        rates = {"commission": self.commission, "payment_fee": self.payment_fee}
        self.store.write_note(DEFINITIONS, json.dumps({"rates": rates, "models": models}, indent=1))

    def defined(self) -> list[str]:
        """The models that the last build left."""
        kept = json.loads(self.store.read_note(DEFINITIONS) or "{}")
        return [name for name in MODELS if name in kept.get("models", {})]

    def build(self, names: list[str] | None = None) -> None:
        """Write every selected table in full, publish every model as a temp view, and keep the
        definitions of all of them in the store.

        What a selection reads of other tables comes from the last build where there is one.
        """
        if names:
            self._kept = {name for name in TABLES if name not in names and self.store.has(name)}
        self.tables(names or list(MODELS))
        self.publish(names)
        self.define()

    def publish(self, names: list[str] | None = None) -> None:
        """Make the models available to `spark.sql` under their names."""
        for name in names or list(MODELS):
            self[name].createOrReplaceTempView(name)
