"""What the physical plans must look like, whatever the data size."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from souk.plans import quality_suite
from souk.plans.consumer import QUESTIONS
from souk.plans.warehouse import BY_ORDER, MODELS, OF_ITEMS, SHARED, TABLES, Warehouse
from souk.sources.store import TableStore


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def every_plan(warehouse):
    for name in MODELS:
        yield name, warehouse.plan(name)
    for name, question in QUESTIONS.items():
        yield name, question(warehouse)


def test_no_cross_joins_and_no_python_workers(warehouse):
    for name, df in every_plan(warehouse):
        plan = plan_of(df)
        for node in ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"]:
            assert node not in plan, (name, node)


ONE_PARTITION_BY_DESIGN = {
    # windows over one row per month, category or status
    "monthly_sales",
    "sales_by_category",
    "order_status_mix",
    "categories_to_80pct",
    "monthly_trend_clean",
    "status_ranked",
}


def test_windows_over_everything_only_where_rows_are_few(warehouse):
    for name, df in every_plan(warehouse):
        windows = [line for line in plan_of(df).splitlines() if re.search(r"\bWindow \[", line)]
        unpartitioned = [w for w in windows if not re.search(r"windowspecdefinition\(\w+#", w)]
        if unpartitioned:
            assert name in ONE_PARTITION_BY_DESIGN, (name, unpartitioned)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("sales_by_city", "customer_city customer_state freight is_delivered paid_value product_revenue"),
        ("ticket_by_state", "customer_state is_delivered max_installments paid_value product_revenue"),
        ("freight_erosion", "billable_weight_g category freight is_delivered product_revenue weight_bucket"),
        ("order_status_mix", "order_status"),
    ],
)
def test_scans_read_only_what_is_needed(warehouse, name, columns):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(warehouse.plan(name))).group(1)
    names = sorted(re.findall(r"(\w+):", read))
    assert names == columns.split()


@pytest.mark.parametrize("name", ["sales_by_city", "take_rate", "score_by_category"])
def test_filters_reach_the_scan(warehouse, name):
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan_of(warehouse.plan(name))).group(1)
    assert "EqualTo(is_delivered,true)" in pushed


def test_item_fact_joins_no_table_twice(warehouse):
    """Coordinates come with the order and the seller, not by joins of their own."""
    plan = plan_of(warehouse.plan("fact_order_items"))
    assert len(re.findall(r"(SortMerge|BroadcastHash|ShuffledHash)Join", plan)) <= 6
    assert "raw_customers" not in plan


def test_order_fact_reads_items_in_two_narrow_columns_more(warehouse):
    """Numbering the items is not paid for where the number is not used."""
    plan = plan_of(warehouse.plan("order_base"))
    assert "order_item_id" not in plan


@contextmanager
def without_broadcasts(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_order_joins_need_no_shuffle(spark, warehouse):
    with without_broadcasts(spark):
        plan = plan_of(warehouse.plan("order_base"))
    joins = re.findall(r"SortMergeJoin \[(\w+)#\d+L?\], \[\w+#\d+L?\], (\w+)", plan)
    assert sorted(joins) == [
        ("customer_id", "Inner"), *[("order_id", "LeftOuter")] * 3, ("zip_prefix", "LeftOuter")
    ]
    assert "hashpartitioning(order_id" not in plan
    assert plan.count("SelectedBucketsCount") == 4


@pytest.mark.parametrize("name", ["fact_order_items", "fact_orders"])
def test_a_month_is_read_from_its_folder_alone(warehouse, name):
    month = warehouse[name].where("purchase_month = date'1996-07-01'")
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(month)).group(1)
    assert "purchase_month" in filters
    files = month.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("/purchase_month=1996-07-01/" in row.f for row in files)
    whole = warehouse[name].where("date_format(purchase_month, 'yyyyMM') = '199607'")
    assert month.count() == whole.count() > 0


def test_declared_checks_scan_each_table_once_and_shuffle_once(warehouse):
    warehouse.tables(quality_suite.DECLARED)
    plan = plan_of(quality_suite.declared_report(warehouse))
    shuffles = re.findall(r"hashpartitioning\((\w+)#\d+, (\w+)#\d+, \d+\)", plan)
    assert shuffles.count(("tag", "key")) == 1
    for name in set(TABLES) & set(quality_suite.DECLARED):
        path = warehouse.store.path(name)
        # The order fact is a view of the order table.
        assert plan.count(f"{path}]") <= 1, name


def test_item_fact_shuffles_lines_before_they_are_wide(spark, warehouse):
    with without_broadcasts(spark):
        plan = plan_of(warehouse.plan("fact_order_items"))
    joins = re.findall(r"SortMergeJoin \[(\w+)#\d+L?\], \[\w+#\d+L?\], Inner", plan)
    assert joins[:3] == ["order_id", "seller_id", "product_id"]


def test_item_fact_is_written_in_steps_that_do_not_stay(spark, warehouse, tmp_path):
    steps = []

    class Store(TableStore):
        def replace(self, df, table, *args, **options):
            if table in ("offered_items", "sold_items", "fact_order_items"):
                steps.append((table, self.has("offered_items"), plan_of(df).count("Join")))
            return super().replace(df, table, *args, **options)

    built = Warehouse(spark, warehouse.raw, Store(spark, str(tmp_path / "built")))
    fact, whole = built["fact_order_items"], built.plan("fact_order_items")
    assert fact.columns == whole.columns and fact.count() > 0
    assert fact.exceptAll(whole).isEmpty() and whole.exceptAll(fact).isEmpty()
    assert [name for name, _, _ in steps] == ["offered_items", "sold_items", "fact_order_items"]
    assert [there for _, there, _ in steps] == [False, True, False] and steps[-1][2] == 0
    for name in ("offered_items", "sold_items", "hot_orders", *BY_ORDER):
        assert not built.store.has(name), name


def test_tables_by_order_stay_for_a_plan_over_them(spark, warehouse, tmp_path):
    built = Warehouse(spark, warehouse.raw, TableStore(spark, str(tmp_path / "built")))
    plan = built.plan("order_base")
    assert plan.exceptAll(built["order_base"]).isEmpty()


def test_marts_over_the_item_fact_are_written_one_after_another(spark, warehouse, tmp_path):
    running, together = set(), []

    class Store(TableStore):
        def replace(self, df, table, *args, **options):
            running.add(table)
            together.append(running & set(OF_ITEMS))
            try:
                return super().replace(df, table, *args, **options)
            finally:
                running.discard(table)

    over_items = {n for n in TABLES if n not in SHARED and "/fact_order_items" in plan_of(warehouse.plan(n))}
    assert over_items == set(OF_ITEMS)
    built = Warehouse(spark, warehouse.raw, Store(spark, str(tmp_path / "built")))
    built.tables(["order_status_mix", *OF_ITEMS])
    assert max(map(len, together)) == 1
    assert all(built.store.has(name) for name in ["order_status_mix", *OF_ITEMS])


def test_plans_after_a_build_are_over_the_order_fact(spark, warehouse, tmp_path):
    built = Warehouse(spark, warehouse.raw, TableStore(spark, str(tmp_path / "built")))
    built.tables(["order_status_mix", "take_rate"])
    for name in ("order_status_mix", "take_rate"):
        assert "order_cells" not in plan_of(built.plan(name))
        assert built[name].exceptAll(warehouse.plan(name)).isEmpty()
