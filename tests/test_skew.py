"""One order, product, supplier, customer and nation each hold a third of all rows."""

from contextlib import contextmanager
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check_against_duckdb import difference, duck
from conftest import SMALL
from souk.plans.consumer import QUESTIONS
from souk.plans.warehouse import MODELS, Warehouse
from souk.sources.driver_tables import DriverTables
from souk.sources.store import TableStore

SKEWED = {
    "orders": "o_custkey = case when o_orderkey % 3 = 0 then 11 else o_custkey end",
    "lineitem": """l_orderkey = case when hash(l_extendedprice) % 3 = 0 then 20 else l_orderkey end,
      l_partkey = case when hash(l_extendedprice, 1) % 3 = 0 then 5 else l_partkey end,
      l_suppkey = case when hash(l_extendedprice, 2) % 3 = 0 then 3 else l_suppkey end""",
    "customer": "c_nationkey = case when c_custkey % 3 = 0 then 2 else c_nationkey end",
}

# Every join a shuffle join, and partitions of a few kilobytes already worth splitting
SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "32KB",
    "spark.sql.files.openCostInBytes": "1KB",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        con.execute(f"create table t as select * from '{file}'")
        if file.stem in SKEWED:
            con.execute(f"update t set {SKEWED[file.stem]}")
        # several row groups, so that the scan has several tasks
        con.execute(f"copy t to '{target / file.name}' (format parquet, row_group_size 2048)")
        con.execute("drop table t")
    return str(target)


@pytest.fixture(scope="module")
def skewed(spark, folder, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("skewed_tables")))
    raw = DriverTables(spark, folder, store)
    return Warehouse(spark, raw, store)


@pytest.mark.parametrize("name", [*(m for m in MODELS if m != "order_base"), *QUESTIONS])
def test_results_are_whole(spark, skewed, folder, name):
    df = QUESTIONS[name](skewed) if name in QUESTIONS else skewed[name]
    assert difference(df, duck(folder), contract.oracle_sql()[name]) is None


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_join_keys_are_split(spark, skewed, folder):
    with settings(spark, SPLITTING):
        plan = skewed.plan("fact_order_items")
        assert "skew=true" in executed_plan(plan)
        assert difference(plan, duck(folder), contract.oracle_sql()["fact_order_items"]) is None
