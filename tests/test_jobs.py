import os
import threading
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.__main__ import main
from souk.plans.warehouse import MODELS, Warehouse
from souk.session import (
    CHECKPOINT_DIR,
    DROPS_SHUFFLES,
    MB,
    input_bytes,
    partition_sizes,
    rename,
    shared_folder,
    shuffles_dropped,
)
from souk.sources import csv_files
from souk.sources import store as store_module
from souk.sources.csv_ingest import LoadedTables
from souk.sources.store import Layout, TableStore


def test_load_build_test_and_show(spark, warehouse, tmp_path, capsys):
    files = csv_files.write_all(warehouse.raw, TableStore(spark, str(tmp_path / "files")))
    store = str(tmp_path / "store")

    assert main(["load", "--csv", files, "--store", store], spark) == 0
    assert "raw_reviews" in capsys.readouterr().out

    assert main(["build", "--store", store], spark) == 0
    # orphaned reviews and payments, and item records with the price NA
    assert main(["test", "--store", store], spark) == 1
    out = capsys.readouterr().out
    assert "relationships stg_payments order_id" in out
    assert "not_null stg_order_items price" in out

    before = spark.read.parquet(f"{store}/take_rate").selectExpr("sum(commission_income)").first()[0]
    fact = f"{store}/fact_order_items"
    files_of_fact = sorted(os.listdir(fact))
    select = ["--select", "take_rate", "--commission", "0.30"]
    assert main(["build", "--store", store, *select], spark) == 0
    after = spark.read.parquet(f"{store}/take_rate").selectExpr("sum(commission_income)").first()[0]
    assert after == pytest.approx(2 * before, abs=Decimal("1.00"))

    assert main(["build", "--store", store, "--select", "freight_erosion"], spark) == 0
    assert sorted(os.listdir(fact)) == files_of_fact
    assert not [name for name in os.listdir(store) if name.endswith((".next", "_lines"))]

    assert main(["show", "--store", store, "take_rate"], spark) == 0
    assert "effective_rate" in capsys.readouterr().out


def test_views_and_rates_outlast_the_session(spark, warehouse, tmp_path, capsys):
    files = csv_files.write_all(warehouse.raw, TableStore(spark, str(tmp_path / "files")))
    store = str(tmp_path / "store")
    assert main(["load", "--csv", files, "--store", store], spark) == 0
    assert main(["build", "--store", store, "--commission", "0.25"], spark) == 0
    files_of_store = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    capsys.readouterr()

    # A session of its own knows no view of the one that built.
    later = spark.newSession()
    statement = """select s.order_status, count(*) as n, max(assumed_commission) as rate
        from stg_orders s join fact_orders using (order_id)
        cross join (select assumed_commission from take_rate limit 1)
        group by s.order_status order by n desc, s.order_status limit 1"""
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        later.sql("select * from stg_orders")
    assert main(["sql", "--store", store, statement], later) == 0
    assert "delivered" in (out := capsys.readouterr().out) and "0.25" in out
    assert main(["show", "--store", store, "payments_per_order"], later) == 0
    opened = Warehouse.opened(later, LoadedTables(TableStore(later, store)), TableStore(later, store))
    assert set(opened.defined()) == set(MODELS) and opened.commission == 0.25
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")} == files_of_store


def test_published_models_answer_sql(spark, warehouse):
    warehouse.publish(["order_status_mix", "fact_orders"])
    shares = spark.sql("select sum(orders) as n from order_status_mix").first()["n"]
    assert shares == spark.sql("select count(*) as n from fact_orders").first()["n"]


def test_replace_overwrites(spark, store):
    store.replace(spark.range(5), "t")
    assert store.replace(spark.range(2), "t").count() == 2
    assert store.read("t").count() == 2


def test_a_failed_write_leaves_the_table(spark, store):
    store.replace(spark.range(5), "t")
    with pytest.raises(Exception, match="broken"):
        store.replace(spark.range(3).selectExpr("raise_error('broken') as id"), "t")
    assert store.read("t").count() == 5
    assert store.replace(store.read("t").where("id < 2"), "t").count() == 2


def fail(*args):
    raise OSError("no rename")


def test_a_failed_switch_leaves_the_old_rows(spark, store, monkeypatch):
    store.replace(spark.range(5), "t")
    with monkeypatch.context() as patched, pytest.raises(OSError, match="no rename"):
        patched.setattr(store_module, "rename", fail)
        store.replace(spark.range(3), "t")
    assert store.read("t").count() == 5
    assert spark.read.parquet(store.path("t")).count() == 5
    assert store.replace(store.read("t").where("id < 2"), "t").count() == 2
    assert store.read("t").count() == spark.read.parquet(store.path("t")).count() == 2


def test_a_failure_after_the_switch_leaves_the_new_rows(spark, store, monkeypatch):
    store.replace(spark.range(5), "t", figures={"rows": F.count(F.lit(1))})

    def only_the_switch(spark_, path, to):
        if not to.endswith("/current"):
            fail()
        rename(spark_, path, to)

    with monkeypatch.context() as patched, pytest.raises(OSError, match="no rename"):
        patched.setattr(store_module, "rename", only_the_switch)
        store.replace(spark.range(3), "t", figures={"rows": F.count(F.lit(1))})
    # Between the steps the table's own folder is gone, and the store still has all rows.
    assert not os.path.exists(store.path("t"))
    assert store.has("t") and store.read("t").count() == 3 and store.figures("t") == {"rows": "3"}
    assert store.replace(store.read("t").where("id < 2"), "t").count() == 2
    assert spark.read.parquet(store.path("t")).count() == 2
    assert os.listdir(f"{store.root}/.versions") == ["_next"]


def test_a_version_can_stay_where_it_was_switched_to(spark, store, monkeypatch):
    """Readers that come before the last step, or after its failure, see one whole table."""
    store.replace(spark.range(5), "t")
    monkeypatch.setattr(TableStore, "_settle", lambda self, table: None)
    written = store.replace(spark.range(7), "t")
    monkeypatch.undo()
    assert written.count() == store.read("t").count() == 7


def test_figures_are_those_of_the_rows(spark, store):
    figures = {"n": F.count(F.lit(1)), "total": F.sum("id").cast("decimal(38,2)"), "none": F.max("null")}
    rows = spark.range(100).withColumn("null", F.lit(None).cast("double"))
    layout = Layout(partition_by=("month",))
    rows = rows.withColumn("month", F.col("id") % 3)
    store.replace(rows, "t", figures=figures, layout=layout)
    assert store.figures("t") == {"n": "100", "total": "4950.00", "none": None}
    assert store.replace(rows, "t").columns == ["id", "null", "month"]
    assert store.figures("t") is None


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if os.path.basename(f).startswith("shuffle_")}


def sums(spark):
    return spark.range(10_000).selectExpr("id % 700 as k", "id as v").groupBy("k").agg(F.sum("v"))


@pytest.mark.parametrize(
    "layout", [Layout(), Layout(partition_by=("part",)), Layout(bucket_by="k", buckets=3)]
)
def test_a_write_leaves_no_shuffle_files(spark, store, layout):
    before = shuffle_files(spark)
    most = spark.range(900).selectExpr("id % 11 as m").distinct().agg(F.max("m")).scalar()
    rows = sums(spark).withColumns({"part": F.col("k") % 3, "most": most})
    figures = {"rows": F.count(F.lit(1))}
    assert len(store.replace(rows, "t", layout=layout, figures=figures).collect()) == 700
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_only_writes_drop_shuffle_files(spark, store):
    before = spark.conf.get(DROPS_SHUFFLES, None)
    with shuffles_dropped(spark):
        ends, ended = threading.Event(), threading.Event()

        def other():
            with shuffles_dropped(spark):
                ends.wait(10)
            ended.set()

        thread = threading.Thread(target=other)
        thread.start()
        store.replace(spark.range(5), "t")
        assert spark.conf.get(DROPS_SHUFFLES) == "true"
        ends.set()
        assert ended.wait(10)
        assert spark.conf.get(DROPS_SHUFFLES) == "true"
    assert spark.conf.get(DROPS_SHUFFLES, None) == before
    with pytest.raises(Exception, match="broken"):
        store.replace(spark.range(3).selectExpr("raise_error('broken') as id"), "t")
    assert spark.conf.get(DROPS_SHUFFLES, None) == before
    # What is read is computed once, however often it is collected.
    rows, files = sums(spark), shuffle_files(spark)
    assert len(rows.collect()) == 700
    assert shuffle_files(spark) - files and len(rows.collect()) == 700


def test_written_folders_come_from_the_session(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get(CHECKPOINT_DIR)
    assert TableStore.scratch(spark, "x").root.startswith(folder)


class Session:
    """Settings of a session that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}.get(key, default)


def test_without_a_shared_folder_the_warehouse_holds_written_tables():
    assert shared_folder(Session) == "hdfs://shared/warehouse/_scratch"


def test_partitions_follow_the_input(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "b").write_bytes(b"x" * 500)
    assert input_bytes(spark, str(tmp_path)) == 1500

    shuffle, scan = (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.files.maxPartitionBytes",
    )
    small = partition_sizes(1500, 8)
    assert (small[shuffle], small[scan]) == ("8", str(128 * MB))
    assert partition_sizes(1024**4, 200)[shuffle] == "8192"
    huge = partition_sizes(100 * 1024**4, 200)
    assert (huge[shuffle], huge[scan]) == (str(100 * 8192), str(128 * MB))


def test_shuffle_partitions_stand_for_little_input():
    shuffle = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    # Rows of 6 GB of Parquet files would not be sorted in memory by 48 tasks.
    assert int(partition_sizes(6 * 1024**3, 200)[shuffle]) == 768
    assert partition_sizes(256 * 1024**3, 200)[shuffle] == "8192"
