from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.operators import quality
from souk.plans import quality_suite
from souk.plans.quality_suite import DECLARED, RATES


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 0.5), (1, "b", 1.2), (2, None, None), (None, "c", -0.1), (None, "c", 0.0)],
        "k long, v string, rate double",
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_unique_ignores_nulls(df):
    assert rows(quality.unique(df, "k")) == [("k", "1", 2)]
    assert rows(quality.unique(df.where("v <> 'c'"), "v")) == []


def test_combination_counts_nulls_as_equal(df):
    assert rows(quality.unique_combination(df, ["k", "v"])) == [(None, "c", 2)]
    assert rows(quality.unique_combination(df, ["k", "v", "rate"])) == []


def test_not_null_lists_failing_columns(df):
    assert rows(quality.not_null(df, ["k", "v", "rate"])) == [
        ("k", None, 2),
        ("rate", None, 1),
        ("v", None, 1),
    ]
    assert rows(quality.not_null(df.where("k is not null"), ["k"])) == []


def test_accepted_values(df):
    assert rows(quality.accepted_values(df, "v", ["a", "b"])) == [("v", "c", 2)]
    assert rows(quality.accepted_values(df, "k", [1, 2])) == []


def test_relationships_keep_null_keys_out(df, spark):
    parents = spark.createDataFrame([(2,), (2,)], "id long")
    assert rows(quality.relationships(df, "k", parents, "id")) == [(1, 2)]
    assert rows(quality.relationships(df.where("k = 2"), "k", parents, "id")) == []


def test_one_row(df):
    assert rows(quality.not_one_row(df.limit(1))) == []
    assert rows(quality.not_one_row(df)) == [(5,)]
    assert rows(quality.not_one_row(df.where("false"))) == [(0,)]


def test_rates(df):
    assert rows(quality.rates_out_of_range([("t", df, ["rate"])])) == [
        ("t.rate", -0.1),
        ("t.rate", 1.2),
    ]


def test_reconciliation_fails_on_difference_and_on_nothing(spark):
    truth = spark.sql("select cast(10.00 as decimal(18,2)) as revenue")
    mart = spark.createDataFrame([(Decimal("4.00"),), (Decimal("6.00"),)], "r decimal(18,2)")
    total = F.sum("r")

    def failing(df):
        return rows(quality.unreconciled(truth, [("m", df, total, "revenue")]))

    assert failing(mart) == []
    # one cent is within the tolerance, two are not
    assert failing(mart.withColumn("r", F.col("r") + Decimal("0.005"))) == []
    assert failing(mart.withColumn("r", F.col("r") + 1)) == [
        ("m", Decimal("12.00"), Decimal("10.00"), Decimal("2.00"))
    ]
    assert failing(mart.where("false")) == [("m", None, Decimal("10.00"), None)]


def test_every_check_is_declared():
    checks = DECLARED.values()
    assert len(DECLARED) == 31
    assert sum(len(c.unique) for c in checks) == 22
    assert sum(len(c.not_null) for c in checks) == 135
    assert sum(len(c.accepted) for c in checks) == 12
    assert sum(len(c.relationships) for c in checks) == 6
    assert sum(len(c.combinations) for c in checks) == 7
    assert sum(len(columns) for _, columns in RATES) == 12


def test_suite_finds_the_orphans_and_nothing_else(warehouse):
    report = quality_suite.suite_report(warehouse).collect()
    assert len(report) == 185
    failing = {(r["check"], r["model"]): r["failures"] for r in report if r["failures"]}
    assert failing == {
        ("relationships", "stg_payments"): 2,
        ("relationships", "stg_reviews"): 22,
        ("relationships", "payments_per_order"): 1,
    }


def test_values_and_names_of_any_characters(spark):
    df = spark.createDataFrame([(0.5, "d'Or"), (0.7, "x"), (None, None)], ["a rate", "the`name"])
    assert [r["value"] for r in quality.accepted_values(df, "a rate", [0.5]).collect()] == ["0.7"]
    assert [r["value"] for r in quality.accepted_values(df, "the`name", ["d'Or"]).collect()] == ["x"]
    rows = quality.not_null(df, ["a rate", "the`name"]).collect()
    assert [(r["column"], r["failures"]) for r in rows] == [("a rate", 1), ("the`name", 1)]


def test_all_failures_of_several_tables(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (None, "x")], "k long, v string")
    child = spark.createDataFrame(
        [(1, "a", "b"), (3, "a", "b"), (3, None, "b"), (None, None, "b"), (2, "a:1", "")],
        "k int, p string, q string",
    )
    tables = {
        "parent": quality.TableChecks(
            parent, {("not_null", "k"): F.col("k").isNull(), ("not_null", "v"): F.col("v").isNull()}, ["k", "v"]
        ),
        "child": quality.TableChecks(
            child, {("accepted_values", "p"): quality.outside("p", ["a"])}, ["q"], [["p", "q"], ["k"]],
            {"k": ("parent", "k")},
        ),
        "again": quality.TableChecks(child.where("k is not null"), references={"k": ("parent", "k")}),
        "empty": quality.TableChecks(child.limit(0), {("not_null", "k"): F.col("k").isNull()}, ["k"], [["p"]]),
    }
    got = {(r.check, r.model, r["columns"]): r.failures for r in quality.all_failures(tables).collect()}
    assert got == {
        ("not_null", "parent", "k"): 1,
        ("not_null", "parent", "v"): 0,
        ("unique", "parent", "k"): 1,
        ("unique", "parent", "v"): 1,
        ("accepted_values", "child", "p"): 1,
        ("unique", "child", "q"): 1,
        ("unique_combination", "child", "p, q"): 2,
        ("unique_combination", "child", "k"): 1,
        ("relationships", "child", "k"): 2,
        ("relationships", "again", "k"): 2,
        ("not_null", "empty", "k"): 0,
        ("unique", "empty", "k"): 0,
        ("unique_combination", "empty", "p"): 0,
    }


@pytest.mark.parametrize("pair", [(["a", None], [None, "a"]), (["1:a", "b"], ["1", "a1:b"]), (["-", None], [None, "-"])])
def test_different_keys_have_different_texts(spark, pair):
    df = spark.createDataFrame(list(map(tuple, pair)), "x string, y string")
    assert df.select(quality.exact_text(["x", "y"])).distinct().count() == 2


def test_rates_and_totals_come_from_observed_figures(warehouse):
    report = {r.metric: r for r in quality_suite.rates_report(warehouse).collect()}
    read = quality.rates([(name, warehouse.table(name), columns) for name, columns in RATES])
    expected = read.groupBy("metric").agg(
        F.count(F.lit(1)).alias("figures"), F.count("value").alias("known"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"),
    )
    assert report == {r.metric: r for r in expected.collect()}
    scans = quality_suite.rates_in_range(warehouse)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in scans


def test_a_rate_out_of_range_is_shown(spark, warehouse, tmp_path):
    from souk.plans.warehouse import Warehouse
    from souk.sources.store import TableStore

    w = Warehouse(spark, warehouse.raw, TableStore(spark, str(tmp_path)), built=True)
    for name, columns in RATES:
        table = warehouse.table(name)
        if name == "order_status_mix":
            table = table.withColumn("share", F.col("share") + 1)
        # Without figures, as an older build would have left them
        w.store.replace(table, name)
    failing = quality_suite.rates_in_range(w).collect()
    assert {r.metric for r in failing} == {"order_status_mix.share"}
    assert len(failing) == warehouse.table("order_status_mix").where("share > 0").count()
