import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from souk.operators.item_marts import revenue_concentration
from souk.operators.numbering import number_within, running_count


@pytest.fixture(scope="module")
def lines(spark):
    """A third of the rows share group 7; many rows are equal in the first order column."""
    return (
        spark.range(9000)
        .selectExpr(
            "if(id % 3 = 0, 7, 1000 + id % 500) as grp",
            "id * 7919 % 5 as first",
            "id * 104729 % 9001 as second",
            "id as payload",
        )
        .repartition(5)
    )


def test_numbering_a_hot_group_equals_the_window(lines, store):
    order = ["first", "second"]
    window = Window.partitionBy("grp").orderBy(*order)
    expected = lines.withColumn("n", F.row_number().over(window).cast("long"))
    numbered = number_within(lines, "grp", order, "n", store, "hot_lines")
    assert numbered.columns == expected.columns
    assert numbered.exceptAll(expected).isEmpty() and expected.exceptAll(numbered).isEmpty()


def test_hot_rows_do_not_share_one_task(spark, lines, store):
    # Small partitions would be merged.
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    number_within(lines, "grp", ["first", "second"], "n", store, "spread")
    spark.conf.set(merging, "true")
    hot = store.read("spread").where("grp = 7")
    parts = hot.selectExpr("shiftrightunsigned(_id, 33) as part").distinct()
    assert parts.count() > 1


def test_null_groups_are_numbered_too(spark, store):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 1)], "grp long, first long")
    rows = number_within(df, "grp", ["first"], "n", store, "nulls").collect()
    assert sorted((r["grp"] or 0, r["first"], r["n"]) for r in rows) == [
        (0, 1, 1),
        (0, 2, 2),
        (1, 1, 1),
    ]


def test_running_count_against_brute_force(spark):
    rng = random.Random(5)
    values = {Decimal(rng.randint(-300, 10**rng.randint(1, 12))) / 100 for _ in range(400)}
    rows = [("a", v, rng.randint(1, 5)) for v in values] + [("b", Decimal("1.00"), 3)]
    df = spark.createDataFrame(rows, "p string, v decimal(28,2), w long")
    got = running_count(df, "p", "v", "w", "above", "total").collect()
    assert len(got) == len(rows)
    for r in got:
        above = sum(w for p, v, w in rows if p == r["p"] and v > r["v"])
        assert r["above"] == above
        assert r["total"] == sum(w for p, _, w in rows if p == r["p"])


def tiers(revenues):
    """Tier totals by plain ranking."""
    import math

    ranked, n = sorted(revenues, reverse=True), len(revenues)
    result = {}
    for position, revenue in enumerate(ranked, 1):
        if position <= 10:
            tier = "Top 10"
        elif position <= math.ceil(n * 0.01):
            tier = "Top 1%"
        elif position <= math.ceil(n * 0.10):
            tier = "Top 10%"
        else:
            tier = "Rest"
        count, total = result.get(tier, (0, Decimal(0)))
        result[tier] = (count + 1, total + revenue)
    return result


@pytest.mark.parametrize("sellers", [5, 10, 11, 100, 150, 1500])
@pytest.mark.parametrize("distinct", [1, 3, 10_000])
def test_concentration_with_ties_against_plain_ranking(spark, sellers, distinct):
    rng = random.Random(sellers * distinct)
    revenue = {s: Decimal(rng.randint(1, distinct)) for s in range(sellers)}
    rows = [(s, f"c{s % 4}", r, True) for s, r in revenue.items()]
    # undelivered items do not count
    rows.append((0, "c0", Decimal(10**6), False))
    items = spark.createDataFrame(
        rows,
        "seller_id long, category string, product_revenue decimal(18,2), is_delivered boolean",
    )
    got = {
        r["tier"]: (r["entities_in_tier"], r["revenue"])
        for r in revenue_concentration(items).where("dimension = 'sellers'").collect()
    }
    assert got == tiers(revenue.values())


def test_groups_of_few_rows_are_numbered_in_one_shuffle(spark, store):
    df = spark.range(600).selectExpr("id % 200 as grp", "id * 7 % 600 as first")
    numbered = number_within(df, "grp", ["first"], "n", store, "few")
    window = Window.partitionBy("grp").orderBy("first")
    expected = df.withColumn("n", F.row_number().over(window).cast("long"))
    assert numbered.exceptAll(expected).isEmpty() and expected.exceptAll(numbered).isEmpty()
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and not store.has("few")


def test_items_of_hot_orders_add_up_like_others(spark, store):
    from souk.operators import facts

    items = spark.range(4000).selectExpr(
        "if(id % 2 = 0, null, if(id % 4 = 1, 7, id % 300)) as order_id",
        "id % 11 as seller_id",
        "cast(id % 13 as decimal(18,2)) as price",
        "cast(1 as decimal(18,2)) as freight",
    )
    hot = store.replace(facts.hot_orders(items), "hot")
    assert {r.hot_order for r in hot.collect()} == {None}
    split, whole = facts.items_per_order(items, hot), facts.items_per_order(items)
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()
    plan = facts.items_per_order(items, hot)._jdf.queryExecution().executedPlan().toString()
    # The lines of other orders, then those of hot ones by seller and by order
    assert plan.count("hashpartitioning") == 3
