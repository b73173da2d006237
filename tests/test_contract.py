"""Registered queries against DuckDB, and against counts known from elsewhere."""

from decimal import Decimal

import pytest

import __spark_entry__ as contract
from check_against_duckdb import difference, duck
from conftest import SMALL
from souk.operators.order_marts import delivered
from souk.plans.consumer import QUESTIONS
from souk.plans.warehouse import MODELS


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


# Queries of the optional subpackage are tested beside it.
OWN = [name for name in contract.queries() if not name.startswith("op") and name != "pipeline"]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, con, name):
    df = contract.queries()[name](spark, SMALL)
    assert difference(df, con, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.oracle_sql())
    assert len(MODELS) - 1 + len(QUESTIONS) <= len(contract.queries())


def test_entry_is_one_row(spark):
    assert contract.entry(spark).count() == 1


# Counts of the mapping over whole tables
def test_known_counts(warehouse):
    w = warehouse
    assert [w[n].count() for n in ["stg_orders", "stg_order_items", "stg_payments", "stg_reviews"]] == [
        1500,
        6000,
        1534,
        1201,
    ]
    orders = w["fact_orders"]
    sold = delivered(orders)
    assert sold.count() == 991
    assert orders.where("paid_imputed").count() == 4
    assert orders.where("item_count is null").count() == 27
    assert orders.where("review_score is null").count() == 417
    assert orders.where("review_count > 1").count() == 96
    assert sold.where("delivered_at is null").count() == 7


def test_known_distances(warehouse):
    """Unlocated items keep an unknown distance; they do not fall into the longest bucket."""
    items = delivered(warehouse["fact_order_items"])
    counts = items.selectExpr(
        "count_if(distance_km < 100)",
        "count_if(distance_km >= 100 and distance_km < 500)",
        "count_if(distance_km >= 500 and distance_km < 1500)",
        "count_if(distance_km >= 1500)",
        "count_if(distance_km is null)",
    ).first()
    assert tuple(counts) == (46, 273, 994, 304, 2450)


def test_known_summary(warehouse):
    s = warehouse["executive_summary"].first()
    assert s["product_revenue"] == Decimal("216659336.01")
    assert (s["freight_total"], s["gmv"]) == (Decimal("128535.00"), Decimal("248380458.59"))
    assert (s["on_time_rate"], s["on_time_rate_global"], s["delivery_p90"]) == (0.6392, 0.5118, 31)
    assert (s["promise_cushion_days"], s["avg_score"]) == (3.8, 2.95)
    assert (s["cancel_rate"], s["recurrent_rate"]) == (0.1007, 0.9933)


def test_totals_agree_at_both_grains(warehouse):
    orders = delivered(warehouse["fact_orders"]).selectExpr("sum(product_revenue)").first()[0]
    items = delivered(warehouse["fact_order_items"]).selectExpr("sum(product_revenue)").first()[0]
    assert orders == items
