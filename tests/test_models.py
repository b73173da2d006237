import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk.operators import facts, item_marts, order_marts
from souk.operators.dimensions import dim_products
from souk.operators.staging import stg_geolocation, stg_orders, stg_products
from small_shop import SmallShop


@pytest.fixture(scope="module")
def shop(spark):
    return SmallShop(spark)


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_order_fact_collapses_before_joining(shop):
    orders = by(facts.fact_orders(shop.base()), "order_id")
    assert len(orders) == 6
    first = orders[1]
    assert (first["item_count"], first["seller_count"]) == (3, 2)
    assert (first["product_revenue"], first["freight"]) == (Decimal("50.00"), Decimal("4.50"))
    assert (first["paid_value"], first["paid_imputed"]) == (Decimal("54.50"), False)
    assert first["max_installments"] == 3
    assert (first["review_score"], first["review_count"]) == (3.5, 2)


def test_unpaid_orders(shop):
    orders = by(facts.fact_orders(shop.base()), "order_id")
    assert (orders[3]["paid_value"], orders[3]["paid_imputed"]) == (Decimal("23.00"), True)
    assert (orders[4]["paid_value"], orders[4]["paid_imputed"]) == (None, False)
    assert orders[4]["item_count"] is None


def test_durations_and_promise(shop):
    orders = by(facts.fact_orders(shop.base()), "order_id")
    first = orders[1]
    assert first["approval_days"] == 2 / 24.0
    assert first["delivery_days"] == 4
    # late by one hour, yet on the promised day
    assert (first["days_vs_promise"], first["is_on_time"]) == (0, False)
    assert orders[3]["approval_days"] is None
    assert (orders[5]["is_on_time"], orders[5]["delivery_days"]) == (None, None)
    assert orders[6]["is_cancelled"] and not orders[6]["is_delivered"]


def test_customer_dimension(shop):
    people = by(shop.people(), "customer_uid")
    # 101 never paid, 102 and 104 have nothing delivered
    assert set(people) == {100, 103}
    person = people[100]
    assert (person["order_count"], person["segment"]) == (2, "recurrent")
    # two purchases on one day: the larger order id decides the place, as a whole
    assert (person["city"], person["state"]) == ("south", "S")
    assert (person["paid_total"], person["avg_paid_ticket"]) == (Decimal("65.50"), 32.75)
    # recency counts from the last delivered purchase of all, paid or not
    assert person["recency_days"] == 39
    assert person["cohort_month"] == dt.date(2020, 1, 1)
    assert people[103]["segment"] == "one_time"


def test_products_without_size_have_no_billable_weight(shop):
    products = by(dim_products(shop.products), "product_id")
    assert products[1]["billable_weight_g"] == 1200 / 6.0
    assert products[1]["weight_bucket"] == "light (<500g)"
    assert products[2]["billable_weight_g"] is None
    assert products[2]["weight_bucket"] == "very heavy (5kg+)"
    assert products[2]["category"] == "Uncategorized"


def test_item_distance_needs_both_centroids(shop):
    lines = {(r["order_id"], r["item_no"]): r["distance_km"] for r in shop.lines().collect()}
    assert lines[1, 1] == 0.0
    assert lines[1, 3] == pytest.approx(1111.949, abs=0.01)
    assert lines[5, 1] is None
    assert len(lines) == 7


def test_distance_mart_uses_the_farthest_item_once_per_order(shop):
    buckets = by(item_marts.distance_vs_delivery(shop.lines()), "distance_bucket")
    assert {b: r["orders"] for b, r in buckets.items()} == {
        "local (<100km)": 1,
        "regional (100-500km)": 1,
        "national (500-1500km)": 1,
    }
    assert buckets["national (500-1500km)"]["avg_freight"] == 4.5
    assert buckets["national (500-1500km)"]["late_rate"] == 1.0


def test_unknown_arrival_stays_in_the_late_rate_denominator(shop):
    sellers = by(
        item_marts.seller_scorecard(
            shop.lines(), shop.sellers.withColumn("lat", F.lit(0.0)).withColumn("lng", F.lit(0.0))
        ),
        "seller_id",
    )
    # seller 2: order 1 late, order 5 unknown, order 6 cancelled
    assert sellers[2]["orders"] == 2 and sellers[2]["late_rate"] == 0.5
    assert (sellers[2]["orders_all_status"], sellers[2]["cancel_rate"]) == (3, 0.3333)
    assert sellers[1]["avg_item_price"] == 12.5
    assert not sellers[1]["is_significant"]


def test_score_counts_once_per_order_and_category(shop):
    categories = by(item_marts.score_by_category(shop.lines()), "category")
    # order 1 has two lines of one category and one of another
    assert categories["things"]["reviewed_orders"] == 2
    assert categories["things"]["avg_score"] == 3.75
    assert categories["Uncategorized"]["reviewed_orders"] == 1


def test_payment_methods(shop):
    methods = by(order_marts.payment_method_mix(shop.payments, shop.base()), "payment_type")
    assert {m: r["orders"] for m, r in methods.items()} == {
        "credit_card": 2,
        "voucher": 1,
        "boleto": 1,
    }
    # three paid delivered orders; shares add up to more than one
    assert sum(r["order_share"] for r in methods.values()) == pytest.approx(1.3333, abs=1e-3)
    assert methods["credit_card"]["avg_installments"] == 2.0
    assert methods["voucher"]["avg_installments"] is None
    assert methods["credit_card"]["payments_in_installments"] == 1


def test_cohorts_may_have_negative_offsets(spark, shop):
    # an unpaid January order of a customer whose first paid one is in February
    shop_orders = shop.base().where("order_id in (3, 5)").withColumn(
        "customer_uid", F.lit(103).cast("long")
    )
    early = shop_orders.withColumn(
        "purchase_month",
        F.when(F.col("order_id") == 3, F.lit(dt.date(2020, 1, 1))).otherwise(F.col("purchase_month")),
    )
    cells = by(facts.cohort_retention(early, shop.people()), "months_since_first")
    assert set(cells) == {-1, 0}
    assert cells[-1]["period_revenue"] == Decimal("23.00")
    assert cells[0]["cohort_customers"] == 1 and cells[0]["observable_months"] == 0


def test_months_compare_on_the_calendar(spark):
    def month(first, orders, revenue):
        return [
            (dt.date.fromisoformat(first), n, Decimal(revenue) / orders, Decimal(1), Decimal(2), True)
            for n in range(orders)
        ]

    rows = (
        month("2020-01-01", 4, "100")
        + month("2020-02-01", 4, "150")
        + month("2020-04-01", 4, "300")
        + month("2021-01-01", 2, "400")
        + month("2021-02-01", 4, "600")
    )
    fact = spark.createDataFrame(
        rows,
        """purchase_month date, customer_uid long, product_revenue decimal(18,2),
        freight decimal(18,2), paid_value decimal(18,2), is_delivered boolean""",
    )
    months = by(order_marts.monthly_sales(fact, threshold=3), "month")
    assert months[dt.date(2020, 2, 1)]["revenue_mom"] == 0.5
    assert months[dt.date(2020, 2, 1)]["orders_mom"] == 0.0
    # March has no row: April has nothing to compare with
    assert months[dt.date(2020, 4, 1)]["revenue_mom"] is None
    assert months[dt.date(2021, 2, 1)]["revenue_yoy"] == 3.0
    # too few orders in January 2021
    assert months[dt.date(2021, 1, 1)]["revenue_yoy"] is None
    assert months[dt.date(2021, 2, 1)]["revenue_mom"] is None
    assert [m.isoformat() for m, r in sorted(months.items()) if r["is_edge_month"]] == [
        "2020-01-01",
        "2021-02-01",
    ]


def test_take_rate_parameters(shop):
    january = by(order_marts.take_rate(shop.base(), 0.18, 0.02), "month")[dt.date(2020, 1, 1)]
    # revenue 60.00, paid 65.50
    assert january["commission_income"] == Decimal("10.80")
    assert january["processing_cost"] == Decimal("1.31")
    assert january["platform_margin"] == Decimal("9.49")
    assert january["effective_rate"] == 0.1449
    assert (january["assumed_commission"], january["assumed_fee"]) == (0.18, 0.02)


def test_summary_of_nothing_is_one_row(shop):
    empty = order_marts.executive_summary(shop.base().where("false"), shop.people().where("false"))
    rows = empty.collect()
    assert len(rows) == 1 and rows[0]["delivered_orders"] == 0 and rows[0]["on_time_rate"] is None


def test_staging_casts_text(spark):
    raw = spark.createDataFrame(
        [("a", "c", "delivered", "2018-01-02 03:04:05", None, None, None, "2018-02-01 00:00:00")],
        """order_id string, customer_id string, order_status string,
        order_purchase_timestamp string, order_approved_at string,
        order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    )
    row = stg_orders(raw).first()
    assert row["purchased_at"] == dt.datetime(2018, 1, 2, 3, 4, 5) and row["approved_at"] is None


def test_staging_rounds_fractions_and_keeps_untranslated(spark):
    raw = spark.createDataFrame(
        [("p", "cat", "225.0", "2.5", None, "3")],
        """product_id string, product_category_name string, product_weight_g string,
        product_length_cm string, product_height_cm string, product_width_cm string""",
    )
    words = spark.createDataFrame(
        [("other", "x")], "product_category_name string, product_category_name_english string"
    )
    row = stg_products(raw, words).first()
    assert (row["weight_g"], row["length_cm"], row["height_cm"]) == (225, 3, None)
    assert row["category_en"] is None and row["category_src"] == "cat"


def test_centroid_drops_leading_zeros_and_averages(spark):
    raw = spark.createDataFrame(
        [("01037", "-23.545621281151", "-46.639292048"), ("1037", "-23.5", "-46.6")],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string",
    )
    rows = stg_geolocation(raw).collect()
    assert len(rows) == 1 and rows[0]["zip_prefix"] == 1037
    assert rows[0]["lat"] == pytest.approx((-23.545621281151 - 23.5) / 2, abs=1e-14)
