import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from souk.functions import labels
from souk.functions.expressions import (
    bucketed,
    distance_km,
    half_up,
    leg_days,
    month_offset,
    ratio,
    strict_greatest,
    whole_hours,
)


def value(spark, column, row="1 as one"):
    return spark.sql(f"select {row}").select(column.alias("v")).first()["v"]


def test_strict_greatest_is_null_when_a_side_is(spark):
    pick = strict_greatest(F.col("a"), F.col("b"))
    assert value(spark, pick, "1.0 as a, cast(null as double) as b") is None
    assert value(spark, pick, "cast(null as double) as a, 1.0 as b") is None
    assert value(spark, pick, "1D as a, 2D as b") == 2.0


def test_distance_of_an_unlocated_place_is_null(spark):
    km = distance_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    for missing in "abcd":
        row = ", ".join(f"{'cast(null as double)' if n == missing else '1D'} as {n}" for n in "abcd")
        assert value(spark, km, row) is None


def test_distance_of_known_places(spark):
    km = distance_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    assert value(spark, km, "0D as a, 0D as b, 0D as c, 0D as d") == 0.0
    quarter = math.pi / 2 * labels.EARTH_RADIUS_KM
    assert value(spark, km, "0D as a, 0D as b, 90D as c, 0D as d") == pytest.approx(quarter, abs=1e-5)
    assert value(spark, km, "0D as a, 0D as b, 0D as c, 180D as d") == pytest.approx(2 * quarter, abs=1e-5)


@pytest.mark.parametrize(
    "start, end, hours",
    [
        ("2020-01-01 00:00:00", "2020-01-01 01:59:00", 1),
        ("2020-01-01 01:59:00", "2020-01-01 00:00:00", -1),
        ("2020-01-01 00:30:00", "2020-01-01 01:00:00", 0),
        ("2020-01-01 00:00:00", "2020-01-03 05:00:00", 53),
    ],
)
def test_hours_are_whole_and_truncate_towards_zero(spark, start, end, hours):
    row = f"timestamp_ntz'{start}' as a, timestamp_ntz'{end}' as b"
    assert value(spark, whole_hours(F.col("a"), F.col("b")), row) == hours
    assert value(spark, leg_days(F.col("a"), F.col("b")), row) == hours / 24.0


def test_month_offset_counts_calendar_months(spark):
    offset = month_offset(F.col("a"), F.col("b"))
    assert value(spark, offset, "date'2021-02-01' as a, date'2021-01-31' as b") == 1
    assert value(spark, offset, "date'2020-12-01' as a, date'2021-01-31' as b") == -1
    assert value(spark, offset, "date'2022-03-01' as a, date'2021-03-31' as b") == 12


def test_ratio_of_zero_denominator_is_null(spark):
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, ratio(F.lit(1), F.lit(3))) == 0.3333


def test_rounding_is_half_away_from_zero(spark):
    assert value(spark, half_up(F.lit(1.005), 2)) == 1.01
    assert value(spark, half_up(F.lit(-1.005), 2)) == -1.01
    # an exact tie that float summation missed by its last bit
    assert value(spark, half_up(F.lit(2.7849999999999997), 2)) == 2.79


@pytest.mark.parametrize(
    "buckets, cases",
    [
        (labels.WEIGHT_BUCKETS, {499.99: 0, 500: 1, 1999.9: 1, 2000: 2, 5000: 3, None: 3}),
        (labels.DISTANCE_BUCKETS, {0: 0, 99.99: 0, 100: 1, 500: 2, 1500: 3}),
        (labels.PUNCTUALITY_BUCKETS, {-1: 0, 0: 1, 1: 2, 3: 2, 4: 3}),
    ],
)
def test_bucket_bounds(spark, buckets, cases):
    for number, index in cases.items():
        literal = F.lit(number).cast("double")
        assert value(spark, bucketed(literal, buckets)) == buckets[index][1]


def test_calendar_names(spark):
    from souk.operators.dimensions import dim_date

    orders = spark.createDataFrame(
        [(dt.datetime(2020, 2, 28, 23, 59),), (dt.datetime(2020, 3, 1, 0, 0),)], "purchased_at timestamp_ntz"
    )
    days = dim_date(orders).orderBy("date").collect()
    assert [d["date"].isoformat() for d in days] == ["2020-02-28", "2020-02-29", "2020-03-01"]
    assert [(d["day_of_week"], d["day_name"], d["is_weekend"]) for d in days] == [
        (6, "Friday", False),
        (7, "Saturday", True),
        (1, "Sunday", True),
    ]
    assert days[1]["year_month"] == "2020-02" and days[1]["quarter"] == 1
