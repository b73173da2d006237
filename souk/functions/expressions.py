"""Column expressions shared by the models. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from souk.functions.labels import EARTH_RADIUS_KM

MONEY = "decimal(18,2)"
# Sums of money: a hot group of a very large table goes beyond 16 digits.
MONEY_SUM = "decimal(28,2)"

# Float sums depend on the order in which partitions arrive. Cutting to a few decimals more
# than asked for makes the rounded figure the same in every run.
_SPARE_DIGITS = 6


def rows() -> Column:
    return F.count(F.lit(1))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def money_sum(value: Column) -> Column:
    return value.cast(MONEY_SUM)


def half_up(value: Column, digits: int) -> Column:
    return F.round(value.cast(f"decimal(38,{digits + _SPARE_DIGITS})"), digits).cast("double")


def ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient; NULL for a zero or missing denominator."""
    return half_up(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), digits
    )


def mean(value: Column, digits: int) -> Column:
    """Rounded average of a numeric column. Sums first, so decimals stay exact."""
    return ratio(F.sum(value), F.count(value), digits)


def mean_if(condition: Column, value: Column, digits: int) -> Column:
    return mean(F.when(condition, value), digits)


def strict_greatest(left: Column, right: Column) -> Column:
    """Larger of two values, NULL as soon as one is unknown (`greatest` skips NULLs)."""
    return F.when(left.isNotNull() & right.isNotNull(), F.greatest(left, right))


def whole_hours(start: Column, end: Column) -> Column:
    """Full hours elapsed, truncated towards zero."""
    gap = end - start
    days = F.extract(F.lit("DAY"), gap).cast("long")
    hours = F.extract(F.lit("HOUR"), gap).cast("long")
    return days * 24 + hours


def leg_days(start: Column, end: Column) -> Column:
    return whole_hours(start, end).cast("double") / F.lit(24.0)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def month_offset(later: Column, earlier: Column) -> Column:
    """Calendar month boundaries crossed; Jan 31 to Feb 1 counts as one."""
    years = F.year(later) - F.year(earlier)
    return (years * 12 + F.month(later) - F.month(earlier)).cast("long")


def bucketed(value: Column, buckets: list[tuple[float | None, str]]) -> Column:
    """Label of the first bucket whose upper bound exceeds the value, else the open one."""
    *bounded, (_, last) = buckets
    first_bound, first_label = bounded[0]
    label = F.when(value < first_bound, first_label)
    for bound, name in bounded[1:]:
        label = label.when(value < bound, name)
    return label.otherwise(last)


def distance_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance, to the millimetre; NULL when any coordinate is missing.

    The clamp against rounding above 1 would turn NULL into 1, hence the guard.
    """
    half_lat = F.radians(lat_b - lat_a) / 2
    half_lng = F.radians(lng_b - lng_a) / 2
    chord = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.sin(half_lng) * F.sin(half_lng)
    )
    located = lat_a.isNotNull() & lng_a.isNotNull() & lat_b.isNotNull() & lng_b.isNotNull()
    arc = F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
    return F.when(located, F.round(F.lit(2 * EARTH_RADIUS_KM) * arc, 6))
