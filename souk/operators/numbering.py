"""Row numbers and running totals that survive a hot group.

A window sorts each group in one task, which is wrong for a group that holds a third of all
rows. The functions here keep the exact numbering and never put a group into a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.expressions import rows as row_count
from souk.sources.store import TableStore

# Rows of a group that one task may sort
HOT_GROUP = 1024

# monotonically_increasing_id() keeps the partition number above these bits.
_POSITION_BITS = 33


def number_within(
    df: DataFrame, group: str, order: list[str], alias: str, scratch: TableStore, table: str
) -> DataFrame:
    """`row_number()` per group in the given order, as a long column `alias`.

    Groups of up to `HOT_GROUP` rows are numbered by a window, in one shuffle by group; the few
    others, which are counted before, are numbered across tasks.
    """
    held = df.groupBy(F.col(group).alias("_group")).agg(row_count().alias("_rows"))
    hot = scratch.replace(held.where(F.col("_rows") > HOT_GROUP).select("_group"), f"{table}_hot")
    same = F.col(group).eqNullSafe(F.col("_group"))
    number = F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")
    numbered = df.join(hot, same, "left_anti").select(*df.columns, number.alias(alias))
    if hot.isEmpty():
        return numbered
    spread = _number_hot(df.join(hot, same, "left_semi"), group, order, alias, scratch, table)
    return numbered.unionAll(spread)


def _number_hot(
    df: DataFrame, group: str, order: list[str], alias: str, scratch: TableStore, table: str
) -> DataFrame:
    """The same for groups that no task should hold.

    Rows are range-partitioned by group and order, so tasks share a large group and a task has
    many small ones; each row's number is its position in its partition plus the rows of the
    group in earlier partitions. The sorted rows are written once, because positions must not
    change between the two passes.
    """
    ranged = (
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    ranged = scratch.replace(ranged, table).withColumns(
        {
            "_part": F.shiftrightunsigned("_id", _POSITION_BITS),
            "_position": F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A group has a row for each partition that it is in.
    offsets = (
        ranged.groupBy(group, "_part")
        .agg(row_count().alias("_rows"), F.min("_position").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first"))
        .select(F.col(group).alias("_group"), F.col("_part").alias("_in"), "_offset")
    )
    same = (F.col("_part") == F.col("_in")) & F.col(group).eqNullSafe(F.col("_group"))
    number = (F.col("_position") + F.col("_offset")).alias(alias)
    return ranged.join(offsets, same).select(*df.columns, number)


def running_count(
    df: DataFrame, partition: str, value: str, weight: str, alias: str, total_alias: str
) -> DataFrame:
    """Weight held by strictly larger values of the same partition, and the partition total.

    One row per (partition, value) is expected, so equal values are already one row. Values
    fall into fixed logarithmic bands; the few band totals give every band its start, and
    the window then runs inside one band only.
    """
    banded = df.withColumn("_band", _log_band(F.col(value)))
    above = Window.partitionBy(partition).orderBy(F.desc("_band")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most a few thousand bands per partition, by the range of a double.
    bands = (
        banded.groupBy(partition, "_band")
        .agg(F.sum(weight).alias("_held"))
        .withColumns(
            {
                "_start": F.coalesce(F.sum("_held").over(above), F.lit(0)),
                total_alias: F.sum("_held").over(Window.partitionBy(partition)),
            }
        )
        .drop("_held")
    )
    inside = (
        Window.partitionBy(partition, "_band")
        .orderBy(F.desc_nulls_last(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        banded.join(bands, [partition, "_band"])
        .withColumn(alias, F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_band", "_start")
    )


_BANDS_PER_OCTAVE = 128


def _log_band(value: Column) -> Column:
    """Whole number that never falls when the value rises; bands by magnitude on both sides."""
    octave = F.log2(F.abs(value.cast("double")))
    band = F.floor(octave * _BANDS_PER_OCTAVE)
    # Offsets beyond any logarithm of a double keep negative values, zero and others apart.
    return (
        F.when(value > 0, band)
        .when(value < 0, F.lit(-(2**20)).cast("long") - band)
        .otherwise(F.lit(-(2**19)).cast("long"))
    )
