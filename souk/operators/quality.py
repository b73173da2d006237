"""Data-quality operators. Each returns the failing rows: empty means passed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.expressions import rows
from souk.functions.labels import RECONCILIATION_TOLERANCE


def unique(df: DataFrame, name: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return (
        df.where(column(name).isNotNull())
        .groupBy(column(name).alias("value"))
        .agg(rows().alias("failures"))
        .where("failures > 1")
        .select(F.lit(name).alias("column"), F.col("value").cast("string"), "failures")
    )


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once; NULLs count as equal."""
    return (
        df.groupBy(*[column(c) for c in columns]).agg(rows().alias("failures")).where("failures > 1")
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold NULLs, with their number. All columns share one pass."""
    tests = {("not_null", c): column(c).isNull() for c in columns}
    failing = failure_counts(df, tests).where("failures > 0")
    return failing.select("column", F.lit(None).cast("string").alias("value"), "failures")


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def failure_counts(df: DataFrame, failing: dict[tuple[str, str], Column]) -> DataFrame:
    """(check, column, failures) for each condition, zeros included, in one pass."""
    counts = [F.count_if(test).alias(f"c{i}") for i, test in enumerate(failing.values())]
    cells = [
        F.struct(
            F.lit(check).alias("check"), F.lit(name).alias("column"), F.col(f"c{i}").alias("failures")
        )
        for i, (check, name) in enumerate(failing)
    ]
    return df.agg(*counts).select(F.inline(F.array(*cells)))


def outside(name: str, values: Sequence) -> Column:
    """Whether a non-NULL value is not in the list."""
    return column(name).isNotNull() & ~column(name).isin(list(values))


def accepted_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Non-NULL values outside the list."""
    return (
        df.where(outside(name, values))
        .groupBy(column(name).alias("value"))
        .agg(rows().alias("failures"))
        .select(F.lit(name).alias("column"), F.col("value").cast("string"), "failures")
    )


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL child keys without a parent row.

    Child rows are counted per key before the join, so a key that many rows share costs no
    more than any other.
    """
    keys = (
        child.where(column(key).isNotNull())
        .groupBy(column(key).alias("value"))
        .agg(rows().alias("failures"))
    )
    parents = parent.select(column(parent_key).alias("parent_value"))
    return keys.join(parents, F.col("value") == F.col("parent_value"), "left_anti")


def not_one_row(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("rows")).where("rows <> 1")


def rates(metrics: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """(metric, value) for each rate column of each (name, table, columns)."""

    def tall(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        cells = [
            F.struct(
                F.lit(f"{name}.{c}").alias("metric"), column(c).cast("double").alias("value")
            )
            for c in columns
        ]
        return df.select(F.inline(F.array(*cells)))

    return union_all([tall(*metric) for metric in metrics])


def rates_out_of_range(metrics: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Known rates below 0 or above 1."""
    return rates(metrics).where("value < 0 or value > 1")


def comparisons(
    truth: DataFrame, totals: Sequence[tuple[str, DataFrame, Column, str]]
) -> DataFrame:
    """(mart, value, expected, difference) for each (name, mart, total, column of `truth`).

    `truth` is a single row; each total is a single value.
    """
    expected = {c: truth.select(F.col(c).cast("decimal(38,2)")).scalar() for c in truth.columns}

    def compare(name: str, df: DataFrame, value: Column, column: str) -> DataFrame:
        return df.agg(value.cast("decimal(38,2)").alias("value")).select(
            F.lit(name).alias("mart"), "value", expected[column].alias("expected")
        )

    return union_all([compare(*t) for t in totals]).withColumn(
        "difference", (F.col("value") - F.col("expected")).cast("decimal(38,2)")
    )


def unreconciled(
    truth: DataFrame,
    totals: Sequence[tuple[str, DataFrame, Column, str]],
    tolerance: float = RECONCILIATION_TOLERANCE,
) -> DataFrame:
    """Comparisons that differ by more than the tolerance, or have a side missing."""
    return beyond_tolerance(comparisons(truth, totals), tolerance)


def beyond_tolerance(
    compared: DataFrame, tolerance: float = RECONCILIATION_TOLERANCE
) -> DataFrame:
    difference = F.abs("difference")
    return compared.where(
        (difference > F.lit(str(tolerance)).cast("decimal(18,6)")) | difference.isNull()
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns. Pairing them up keeps the plan shallow."""
    while len(frames) > 1:
        pairs = zip(frames[::2], frames[1::2])
        odd = [frames[-1]] if len(frames) % 2 else []
        frames = [a.union(b) for a, b in pairs] + odd
    return frames[0]


@dataclass
class TableChecks:
    """What is checked of one table, in one pass over it."""

    rows: DataFrame
    # (check, columns) -> condition that a failing row meets
    failing: dict[tuple[str, str], Column] = field(default_factory=dict)
    unique: Sequence[str] = ()
    combinations: Sequence[Sequence[str]] = ()
    # column -> (table, column) that its values have to be in
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


def exact_text(columns: Sequence[str]) -> Column:
    """The values of the columns as one text, different for different values; NULLs are equal."""
    values = [column(c).cast("string") for c in columns]
    sized = [F.concat(F.octet_length(v).cast("string"), F.lit(":"), v) for v in values]
    return F.concat(*[F.coalesce(v, F.lit("-")) for v in sized])


@dataclass
class _Cells:
    """The tagged keys that a row of a table gives."""

    # (condition, cell): keys are there in nearly all rows, faults in few
    keys: list[tuple[Column, Column]] = field(default_factory=list)
    faults: list[tuple[Column, Column]] = field(default_factory=list)

    def rows(self, df: DataFrame) -> DataFrame:
        """One row for each cell whose condition holds."""
        every = [*self.keys, *self.faults]
        chosen = F.array_compact(F.array(*[F.when(when, cell) for when, cell in every]))
        # Nearly all rows take the branch without a test of every cell.
        odd = [F.coalesce(when, F.lit(False)) for when, _ in self.faults]
        odd += [~when for when, _ in self.keys]
        plain = F.array(*[cell for _, cell in self.keys])
        if self.keys:
            chosen = F.when(reduce(or_, odd), chosen).otherwise(plain)
        else:
            chosen = F.when(reduce(or_, odd), chosen)
        return df.select(F.inline(chosen))


def all_failures(tables: dict[str, TableChecks]) -> DataFrame:
    """(check, table, columns, failures) of every check on all tables, zeros included.

    Each table is scanned once. A row gives a tagged key for each of its keys, and one for each
    condition it fails; all keys of all tables meet in one shuffle, reduced before it. Keys have
    one tag for a column and for the references to it: slot 0 counts its own rows, a slot further
    on the rows of one reference. Keys that repeat in slot 0 fail a uniqueness check, rows of a
    reference fail where slot 0 is empty. A key that many rows share is one row by then.
    """
    tags: dict[tuple, int] = {}
    slots: dict[int, int] = {}
    declared: list[tuple[str, str, str, int, int]] = []
    cells = {name: _Cells() for name in tables}

    def tag(key: tuple) -> int:
        return tags.setdefault(key, len(tags))

    def cell(group: int, slot: int, key: Column) -> Column:
        return F.struct(F.lit(group).alias("tag"), F.lit(slot).alias("slot"), key.alias("key"))

    none = F.lit(None).cast("string")
    for name, checks in tables.items():
        for (check, columns), condition in checks.failing.items():
            group = tag((check, name, columns))
            declared.append((check, name, columns, group, 0))
            cells[name].faults.append((condition, cell(group, 0, none)))
        for c in checks.combinations:
            group = tag(("unique_combination", name, *c))
            declared.append(("unique_combination", name, ", ".join(c), group, 0))
            cells[name].keys.append((F.lit(True), cell(group, 0, exact_text(c))))
    parents = {target for checks in tables.values() for target in checks.references.values()}
    for name, checks in tables.items():
        declared += [("unique", name, c, tag((name, c)), 0) for c in checks.unique]
        for c in dict.fromkeys([*checks.unique, *(c for t, c in sorted(parents) if t == name)]):
            value = column(c).cast("string")
            cells[name].keys.append((value.isNotNull(), cell(tag((name, c)), 0, value)))
        for c, target in checks.references.items():
            group = tag(target)
            slots[group] = slots.get(group, 0) + 1
            declared.append(("relationships", name, c, group, slots[group]))
            value = column(c).cast("string")
            cells[name].keys.append((value.isNotNull(), cell(group, slots[group], value)))
    keys = union_all(
        [own.rows(tables[name].rows) for name, own in cells.items() if own.keys or own.faults]
    )
    most = max(slots.values(), default=0)
    counts = [F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(most + 1)]
    rows_of = keys.groupBy("tag", "key").agg(*counts)
    failures = [F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}"))) for i in range(1, most + 1)]
    by_tag = rows_of.groupBy("tag").agg(
        (
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n0"))), F.lit(0))
            + F.count_if(F.col("key").isNotNull() & (F.col("n0") > 1))
        ).alias("f0"),
        *[F.coalesce(f, F.lit(0)).alias(f"f{i}") for i, f in enumerate(failures, 1)],
    )
    found = by_tag.select(
        "tag",
        F.posexplode(F.array(*[F.col(f"f{i}") for i in range(most + 1)])).alias("slot", "failures"),
    )
    names = "check string, model string, columns string, tag int, slot int"
    listed = keys.sparkSession.createDataFrame(declared, names)
    return listed.join(found, ["tag", "slot"], "left").select(
        "check", "model", "columns", F.coalesce("failures", F.lit(0).cast("long")).alias("failures")
    )
