"""CSV files of the raw tables, as a marketplace would hand them over.

Written by Spark from given raw tables, so that loading can be exercised on all their rows.
Some item and review records are made malformed by fixed arithmetic on their keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.sources.raw_tables import RAW_TABLES
from souk.sources.store import TableStore

# Each writing task leaves one file, so a file is bounded by what a task reads.
COMPRESSION = "gzip"


def write_all(raw: Mapping[str, DataFrame], store: TableStore) -> str:
    """Write `<table>.csv` folders and return the folder that holds them."""
    for name, table in RAW_TABLES.items():
        rows = raw[name].select(*[F.col(c).cast("string") for c in table.columns])
        path = store.path(f"{name}.csv")
        if name == "raw_order_items":
            write_lines(damaged_items(rows), table.columns, path, "overwrite")
        elif name == "raw_reviews":
            broken = F.col("review_id").cast("long") % 40 == 3
            write_csv(with_line_breaks(rows.where(~broken)), path)
            write_lines(damaged_reviews(rows.where(broken)), table.columns, path, "append")
        else:
            write_csv(rows, path)
    return store.root


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "compression", COMPRESSION
    ).csv(path)


def write_lines(lines: DataFrame, columns: tuple[str, ...], path: str, mode: str) -> None:
    """Ready-made lines below a header: one unquoted column whose name is the header."""
    lines.toDF(",".join(columns)).write.mode(mode).option("header", True).option(
        "sep", "\u0001"
    ).option("quote", "").option("compression", COMPRESSION).csv(path)


def _line(*fields: Column) -> Column:
    return F.concat_ws(",", *fields)


def damaged_items(items: DataFrame) -> DataFrame:
    """Per fifty records one too long, one too short (no freight) and one with price NA."""
    spot = (F.col("order_id").cast("long") * 7 + F.col("order_item_id").cast("long")) % 50
    head = [F.col(c) for c in ["order_id", "order_item_id", "product_id", "seller_id"]]
    price, freight = F.col("price"), F.col("freight_value")
    return items.select(
        F.when(spot == 0, _line(*head, price, freight, F.lit("surplus")))
        .when(spot == 1, _line(*head, price))
        .when(spot == 2, _line(*head, F.lit("NA"), freight))
        .otherwise(_line(*head, price, freight))
        .alias("line")
    )


def with_line_breaks(reviews: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit('said "'), "review_comment_message", F.lit('",\nscore '), "review_score"
    )
    return reviews.withColumn("review_comment_message", text)


def damaged_reviews(reviews: DataFrame) -> DataFrame:
    """Half of them lack the last field, half have one too many."""
    fields = [F.col(c) for c in reviews.columns if c not in ("review_comment_title", "review_comment_message")]
    short = F.col("review_id").cast("long") % 80 == 3
    return reviews.select(
        F.when(short, _line(*fields)).otherwise(
            _line(*fields, F.lit("a"), F.lit("b"), F.lit("c"))
        ).alias("line")
    )
