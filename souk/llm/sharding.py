"""Sharding by extendible hashing, in DataFrame functions throughout.

A document's hash is read from its first bit on. The directory starts with one bucket for all;
a bucket over the byte limit splits on the next bit, any other is a shard, named by its bits. A
bucket of one document is a shard whatever its size.

Bytes are summed once for cells of more bits than needed, and cells are summed up to every
shorter prefix, so no bucket's documents are looked at while it splits. Documents of cells that
are still too large are read again by further bits. Documents that share all bits (repeated
ids) are told apart by their place among equal rows, which are counted and dealt out again.

A null text has no bytes; a null id hashes as the empty string; an empty table has no shards.
Ids may be repeated: every row is placed. Other columns are left out by ``assign`` and pass
through ``shard``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm import common

SHARD_BYTES = 64 * 1024 * 1024
# Bits of a hash, and bits that cells have beyond what an even spread needs
BITS = 60
EXTRA_BITS = 6
# Bits that one pass may look at; a cell's ancestors are a row each
MOST_BITS = 40


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a long, so that other engines find the same."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast(
        "long"
    )


def prefix(value: Column, depth: Column) -> Column:
    return F.call_function("shiftright", value, (F.lit(BITS) - depth).cast("int"))


def shards_of(rows: DataFrame, limit: int) -> DataFrame:
    """(root, hash, depth, shard_bytes, shard_docs) of every distinct (root, hash) of the rows
    (root, hash, n_bytes); each root has a directory of its own.

    A depth beyond ``BITS`` marks what shares all bits and is too large.
    """
    rows = common.written(rows.select("root", "hash", "n_bytes"), "hashes")
    done, base = rows.select(
        "root", "hash", F.lit(0).alias("depth"), F.col("n_bytes").alias("shard_bytes"),
        F.col("n_bytes").alias("shard_docs"),
    ).limit(0), 0
    while True:
        roots = rows.groupBy("root").agg(F.sum("n_bytes").alias("bytes"))
        largest = roots.agg(F.max("bytes").alias("bytes")).first()["bytes"]
        if largest is None:
            return done
        even = max(1, math.ceil(math.log2(max(1, largest / limit))))
        deep = min(BITS, base + min(MOST_BITS, even + EXTRA_BITS))
        celled = rows.withColumn("cell", prefix(F.col("hash"), F.lit(deep)))
        cells = celled.groupBy("root", "cell").agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")
        )
        sums = (
            cells.withColumn("depth", F.explode(F.sequence(F.lit(base), F.lit(deep))))
            .groupBy("root", "depth", F.expr(f"shiftright(cell, {deep} - depth)").alias("bits"))
            .agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        )
        sums = common.written(sums, "sums")
        fits = (F.col("bytes") <= limit) | (F.col("docs") <= 1)
        split = sums.where(~fits).select(
            "root", (F.col("depth") + 1).alias("depth"), F.col("bits").alias("above")
        )
        small = sums.where(fits).withColumn("above", F.shiftright("bits", 1))
        # What fits is a shard if the bucket above it had to split, or is the first of all.
        leaves = small.join(split, ["root", "depth", "above"], "left_semi")
        if base == 0:
            leaves = leaves.unionByName(small.where("depth = 0"))
        under = F.expr(
            f"sequence(shiftleft(bits, {deep} - depth), shiftleft(bits + 1, {deep} - depth) - 1)"
        )
        of_cell = leaves.select(
            "root",
            F.explode(under).alias("cell"),
            "depth",
            F.col("bytes").alias("shard_bytes"),
            F.col("docs").alias("shard_docs"),
        )
        found = celled.select("root", "hash", "cell").distinct().join(of_cell, ["root", "cell"])
        done = done.unionByName(found.drop("cell"))
        large = sums.where(~fits & (F.col("depth") == deep)).select("root", F.col("bits").alias("cell"))
        rest = celled.join(large, ["root", "cell"], "left_semi")
        if deep == BITS:
            alike = rest.groupBy("root", "hash").agg(
                F.lit(BITS + 1).alias("depth"),
                F.sum("n_bytes").alias("shard_bytes"),
                F.count(F.lit(1)).alias("shard_docs"),
            )
            return done.unionByName(alike)
        if large.isEmpty():
            return done
        rows = common.written(rest.select("root", "hash", "n_bytes"), "hashes")
        base = deep


def _name(value: Column, depth: Column) -> Column:
    """The bits of the prefix as text; the only bucket of an unsplit directory has none."""
    bits = F.lpad(F.bin(prefix(value, depth)), F.lit(BITS), "0")
    return F.when(depth == 0, F.lit("")).otherwise(F.substring(bits, F.lit(BITS) - depth + 1, depth))


def assign(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES
) -> DataFrame:
    """(id, n_bytes, shard, depth, shard_bytes, shard_docs) of every row.

    Rows of one id that share all bits and are too large together get further bits, after a
    dash, from their place among them.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    rows = rows.withColumn("hash", hash_bits(F.col("id"))).withColumn("root", F.lit(""))
    rows = common.written(rows, "documents")
    found = common.written(shards_of(rows, limit), "shards")
    placed = _placed(rows, found.where(F.col("depth") <= BITS))
    alike = found.where(F.col("depth") > BITS).select("hash")
    if not alike.isEmpty():
        # Rows that are equal in all that matters here are counted and dealt out again.
        counted = rows.join(alike, "hash", "left_semi").groupBy("id", "n_bytes", "hash")
        copies = counted.agg(F.count(F.lit(1)).alias("copies")).withColumn(
            "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
        )
        key = F.concat_ws("/", F.hex("hash"), F.col("n_bytes"), F.col("copy"))
        copies = copies.withColumn("root", F.concat(_name(F.col("hash"), F.lit(BITS)), F.lit("-")))
        copies = common.written(copies.withColumn("hash", hash_bits(key)), "copies")
        found = common.written(shards_of(copies, limit), "shards")
        more = _placed(copies, found.withColumn("depth", F.least("depth", F.lit(BITS))))
        placed = placed.unionByName(more.withColumn("depth", F.col("depth") + BITS))
    return placed.withColumnRenamed("id", id_column).withColumn("depth", F.col("depth").cast("int"))


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, ["root", "hash"]).select(
        "id",
        "n_bytes",
        F.concat("root", _name(F.col("hash"), F.col("depth"))).alias("shard"),
        "depth",
        "shard_bytes",
        "shard_docs",
    )


def write_shards(
    docs: DataFrame, path: str, id_column: str = "doc_id", limit: int = SHARD_BYTES
) -> None:
    """Writes the documents as Parquet, one folder for each shard.

    Documents of one id lie in one shard, unless they are too large together; then they are
    dealt to its shards, to each as many of each size as ``assign`` counts there.
    """
    placed = common.written(assign(docs, id_column, limit=limit), "placed")
    whole = placed.where(F.col("depth") <= BITS).groupBy(F.col(id_column).alias("own_id"))
    whole = common.written(whole.agg(F.min("shard").alias("shard")), "whole")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_column).alias("id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("at"),
    )
    out = rows.join(whole, F.col("id").eqNullSafe(F.col("own_id"))).select("row.*", "shard")
    split = placed.where(F.col("depth") > BITS)
    if not split.isEmpty():
        out = out.unionByName(_dealt(rows, split, id_column).select("row.*", "shard"))
    out.repartition("shard").write.partitionBy("shard").parquet(path)


def _dealt(rows: DataFrame, split: DataFrame, id_column: str) -> DataFrame:
    """(row, shard) of the rows whose ids are split.

    Rows of one id and size are numbered by partition and place in it, so no task sees them
    all, and a shard takes as many numbers in a row as it has of them.
    """
    ids = common.written(split.select(F.col(id_column).alias("own_id")).distinct(), "split_ids")
    many = rows.join(ids, F.col("id").eqNullSafe(F.col("own_id")), "left_semi")
    # Written, as the numbers have to stay.
    many = common.written(
        many.select("row", F.struct("id", "n_bytes").alias("own"), "at"), "split_rows"
    ).withColumn("part", F.shiftright("at", 33))

    def spans(counted: DataFrame, by: str, low: str, high: str) -> DataFrame:
        up_to = Window.partitionBy("own").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn(high, F.sum("n").over(up_to))
        return counted.withColumn(low, F.col(high) - F.col("n")).drop("n")

    n = F.count(F.lit(1)).alias("n")
    own = F.struct(F.col(id_column).alias("id"), F.col("n_bytes"))
    parts = spans(many.groupBy("own", "part").agg(n), "part", "low", "high")
    shards = spans(split.groupBy(own.alias("own"), "shard").agg(n), "shard", "start", "stop")
    cuts = parts.join(shards, "own").where("start < high and low < stop")
    cuts = cuts.groupBy("own", "part", "low").agg(
        F.array_sort(F.collect_list(F.struct("start", "shard"))).alias("cuts")
    )
    cuts = common.written(cuts, "cuts")
    nth = F.row_number().over(Window.partitionBy("own", "part").orderBy("at")) - 1
    found = many.withColumn("nth", nth).join(cuts, ["own", "part"])
    number = F.col("low") + F.col("nth")
    last = F.element_at(F.filter("cuts", lambda cut: cut["start"] <= number), -1)
    return found.select("row", last["shard"].alias("shard"))


ORACLE_SQL = f"""
with hashed as (
    select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
    from documents
),
sized as (
    select *, depth,
        sum(n_bytes) over p as shard_bytes, count(*) over p as shard_docs
    from hashed, range(0, {BITS} + 1) as d(depth)
    window p as (partition by depth, h >> ({BITS} - depth)::bigint)
),
found as (
    select doc_id, n_bytes, h, depth, shard_bytes, shard_docs,
        row_number() over (partition by doc_id, h order by depth) as nth
    from sized where shard_bytes <= {{limit}} or shard_docs <= 1
)
select doc_id, n_bytes,
    case when depth = 0 then ''
        else right(bin(h + (1::bigint << {BITS})), {BITS})[:depth] end as shard,
    depth::int as depth, shard_bytes::bigint as shard_bytes, shard_docs
from found where nth = 1
"""
