"""SimHash near-duplicates by an index of byte positions with count filtering.

A fingerprint of 8 bytes that differs from another in at most 3 bits has at least 5 bytes in
common with it, place by place. The 14 sets of four places in ``PLACES`` are chosen so that any
5 places hold one of the sets, so the index lists a fingerprint once for each set, under the
four bytes there. Lists of single bytes would hold a 256th of all fingerprints each.

Fingerprints that meet in a list are tallied: their shared positional bytes are counted, pairs
with fewer than 5 are dropped, and the rest are verified by their differing bits. A list is cut
into chunks of at most ``CHUNK`` expected fingerprints; a task sees two chunks of one list and
returns a spanning forest of the links it found, so rows never grow with the square of a group.

Words are runs of anything but space and \\t \\n \\v \\f \\r. Fewer words than a shingle are one
shingle; no words (or a null text) give the fingerprint 0, linked like any other. Rows with the
same fingerprint are in one component whatever their ids are; a component without any id has
the id null. Repeated rows are judged alike. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import common
from souk.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# Positional bytes that fingerprints must share when MAX_BITS bits differ
MIN_SHARED = 8 - MAX_BITS
CHUNK = 2048


def _places() -> list[tuple[int, ...]]:
    """Sets of four places of which any three places together lie in exactly one.

    Complements of such sets are such sets too, so the places that three bits leave alone
    always hold one of them. Places are read as vectors of three bits: four of them form a
    set if they cancel out.
    """
    return [c for c in combinations(range(8), 4) if not c[0] ^ c[1] ^ c[2] ^ c[3]]


PLACES = _places()


def fingerprint(words: list[bytes], size: int = SHINGLE_WORDS) -> int:
    """Bits that are set in over half of the hashes of the shingles."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(text, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[:-size].tolist()]
        stops = (ends[size - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[a:b], SEED) for a, b in zip(starts, stops)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint as a signed long) of every row."""
    common.ready(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(1):
                raw = value.as_buffer()
                words = raw.to_pybytes().lower().split() if raw is not None else []
                found.append(fingerprint(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["id", "fp"],
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(compute, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def index(prints: DataFrame) -> DataFrame:
    """A row (place set, its bytes, fp) for each set of places."""
    masks = [sum(0xFF << (8 * place) for place in places) for places in PLACES]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    lists = [
        F.struct(F.lit(i).alias("places"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bytes"))
        for i, mask in enumerate(signed)
    ]
    return prints.select("fp", F.inline(F.array(*lists)))


CELL = ["places", "bytes", "low", "high"]


def cells(listed: DataFrame) -> DataFrame:
    """Rows of lists with two fingerprints or more; long lists in pairs of chunks."""
    sizes = listed.groupBy("places", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that Spark can split a long list's rows in the join.
    sizes = common.written(sizes, "sizes")
    rows = listed.join(sizes, ["places", "bytes"])
    chunks = F.ceil(F.col("n") / CHUNK)
    own = F.pmod(F.xxhash64("fp"), chunks)
    rows = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
    )
    return rows.select(
        "places",
        "bytes",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "fp",
    )


def forest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For positions linked pairwise, the least position each can reach."""
    root = np.arange(len(values))
    while len(left):
        least = np.minimum(root[left], root[right])
        old = root.copy()
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        np.minimum.at(root, old[left], least)
        np.minimum.at(root, old[right], least)
        root = root[root]
        if np.array_equal(root, old):
            break
    return root


def pairs_within(cell: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of equal cells whose values share enough positional bytes and differ little."""
    at, step, left, right = np.arange(len(values)), 1, [], []
    while True:
        at = at[at + step < len(values)]
        at = at[cell[at] == cell[at + step]]
        if not len(at):
            break
        differ = values[at] ^ values[at + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = at[(shared >= MIN_SHARED) & (np.bitwise_count(differ) <= MAX_BITS)]
        left.append(near)
        right.append(near + step)
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that join all that differ in few bits."""

    def compare(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables)
        values = table["fp"].to_numpy().view(np.uint64)
        change = np.zeros(len(values), bool)
        for name in CELL:
            own = table[name].to_numpy()
            change[1:] |= own[1:] != own[:-1]
        root = forest(values, *pairs_within(np.cumsum(change), values))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[x].view(np.int64)) for x in (root[moved], moved)], names=["u", "v"]
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last cell may go on in the next batch.
            key = [batch.column(name).to_numpy() for name in CELL]
            same = np.all([own == own[-1] for own in key], axis=0)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield compare([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield compare(held)

    found = cells(index(prints)).repartition(*CELL).sortWithinPartitions(*CELL, "fp")
    return found.mapInArrow(search, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row."""
    prints = common.written(fingerprints(docs, id_column, text), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("id").alias("first"))
    classes = common.written(classes, "classes")
    roots = common.written(components(links(classes.select("fp"))), "roots")
    classes = classes.join(
        roots.select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    least = common.written(least, "least")
    of_print = classes.join(least, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one of the least id, then the least hash of its text.

    A null id comes last. Of rows that repeat an id and a text, the one stays whose other columns
    come first as JSON.
    """
    id_ = F.col(id_column)
    own = F.struct(
        id_.isNull().alias("none"), id_.alias("id"), F.xxhash64(text).alias("digest")
    )
    found = near_duplicates(docs.select(own.alias(id_column), text), id_column, text)
    stays = found.where(F.col(id_column).eqNullSafe(F.col("component_id")))
    stays = stays.groupBy(F.col("component_id").alias("own")).agg(F.count(F.lit(1)).alias("n"))
    # Written, so that Spark can split the rows of a document that repeats in the join.
    stays = common.written(stays, "stays")
    rows = docs.select(F.struct(*docs.columns).alias("row"), own.alias("own")).join(stays, "own")
    others = [F.col("row")[name].alias(name) for name in docs.columns if name != text]
    first = F.min_by("row", F.to_json(F.struct(*others))).alias("row")
    alike = rows.where("n > 1").groupBy("own").agg(first)
    rows = rows.where("n = 1").select("row").unionByName(alike.select("row"))
    return rows.select("row.*")
