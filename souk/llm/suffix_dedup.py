"""Removal of repeated passages by interval expansion on a Burrows-Wheeler transform.

Every byte that a string of ``MIN_BYTES`` bytes covers which starts anywhere else too, in any
document, is removed, in all places.

Strings meet by anchors: a string's anchor is its ``GRAM``-byte part of least hash, the last of
equals, so equal strings have equal anchors at equal distances. A stretch is the run of strings
in a document that share one anchor, with all their bytes. Stretches that are the same, bytes
and distances, are counted as one; where there are two or more, all their strings repeat and no
byte is read again. Only anchors with different stretches, one of them single, are looked at.

Their stretches are put together in blocks, suffixes are sorted by their first bytes, and the
common prefixes of neighbours are found by increasing value on the transform: a boundary between
suffixes of common prefix l lets the suffixes one byte longer that it tells apart have the
boundary l + 1. After ``MIN_BYTES`` - 1 rounds the expansion stops; suffixes without a boundary
share a string, and it is repeated if it starts at two places.

An anchor with more than ``MOST_STRETCHES`` different stretches (the edge of a passage that many
documents have) would fill a block. Its stretches are cut into cells of strings that start close
together. Parts in a cell that are the same are again counted as one, and only parts that share
the bytes common to the cell's strings are looked at: in a block if they are few, else in smaller
cells, down to one string.

Null texts are empty. Rows count each, so a row that repeats another of ``MIN_BYTES`` bytes
loses all of them, and so does the other. Matches never cross documents. Texts of any length are
read whole, in overlapping parts of ``PART_STRINGS`` strings. Other columns pass through ``apply``, but for one named kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from souk.llm import common

MIN_BYTES = 400
GRAM = 64
# Different stretches of one anchor that a block may hold, and the bytes of a block
MOST_STRETCHES = 512
BLOCK_BYTES = 1 << 20
# Strings in the cells that a hot anchor's stretches are cut into first
CELL = 49
# Strings that start in a part of a text whose stretches are found at once
PART_STRINGS = 1 << 20
# Bits of a hash that decide which part is least; the others hold its place
PLACE_BITS = 26

STRETCHES = "anchor long, stretch long, lo int, n int, distance int"


def stretches(data: np.ndarray, offsets: np.ndarray):
    """(text, first string, strings, distance of the anchor, hashes of the anchor and of the
    stretch) of every stretch of the texts."""
    width = MIN_BYTES - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(data) < MIN_BYTES:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    part = common.Substrings(data)
    grams = np.arange(len(data) - GRAM + 1)
    hashes = part(grams, grams + GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    # The last of equals has the least number in the low bits.
    ranked = (hashes & ~low) | (low - grams.astype(np.uint64))
    least = common.sliding_min(ranked, width)
    place = (low - (least & low)).astype(np.int64)
    text = np.searchsorted(offsets, np.arange(len(place)), "right") - 1
    inside = np.arange(len(place)) + MIN_BYTES <= offsets[text + 1]
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(change & inside)
    n = np.diff(np.append(np.flatnonzero(change | ~inside), len(place)))
    n = n[inside[np.flatnonzero(change | ~inside)]]
    anchor = hashes[place[first]]
    whole = part(first, first + n - 1 + MIN_BYTES)
    distance = place[first] - first
    shape = (distance * MIN_BYTES + n).astype(np.uint64)
    return text[first], first, n, distance, anchor, common.mix(whole ^ common.mix(shape))


def found_stretches(docs: DataFrame) -> DataFrame:
    """The stretches of rows (id, digest, data)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.steps(batch, "data"):
                data, offsets = common.flat(rows.column("data"))
                for start in range(0, max(1, len(data)), PART_STRINGS):
                    # Parts share the bytes of strings that start in one and end in the next. Only
                    # a text that is a step of its own has several.
                    part = data[start : start + PART_STRINGS + MIN_BYTES - 1]
                    bounds = np.clip(offsets - start, 0, len(part))
                    text, first, n, distance, anchor, stretch = stretches(part, bounds)
                    if not len(text):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("id").take(pa.array(text)),
                            rows.column("digest").take(pa.array(text)),
                            pa.array(anchor.view(np.int64)),
                            pa.array(stretch.view(np.int64)),
                            pa.array((start + first - offsets[text]).astype(np.int32)),
                            pa.array(n.astype(np.int32)),
                            pa.array(distance.astype(np.int32)),
                        ],
                        names=["id", "digest", "anchor", "stretch", "lo", "n", "distance"],
                    )

    return docs.mapInArrow(run, f"id {kind}, digest long, {STRETCHES}")


def _order_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of keys of so many bits, by key."""
    low = len(keys).bit_length()
    if bits + low > 64:
        return np.argsort(keys)
    # Sorting numbers is several times as fast as sorting places by them.
    packed = (keys << np.uint64(low)) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << low) - 1)).astype(np.int64)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the suffixes there, by at least their first ``depth`` symbols."""
    n = len(symbols)
    used = np.bincount(symbols) > 0
    codes = (np.cumsum(used) - 1).astype(np.uint64)[symbols]
    width = max(1, int(used.sum() - 1).bit_length())
    low = n.bit_length()
    known = max(1, (64 - low) // width)
    codes = np.concatenate([codes, np.zeros(known, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(known):
        key = (key << np.uint64(width)) | codes[j : j + n]
    order = _order_of(key, known * width)
    # Suffixes that are the same so far have the place of the first of them as rank. Only these
    # are sorted again, by the ranks of what follows.
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rows, key = np.arange(n), key[order]
    while True:
        head = np.ones(len(rows) + 1, bool)
        head[1:-1] = key[1:] != key[:-1]
        first = rows[head[:-1]]
        rank[order[rows]] = np.repeat(first, np.diff(np.flatnonzero(head)))
        rows = rows[~(head[:-1] & head[1:])]
        if known >= depth or not len(rows):
            return order
        suffix = order[rows]
        after = rank[np.minimum(suffix + known, n)] + 1
        key = (rank[suffix].astype(np.uint64) << np.uint64(low)) | after.astype(np.uint64)
        found = _order_of(key, 2 * low)
        order[rows] = suffix[found]
        key = key[found]
        known *= 2


def boundaries(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in order shares fewer than ``length`` symbols with the one before.

    Symbol 0 ends a text and equals nothing, itself included.
    """
    n = len(symbols)
    before = symbols[order - 1]
    by_symbol = np.argsort(before, kind="stable")
    # Row i extended by its symbol is row longer[i]; last[i] is the row above with that symbol.
    longer = np.empty(n, np.int64)
    longer[by_symbol] = np.arange(n)
    last = np.full(n, -1, np.int64)
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    last[by_symbol[1:][same]] = by_symbol[:-1][same]
    head = symbols[order]
    bound = np.ones(n, bool)
    bound[1:] = (head[1:] != head[:-1]) | (head[1:] == 0)
    new = np.flatnonzero(bound)
    waiting = np.flatnonzero((last >= 0) & (before > 0))
    waiting = waiting[~bound[longer[waiting]]]
    reach = 16
    far = None
    for _ in range(1, length):
        if not len(new) or not len(waiting):
            break
        if far is None and len(new) * 64 > n:
            passed = np.zeros(n + 1, np.int64)
            passed[new + 1] = 1
            passed = np.cumsum(passed)
            told = passed[waiting + 1] > passed[last[waiting] + 1]
            found = longer[waiting[told]]
            waiting = waiting[~told]
        else:
            # Few boundaries are new: look at the rows from each down to the next boundary, which
            # tells what is below it, and at the rows whose symbol was last seen far above.
            if far is None:
                far = waiting[waiting - last[waiting] > reach]
                last[before == 0] = -1
            parts, row, at = [], new, new
            for _ in range(reach):
                seen = last[row]
                parts.append(longer[row[(seen < at) & (seen >= 0)]])
                row = row + 1
                goes_on = row < n
                goes_on[goes_on] = ~bound[row[goes_on]]
                row, at = row[goes_on], at[goes_on]
                if not len(row):
                    break
            found = np.concatenate(parts)
            found = found[~bound[found]]
            if len(far):
                bound[found] = True
                far = far[~bound[longer[far]]]
                told = np.searchsorted(new, far, "right") > np.searchsorted(new, last[far], "right")
                found = np.concatenate([found, longer[far[told]]])
        bound[found] = True
        new = np.sort(found)
    return bound


def repeats(texts: list[bytes], starts: np.ndarray, length: int = MIN_BYTES) -> np.ndarray:
    """For the first ``starts[i]`` places of each text, one after another: whether the string of
    ``length`` bytes there starts at another of these places too."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    symbols = np.zeros(int(sizes.sum()) + len(texts), np.uint16)
    first = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    symbols[:] = data
    symbols += 1
    symbols[first + sizes] = 0
    owned = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(owned, first, 1)
    np.add.at(owned, first + starts, -1)
    owned = np.cumsum(owned[:-1]) > 0
    order = suffix_order(symbols, length)
    group = np.cumsum(boundaries(symbols, order, length)) - 1
    mine = owned[order]
    often = np.bincount(group[mine], minlength=int(group[-1]) + 1) > 1
    out = np.zeros(len(symbols), bool)
    out[order[mine & often[group]]] = True
    return out[owned]


def _ranges(flags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, from, number) of the runs of true flags within each text's own places."""
    offsets = np.concatenate([[0], np.cumsum(starts)])
    a, b = common.runs(flags, offsets)
    text = np.searchsorted(offsets, a, "right") - 1
    return text, a - offsets[text], b - a


RANGES = "anchor long, stretch long, at int, number int"


def compared(rows: DataFrame) -> DataFrame:
    """Repeated strings of stretches (anchor, stretch, n, bytes), whole anchors at a time."""

    def block(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables).combine_chunks()
        starts = table["n"].to_numpy().astype(np.int64)
        text, at, number = _ranges(repeats(table["bytes"].to_pylist(), starts), starts)
        return pa.RecordBatch.from_arrays(
            [
                table["anchor"].combine_chunks().take(pa.array(text)),
                table["stretch"].combine_chunks().take(pa.array(text)),
                pa.array(at.astype(np.int32)),
                pa.array(number.astype(np.int32)),
            ],
            names=["anchor", "stretch", "at", "number"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(own.column("bytes").nbytes for own in held) < BLOCK_BYTES:
                continue
            # The last anchor may go on in the next batch.
            anchors = [own.column("anchor").to_numpy() for own in held]
            last = anchors[-1][-1]
            whole, rest = [], []
            for own, anchor in zip(held, anchors):
                cut = int(np.searchsorted(anchor, last))
                whole.append(own.slice(0, cut))
                rest.append(own.slice(cut))
            if any(own.num_rows for own in whole):
                yield block(whole)
                held = [own for own in rest if own.num_rows]
        if held:
            yield block(held)

    return rows.mapInArrow(run, RANGES)


def _cells(rows: DataFrame, size: int) -> DataFrame:
    """Stretches (anchor, stretch, n, distance, bytes) cut into cells of ``size`` strings.

    Cells are counted from the anchor, so equal strings are in equal cells. ``key`` is a hash of
    the anchor, the cell, and the bytes that all strings of the cell have; ``part`` is one of
    the part of the stretch in the cell. ``at`` and ``n`` are the part's place and strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, distance = (batch.column(x).to_numpy().astype(np.int64) for x in ("n", "distance"))
            data, offsets = common.flat(batch.column("bytes"))
            part = common.Substrings(data)
            shift = MIN_BYTES - GRAM - distance
            cells = (shift + n - 1) // size - shift // size + 1
            row = np.repeat(np.arange(len(n)), cells)
            cell = shift[row] // size + np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
            first = cell * size - shift[row]
            low, high = np.maximum(first, 0), np.minimum(first + size, n[row])
            anchor = batch.column("anchor").to_numpy().view(np.uint64)[row]
            shared = part(offsets[row] + first + size - 1, offsets[row] + first + MIN_BYTES)
            key = common.mix(shared ^ common.mix(anchor + cell.astype(np.uint64)))
            whole = part(offsets[row] + low, offsets[row] + high - 1 + MIN_BYTES)
            place = ((low - first) * MIN_BYTES + high - low).astype(np.uint64)
            whole = common.mix(whole ^ common.mix(place))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("anchor").take(pa.array(row)),
                    batch.column("stretch").take(pa.array(row)),
                    pa.array(low.astype(np.int32)),
                    pa.array((high - low).astype(np.int32)),
                    pa.array(key.view(np.int64)),
                    pa.array(whole.view(np.int64)),
                ],
                names=["anchor", "stretch", "at", "n", "key", "part"],
            )

    return rows.mapInArrow(
        run, "anchor long, stretch long, at int, n int, key long, part long"
    )


def repeated(pieces: DataFrame, size: int = CELL) -> DataFrame:
    """Ranges (anchor, stretch, at, number) of the strings of different stretches (anchor,
    stretch, n, distance, bytes, many) that repeat. ``many`` marks anchors with too many for a
    block: their stretches are cut into cells, and cells that share all they can are compared
    like anchors, down to cells of one string."""
    few = pieces.where("not many").select("anchor", "stretch", "n", "bytes")
    few = few.repartition("anchor").sortWithinPartitions("anchor", "stretch")
    found = compared(few)
    many = pieces.where("many")
    if many.isEmpty():
        return found
    cells = common.written(_cells(many, size), "cells")
    one = F.struct("anchor", "stretch", "at", "n")
    distinct = cells.groupBy("key", "part").agg(
        F.count(F.lit(1)).alias("times"), F.min(one).alias("one")
    )
    distinct = common.written(distinct, "parts")
    ranges = distinct.where("times > 1").select(
        F.col("key").alias("anchor"),
        F.col("part").alias("stretch"),
        F.lit(0).alias("at"),
        F.col("one.n").alias("number"),
    )
    if size > 1:
        groups = distinct.groupBy("key").agg(
            F.count(F.lit(1)).alias("different"), F.min("times").alias("least")
        )
        groups = common.written(groups.where("different > 1 and least = 1"), "groups")
        wanted = distinct.join(groups, "key").select(
            "key", "part", "one.*", (F.col("different") > MOST_STRETCHES).alias("more")
        )
        own = many.drop("n", "many").join(wanted, ["anchor", "stretch"])
        length = F.col("n") - 1 + MIN_BYTES
        own = own.select(
            F.col("key").alias("anchor"),
            F.col("part").alias("stretch"),
            "n",
            (F.col("distance") - F.col("at")).alias("distance"),
            F.substring(F.col("bytes"), F.col("at") + 1, length).alias("bytes"),
            F.col("more").alias("many"),
        )
        ranges = ranges.unionByName(repeated(common.written(own, "pieces"), max(1, size // 7)))
    ranges = common.written(ranges, "ranges").select(
        F.col("anchor").alias("key"), F.col("stretch").alias("part"), F.col("at").alias("from"), "number"
    )
    back = cells.drop("n").join(ranges, ["key", "part"]).select(
        "anchor", "stretch", (F.col("at") + F.col("from")).alias("at"), "number"
    )
    return found.unionByName(back)


def _bytes_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted stretches (id, digest, anchor, stretch, lo, n, distance, many) with their bytes."""
    piece = F.struct("anchor", "stretch", "lo", "n", "distance", "many")
    lists = wanted.groupBy("id", "digest").agg(F.collect_list(piece).alias("pieces"))
    joined = _with(docs, lists, "inner").select("data", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("data")[i].as_buffer()
                pieces = batch.column("pieces").slice(i, 1).flatten()
                lo, n = (pieces.field(x).to_numpy() for x in ("lo", "n"))
                cut = [raw[a : a + m - 1 + MIN_BYTES].to_pybytes() for a, m in zip(lo.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pieces.field("anchor"),
                        pieces.field("stretch"),
                        pieces.field("n"),
                        pieces.field("distance"),
                        pieces.field("many"),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["anchor", "stretch", "n", "distance", "many", "bytes"],
                )

    kinds = "anchor long, stretch long, n int, distance int, many boolean, bytes binary"
    return joined.mapInArrow(run, kinds)


def _with(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    other = other.withColumnsRenamed({"id": "_id", "digest": "_digest"})
    same = (docs["digest"] == other["_digest"]) & docs["id"].eqNullSafe(other["_id"])
    return docs.join(other, same, how).drop("_id", "_digest")


def _keyed(id_column: str, text: str) -> list[Column]:
    """The id, a digest by which rows of one id are told apart, and the bytes of the text."""
    data = F.coalesce(F.col(text), F.lit(""))
    return [
        F.col(id_column).alias("id"),
        F.xxhash64(data).alias("digest"),
        data.cast("binary").alias("data"),
    ]


def covered(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, spans) of the documents that lose bytes; spans may overlap."""
    common.ready(docs.sparkSession)
    rows = docs.select(*_keyed(id_column, text))
    every = common.written(found_stretches(rows), "stretches")
    distinct = every.groupBy("anchor", "stretch").agg(
        F.count(F.lit(1)).alias("times"),
        F.min(F.struct("id", "digest", "lo", "n", "distance")).alias("one"),
    )
    distinct = common.written(distinct, "distinct")
    anchors = distinct.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("different"), F.min("times").alias("least")
    )
    # Groups are written before they are joined to their rows: Spark splits the rows of a hot
    # one only in a join of plain shuffled tables.
    anchors = common.written(anchors.where("different > 1 and least = 1"), "anchors")
    wanted = distinct.join(anchors, "anchor").select(
        "one.*", "anchor", "stretch", (F.col("different") > MOST_STRETCHES).alias("many")
    )
    pieces = common.written(_bytes_of(rows, wanted), "pieces")
    found = common.written(repeated(pieces), "ranges")
    whole = distinct.where("times > 1").select(
        "anchor", "stretch", F.lit(0).alias("at"), F.col("one.n").alias("number")
    )
    found = whole.unionByName(found).groupBy("anchor", "stretch").agg(
        F.collect_list(F.struct("at", "number")).alias("ranges")
    )
    found = common.written(found, "found")
    spans = every.join(found, ["anchor", "stretch"]).select(
        "id", "digest", "lo", F.inline("ranges")
    )
    start = F.col("lo") + F.col("at")
    span = F.struct(start.alias("start"), (start + F.col("number") - 1 + MIN_BYTES).alias("stop"))
    return spans.groupBy("id", "digest").agg(F.collect_set(span).alias("spans"))


def _kept(raw: bytes, spans) -> tuple[bytes, int]:
    """What is left of the bytes, and the number of separate parts that go."""
    parts, at, gone = [], 0, 0
    for span in sorted((x["start"], x["stop"]) for x in spans or ()):
        if not gone or span[0] > at:
            parts.append(raw[at : span[0]])
            gone += 1
        at = max(at, span[1])
    return b"".join([*parts, raw[at:]]), gone


def _over(docs: DataFrame, id_column: str, text: str, row: Column, added: str, one) -> DataFrame:
    """``row`` of every document and what ``one`` makes of its bytes, what is left, and the
    number of parts gone."""
    spans = covered(docs, id_column, text)
    rows = docs.select(row.alias("row"), *_keyed(id_column, text))
    rows = _with(rows, spans, "left").select("row", "data", "spans")
    fields = StructType.fromDDL(added).fields
    schema = StructType([rows.schema["row"], *fields])
    kinds = to_arrow_schema(StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for value, own in zip(batch.column("data"), batch.column("spans").to_pylist()):
                raw = value.as_buffer().to_pybytes()
                made.append(one(raw, *_kept(raw, own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row")]
                + [pa.array(x, kind.type) for x, kind in zip(zip(*made), kinds)],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def apply(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with ``kept``, the bytes that are left of their texts."""
    row = F.struct(*[name for name in docs.columns if name.lower() != "kept"])
    out = _over(docs, id_column, text, row, "kept binary", lambda raw, left, gone: (left,))
    return out.select("row.*", "kept")


def report(docs: DataFrame) -> DataFrame:
    """Sizes and digests of what is left of each document."""

    def one(raw: bytes, left: bytes, gone: int):
        return len(raw), len(raw) - len(left), gone, sha256(left).hexdigest()

    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = _over(docs, "doc_id", "text", F.struct("doc_id"), added, one)
    return out.select("row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256")
