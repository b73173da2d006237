"""Near-duplicate lines by a segment-partition edit join.

Lines of ``MIN_CHARS`` code points or more whose edit distance is at most ``EDITS`` are linked;
of each connected class, the line that comes first by (doc_id, hash of the text, line number)
stays in its document and all others go. In shorter lines so few edits can make another line;
with ``short``, as the query and the pipeline have it, those are judged by equality.

A line is cut into ``EDITS`` + 1 segments. At most ``EDITS`` edits leave one of them whole, at a
place in the other line that differs by few characters. So the index lists a line under each of
(its length, segment number, segment), and a line probes it with its own substrings for every
indexed length down to ``EDITS`` less, at the places where an edit script can have left the
segment. Only distinct lines are joined.

Lines that meet carry the sum of a random number for each character's class. Few edits change
that sum by one of few values, which drops nearly all others before a text is read. What is left
is verified on the texts by a bit-parallel comparison within the band of ``EDITS`` diagonals.

A list is compared in chunks: rows of a list longer than ``CHUNK`` are dealt to cells that hold
two chunks each, so no task holds a whole long list.

Null and empty texts have no lines that count; short lines of white space only
always stay, and without ``short`` all short lines.
Rows that repeat an id and a text are one document and keep or lose the same lines. A null id
comes before all others. Other columns pass through ``apply``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import common
from souk.llm.components import components

# Code points of a line from which few edits link it to another
MIN_CHARS = 40
EDITS = 2
CHUNK = 2048
# Classes of characters whose numbers are summed
CLASSES = 16
# In a line or text with a word
WORD = r"[^\x20\x09-\x0D]"
# Pairs of characters that are compared at once
CELLS = 1 << 21
# Lines whose keys a task remembers to have sent
REMEMBERED = 200_000


def segments(lengths: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of one of the EDITS + 1 segments of lines of these lengths."""
    size, longer = lengths // (EDITS + 1), lengths % (EDITS + 1)
    short = EDITS + 1 - longer
    return number * size + np.maximum(0, number - short), size + (number >= short)


def probes() -> Iterator[tuple[int, int, int]]:
    """(length difference, segment, shift) of the substrings to look up.

    With ``number`` segments before and ``EDITS - number`` after it, a whole segment that is the
    first such one has shifted by at most ``number`` from the left, and by at most
    ``EDITS - number`` from the right end. No shift at equal length is the index entry itself.
    """
    for less in range(EDITS + 1):
        for number in range(EDITS + 1):
            low = max(-number, less - (EDITS - number))
            high = min(number, less + (EDITS - number))
            for shift in range(low, high + 1):
                if less or shift:
                    yield less, number, shift


def _class_numbers() -> np.ndarray:
    return common.mix(np.arange(1, CLASSES + 1, dtype=np.uint64) * common.BASE)


def reachable_sums() -> np.ndarray:
    """Differences of sums that at most EDITS edits can make, in order."""
    numbers = [*_class_numbers().tolist(), 0]
    edit = np.unique(np.array([(a - b) % (1 << 64) for a in numbers for b in numbers], np.uint64))
    sums = np.zeros(1, np.uint64)
    for _ in range(EDITS):
        sums = np.unique((sums[:, None] + edit[None, :]).ravel())
    return sums


KEYS = "key long, line long, total long, listed boolean"


def _keys_of(lines: list[str], ids: np.ndarray) -> list[np.ndarray]:
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    first = np.cumsum(lengths) - lengths
    part = common.Substrings(codes)
    classes = (codes ^ (codes >> np.uint32(4))) & np.uint32(CLASSES - 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_class_numbers()[classes])])
    totals = sums[first + lengths] - sums[first]
    own, keys, listed = [], [], []

    def add(rows, lengths_, number, starts, sizes, is_listed):
        tag = (lengths_ * (EDITS + 1) + number).astype(np.uint64)
        keys.append(common.mix(part(starts, starts + sizes) ^ common.mix(tag)))
        own.append(rows)
        listed.append(np.full(len(rows), is_listed))

    every = np.arange(len(lines))
    for number in range(EDITS + 1):
        starts, sizes = segments(lengths, number)
        add(every, lengths, number, first + starts, sizes, True)
    for less, number, shift in probes():
        starts, sizes = segments(lengths - less, number)
        starts = starts + shift
        fits = np.flatnonzero((starts >= 0) & (starts + sizes <= lengths))
        rows = every[fits]
        add(rows, lengths[fits] - less, number, first[fits] + starts[fits], sizes[fits], False)
    rows = np.concatenate(own)
    return [
        np.concatenate(keys).view(np.int64),
        ids[rows],
        totals[rows].view(np.int64),
        np.concatenate(listed),
    ]


def keys(docs: DataFrame, text: str) -> DataFrame:
    """Index entries and probes of the lines; a task sends a line it has just sent only once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        names = ["key", "line", "total", "listed"]
        for batch in batches:
            for part in common.steps(batch, text):
                new = {}
                for value in part.column(text).to_pylist():
                    for line in (value or "").split("\n"):
                        if len(line) >= MIN_CHARS:
                            line_id = xxhash.xxh64_intdigest(line.encode(), 42)
                            if line_id not in sent:
                                new[line_id] = line
                if len(sent) + len(new) > REMEMBERED:
                    sent.clear()
                sent.update(new)
                if new:
                    ids = np.fromiter(new, np.uint64, len(new)).view(np.int64)
                    made = _keys_of(list(new.values()), ids)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=names)

    return docs.select(text).mapInArrow(run, KEYS)


def _meetings(tables: list[pa.RecordBatch], cell: list[str], reach: np.ndarray):
    """Pairs of lines with equal cells, one of them listed, whose sums few edits can join."""
    table = pa.Table.from_batches(tables)
    change = np.zeros(len(table), bool)
    for name in cell:
        own = table[name].to_numpy()
        change[1:] |= own[1:] != own[:-1]
    group = np.cumsum(change)
    line, total = table["line"].to_numpy(), table["total"].to_numpy().view(np.uint64)
    listed = table["listed"].to_numpy(zero_copy_only=False)
    at, step, left, right = np.arange(len(line)), 1, [], []
    while True:
        at = at[at + step < len(line)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        one = at[(listed[at] | listed[at + step]) & (line[at] != line[at + step])]
        # Between two unsigned sums, edits one way are edits the other way.
        differ = total[one] - total[one + step]
        where = np.minimum(np.searchsorted(reach, differ), len(reach) - 1)
        one = one[reach[where] == differ]
        left.append(line[one])
        right.append(line[one + step])
        step += 1
    none = np.zeros(0, np.int64)
    left, right = np.concatenate([none, *left]), np.concatenate([none, *right])
    pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
    return pairs[0], pairs[1]


def _compared(rows: DataFrame, cell: list[str], limit: int | None) -> DataFrame:
    """Pairs (a, b) of rows sorted by cell. Rows of cells above the limit come back as they are,
    with a null in b, a row at a time and never held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = reachable_sums()
        held: list[pa.RecordBatch] = []
        names = ["a", "b", "key", "total", "listed"]
        over = None

        def pairs(tables):
            a, b = _meetings(tables, cell, reach)
            nulls = [pa.nulls(len(a), kind) for kind in (pa.int64(), pa.int64(), pa.bool_())]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *nulls], names=names)

        def passed(tables):
            for own in tables:
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("line"),
                        pa.nulls(len(own), pa.int64()),
                        own.column("key"),
                        own.column("total"),
                        own.column("listed"),
                    ],
                    names=names,
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(name).to_numpy() for name in cell]
            change = np.zeros(len(key[0]), bool)
            for own in key:
                change[1:] |= own[1:] != own[:-1]
            first = np.flatnonzero(change)
            head = tuple(own[0] for own in key)
            if over is not None:
                # The list that was too long may go on.
                stop = int(first[0]) if len(first) else batch.num_rows
                if head == over:
                    yield from passed([batch.slice(0, stop)])
                    batch = batch.slice(stop)
                    if not batch.num_rows:
                        continue
                    first = first[1:] - stop
                    key = [own[stop:] for own in key]
                over = None
            cut = int(first[-1]) if len(first) else 0
            if cut:
                yield pairs([*held, batch.slice(0, cut)])
                held = []
            elif held and tuple(held[0].column(name)[0].as_py() for name in cell) != tuple(
                int(own[0]) for own in key
            ):
                yield pairs(held)
                held = []
            held.append(batch.slice(cut))
            if limit is not None and sum(own.num_rows for own in held) > limit:
                yield from passed(held)
                over, held = tuple(own[-1] for own in key), []
        if held:
            yield pairs(held)

    return rows.mapInArrow(run, "a long, b long, key long, total long, listed boolean")


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """Distinct pairs (a, b) of line hashes that met and passed the test of sums."""
    rows = keys(docs, text).repartition("key").sortWithinPartitions("key", "line")
    found = common.written(_compared(rows, ["key"], CHUNK), "meetings")
    pairs = found.where("b is not null").select("a", "b")
    long = found.where("b is null").select("key", F.col("a").alias("line"), "total", "listed")
    # Written, so that Spark can split a long list's rows in the join.
    sizes = common.written(long.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    chunks = F.ceil(F.col("n") / CHUNK)
    own = F.pmod(F.xxhash64("line"), chunks)
    dealt = (
        long.distinct()
        .join(sizes, "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .select("key", "low", "high", "line", "total", "listed")
    )
    cell = ["key", "low", "high"]
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell, "line")
    more = _compared(dealt, cell, None).select("a", "b")
    return pairs.unionByName(more).distinct()


def within_band(a: list[str], b: list[str], edits: int = EDITS) -> np.ndarray:
    """Whether each pair of texts is at most so many edits apart.

    Row i of the band has one bit for each of 2 * edits + 1 diagonals and each error count e:
    whether the first i characters of a are within e edits of as many of b, less or more. All
    pairs advance together, a character of a at a time, after equal ends are taken off.
    """
    out = np.zeros(len(a), bool)
    cores, order = [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if abs(len(x) - len(y)) > edits:
            continue
        x, y = (np.frombuffer(z.encode("utf-32-le"), np.uint32) for z in (x, y))
        n = min(len(x), len(y))
        differ = x[:n] != y[:n]
        head = int(differ.argmax()) if differ.any() else n
        x, y = x[head:], y[head:]
        n = min(len(x), len(y))
        differ = x[len(x) - n :][::-1] != y[len(y) - n :][::-1]
        tail = int(differ.argmax()) if differ.any() else n
        cores.append((x[: len(x) - tail], y[: len(y) - tail]))
        order.append(i)
    ranked = sorted(range(len(order)), key=lambda j: len(cores[j][0]))
    while ranked:
        width = len(cores[ranked[-1]][0]) + 2 * edits + 1
        n = max(1, CELLS // width)
        part, ranked = ranked[-n:], ranked[:-n]
        out[[order[j] for j in part]] = _band([cores[j] for j in part], width, edits)
    return out


def _band(cores: list[tuple[np.ndarray, np.ndarray]], width: int, edits: int) -> np.ndarray:
    one = np.uint64(1)
    x = np.full((len(cores), width), 0xFFFFFFFF, np.uint32)
    # Diagonal d of row i looks at character i + d of the other text.
    y = np.full((len(cores), width + 2 * edits + 1), 0xFFFFFFFE, np.uint32)
    for j, (own, other) in enumerate(cores):
        x[j, : len(own)] = own
        y[j, edits : edits + min(len(other), width + edits)] = other[: width + edits]
    size = np.array([len(own) for own, _ in cores])
    last = np.array([len(other) for _, other in cores]) - size + edits
    full = np.uint64((1 << (2 * edits + 1)) - 1)
    state = [
        np.full(len(cores), ((1 << (e + 1)) - 1) << edits, np.uint64) & full
        for e in range(edits + 1)
    ]
    near = np.zeros(len(cores), bool)
    for i in range(int(size.max()) + 1):
        done = size == i
        near[done] = (state[edits][done] >> last[done].astype(np.uint64)) & one > 0
        same = np.zeros(len(cores), np.uint64)
        if i == int(size.max()):
            break
        for d in range(2 * edits + 1):
            same |= (x[:, i] == y[:, i + d]).astype(np.uint64) << np.uint64(d)
        new = []
        for e in range(edits + 1):
            row = state[e] & same
            if e:
                row |= state[e - 1] | (state[e - 1] >> one) | (new[e - 1] << one)
            new.append(row & full)
        state = new
    return near


def _line_id(line: str) -> Column:
    """Two hashes, so that lines of a very large table don't share an id."""
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"))


def links(docs: DataFrame, text: str) -> DataFrame:
    """Edges (u, v) between the ids of different lines that few edits join."""
    common.ready(docs.sparkSession)
    pairs = common.written(candidates(docs, text), "candidates")
    wanted = pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h")))
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line"))
    lines = lines.where(F.char_length("line") >= MIN_CHARS).select(
        F.xxhash64("line").alias("h"), "line"
    )
    texts = common.written(lines.join(wanted.distinct(), "h", "left_semi").distinct(), "texts")
    one = texts.select(F.col("h").alias("a"), F.col("line").alias("x"))
    two = texts.select(F.col("h").alias("b"), F.col("line").alias("y"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = within_band(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            yield batch.filter(pa.array(near))

    joined = pairs.join(one, "a").join(two, "b").select("x", "y")
    near = joined.mapInArrow(verify, "x string, y string")
    return near.select(_line_id("x").alias("u"), _line_id("y").alias("v")).distinct()


def duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", short: bool = False
) -> DataFrame:
    """(id, digest, removed) of documents that lose lines; removed has their numbers from 0.

    digest is the hash of the text by which rows of one id are told apart.
    """
    roots = components(links(docs, text)).select(F.col("node").alias("line"), "root")
    lines = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("digest"),
        F.posexplode(F.split(text, "\n")).alias("number", "value"),
    ).where((F.char_length("value") >= MIN_CHARS) | (F.col("value").rlike(WORD) & F.lit(short)))
    lines = common.written(
        lines.select("id", "digest", "number", _line_id("value").alias("line")), "lines"
    )
    place = F.struct("id", "digest", "number")
    first = lines.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.join(roots, "line", "left")
    # Lines that occur once and are like no other need no further look.
    first = common.written(first.where("n > 1 or root is not null"), "repeated")
    first = first.withColumn("root", F.coalesce("root", "line"))
    stays = common.written(first.groupBy("root").agg(F.min("first").alias("stays")), "stays")
    of_line = first.select("line", "root").join(stays, "root").select("line", "stays")
    gone = lines.join(of_line, "line").where(~place.eqNullSafe(F.col("stays")))
    return gone.groupBy("id", "digest").agg(
        F.array_sort(F.collect_set("number")).alias("removed")
    )


def judged(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", short: bool = False
) -> DataFrame:
    """(id, n_lines, n_removed, removed) of every row; texts stay where they are."""
    found = duplicates(docs, id_column, text, short)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("digest"),
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"),
    )
    none = F.array().cast("array<int>")
    return rows.join(found, _same(rows, found), "left").select(
        rows["id"].alias(id_column),
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", none).alias("removed"),
    )


def _same(left: DataFrame, right: DataFrame) -> Column:
    return (left["digest"] == right["digest"]) & left["id"].eqNullSafe(right["id"])


def apply(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", short: bool = False
) -> DataFrame:
    """The documents without the lines that go; a document that loses all its words goes."""
    found = duplicates(docs, id_column, text, short)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("digest"),
        F.col(text).alias("whole"),
    )
    rows = rows.join(found, _same(rows, found), "left")
    kept = F.filter(F.split("whole", "\n"), lambda _, i: ~F.array_contains("removed", i))
    left = F.when(F.col("removed").isNull(), F.col("whole")).otherwise(F.array_join(kept, "\n"))
    rows = rows.select("row", "removed", left.alias("left"))
    emptied = F.col("removed").isNotNull() & ~F.col("left").rlike(WORD)
    columns = [
        F.col("left").alias(name) if name == text else F.col("row")[name].alias(name)
        for name in docs.columns
    ]
    return rows.where(~emptied).select(*columns)
