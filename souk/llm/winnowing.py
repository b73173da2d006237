"""Benchmark decontamination by winnowing.

Of every 13 words in a row, the 9 hashes of 5 words are looked at and the least is kept as a
fingerprint. Equal 13 words keep equal fingerprints, so every shared span of 13 words or more
meets in the join of training and test fingerprints. A meeting is extended word by word to the
longest shared span, which makes hits exact whatever the hashes do.

Items of fewer than 13 words are one window. Of those, the least 5-word hash (for under 5
words: the hash of all) is looked for among all such hashes of a document.

The test side is read in blocks of at most ``BLOCK_BYTES`` of text, whatever its size: each
block is sent to the tasks and meets every document, so documents are never shuffled.

Null or empty texts have no words, no hits and are clean. Repeated rows are judged alike, each
on its own. Items without words are left out. An item without an id counts like any other, but
has no place in the list of ids. Other columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm import common

# Words in a window, and in a hashed gram
WINDOW = 13
GRAM = 5
# Text of test items that one pass over the documents looks for
BLOCK_BYTES = 16 * 1024 * 1024
# A document is contaminated if at least one word in so many is hit.
HIT_SHARE = 20

_codes = np.arange(256)
FOLD = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 0x20, _codes).astype(np.uint8)
WORD = (
    ((_codes >= 0x30) & (_codes <= 0x39))
    | ((_codes >= 0x41) & (_codes <= 0x5A))
    | ((_codes >= 0x61) & (_codes <= 0x7A))
    | (_codes >= 0x80)
)


def word_runs(data: np.ndarray, offsets: np.ndarray):
    """Folded bytes; start, end and hash of every word; and the first word of each text."""
    data = FOLD[data]
    starts, ends = common.runs(WORD[data], offsets)
    hashes = common.Substrings(data)(starts, ends)
    return data, starts, ends, hashes, np.searchsorted(starts, offsets)


class TestIndex:
    """Fingerprints of test items and where in which item they stand."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.ids: list[object] = []
        self.words: list[list[bytes]] = []
        # Fingerprints by kind: 0 for windows of full length, else the gram length of short items
        found: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            raw = np.frombuffer(text, np.uint8)
            data, starts, ends, hashes, _ = word_runs(raw, np.array([0, len(raw)]))
            if not len(starts):
                continue
            item = len(self.ids)
            self.ids.append(item_id)
            folded = data.tobytes()
            self.words.append([folded[a:b] for a, b in zip(starts, ends)])
            k = min(GRAM, len(starts))
            grams = common.grams(hashes, k)
            if len(starts) >= WINDOW:
                kind, kept = 0, common.sliding_min(grams, WINDOW - GRAM + 1)
            else:
                kind, kept = k, common.sliding_min(grams, len(grams))
            for place in np.flatnonzero(np.isin(grams, kept)).tolist():
                found[kind][int(grams[place])].append((item, place))
        self.kinds = {}
        for kind, places in found.items():
            keys = np.array(sorted(places), np.uint64)
            self.kinds[kind] = keys, [places[int(key)] for key in keys]

    def meetings(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, list]]:
        """(word, test places) of every fingerprint of the texts that test items have too."""
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for kind, (keys, places) in self.kinds.items():
            k = kind or GRAM
            grams = common.grams(hashes, k)
            if not len(grams):
                continue
            whole = text_of[: len(grams)] == text_of[k - 1 :]
            if kind:
                at = np.flatnonzero(whole)
            else:
                at = self._fingerprints(grams, whole, text_of)
            where = np.searchsorted(keys, grams[at])
            where[where == len(keys)] = 0
            for i in np.flatnonzero(keys[where] == grams[at]).tolist():
                yield int(at[i]), places[where[i]]

    @staticmethod
    def _fingerprints(grams: np.ndarray, whole: np.ndarray, text_of: np.ndarray) -> np.ndarray:
        """Positions whose gram is the least of some window; grams across texts never are."""
        width = WINDOW - GRAM + 1
        least = common.sliding_min(grams, width)
        if not len(least):
            return np.zeros(0, np.int64)
        least = np.where(text_of[: len(least)] == text_of[WINDOW - 1 :], least, np.uint64(0))
        kept = np.zeros(len(grams), bool)
        for j in range(width):
            kept[j : j + len(least)] |= grams[j : j + len(least)] == least
        return np.flatnonzero(kept & whole)

    def hits(self, data, starts, ends, hashes, first):
        """For each text the hit spans of words, [from, to), and the items found in it."""
        spans: list[list[tuple[int, int]]] = [[] for _ in first[:-1]]
        items: list[set[int]] = [set() for _ in first[:-1]]
        seen: dict[tuple[int, int], int] = {}
        folded = None
        for word, places in self.meetings(hashes, first):
            folded = folded or data.tobytes()
            text = int(np.searchsorted(first, word, "right")) - 1
            low, high = int(first[text]), int(first[text + 1])
            for item, place in places:
                # On one diagonal of text and item, a span is extended once.
                if seen.get((word - place, item), -1) >= word:
                    continue
                other = self.words[item]
                need = min(WINDOW, len(other))
                a, b = word, word
                while a > low and a - word + place > 0 and (
                    folded[starts[a - 1] : ends[a - 1]] == other[a - 1 - word + place]
                ):
                    a -= 1
                while b < high and b - word + place < len(other) and (
                    folded[starts[b] : ends[b]] == other[b - word + place]
                ):
                    b += 1
                seen[word - place, item] = b - 1 if b > word else word
                if b - a >= need:
                    spans[text].append((a - low, b - low))
                    items[text].add(item)
        return spans, items


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as spans in order that don't touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """The test items in parts of about ``BLOCK_BYTES``, dealt by a hash of id and text."""
    rows = benchmark.where(F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("id"), F.col(text).cast("binary").alias("text")
    )
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size")).first()["size"]
    n = -(-size // BLOCK_BYTES)
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block)
        yield [(row.id, bytes(row.text)) for row in part.collect()]


FOUND = "n_words long, hit_spans array<struct<start:int,stop:int>>, items array<string>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The documents with n_words, hit_spans (words, end exclusive), items, n_hit, contaminated.

    Item ids are strings in order, each once. Columns of these names are replaced. ``keep``
    names the columns of the documents to return, all if None.
    """
    spark = docs.sparkSession
    common.ready(spark)
    docs = docs.drop("n_words", "hit_spans", "items", "n_hit", "contaminated")
    names = docs.columns if keep is None else keep
    out, test = docs, None
    for block in blocks(benchmark, item_id, item_text):
        if test is not None:
            # One pass at a time, so that a task never holds the index of two blocks.
            out = common.written(_one_pass(out, docs, docs.columns, text, test), "pass")
        test = TestIndex(block)
    out = _one_pass(out, docs, names, text, test or TestIndex([]))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def _one_pass(
    out: DataFrame, docs: DataFrame, names: list[str], text: str, test: TestIndex
) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(test)
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    before = "hit_spans" in out.columns

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = index.value
        for batch in batches:
            for part in common.steps(batch, text):
                data, offsets = common.flat(part.column(text))
                found = word_runs(data, offsets)
                first = found[-1]
                spans, items = test.hits(*found)
                ids = [{test.ids[i] for i in own} - {None} for own in items]
                if before:
                    for i, own in enumerate(part.column("hit_spans").to_pylist()):
                        spans[i] += [(x["start"], x["stop"]) for x in own]
                    for i, own in enumerate(part.column("items").to_pylist()):
                        ids[i] |= set(own)
                pairs = [[{"start": a, "stop": b} for a, b in union(own)] for own in spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in names]
                    + [
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(pairs, span),
                        pa.array([sorted(own) for own in ids], pa.list_(pa.string())),
                    ],
                    names=[*names, "n_words", "hit_spans", "items"],
                )

    schema = StructType([docs.schema[name] for name in names] + StructType.fromDDL(FOUND).fields)
    return out.mapInArrow(find, schema)
