"""Toxicity by cumulative-link ordinal regression over sparse text features.

A document's severity is one of K + 1 ordered grades. For each threshold k the model has
P(grade >= k) = logistic(w . x - b_k) with one weight vector for all thresholds and b_1 <= b_2
<= ... The expected severity is the sum of these probabilities.

Features are words and the four-, five- and six-byte beginnings of words, letters a to z in
lower case, hashed into ``BUCKETS``. Of the buckets, the ``FEATURES`` that mark graded documents
best are used; x holds log(1 + count) for each of them.

The model is fitted on a sample of labelled rows: by a hash of the id, at most ``SAMPLE_ROWS``
rows with grade 0 and as many with a higher one, none of more than ``SAMPLE_BYTES`` bytes.
Grades come with the labels, or from 0/1 labels by ``grades``: marked rows are mild or severe.
Every document is scored over its whole text.

Null or empty texts have no features and get the severity of an empty text. Labels without a
document, null labels and null ids are ignored, repeated labels of a document count by their
greatest. Without both clean and toxic labels nothing can be learned, and every severity is 0.
Other columns pass through as asked; columns of the names added here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm import common
from souk.llm.winnowing import FOLD, WORD

BUCKETS = 1 << 20
FEATURES = 1024
BEGINNINGS = (4, 5, 6)
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 20_000
# Evidence that a feature marks graded documents: those that have it, times the logarithm of
# how much more frequent it is in them than in clean ones, and the least such ratio
MIN_EVIDENCE = 15.0
MIN_LIFT = 5.0
# Weight of the squared weights in what is minimised
L2 = 1e-5
# A document is toxic if grade 1 or more is at least as likely as not.
TOXIC_PROBABILITY = 0.5


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature that occurs in the texts, repeats included."""
    data, offsets = common.flat(column)
    data = FOLD[data]
    starts, ends = common.runs(WORD[data], offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    hashes = common.Substrings(data)
    found = [(text, hashes(starts, ends))]
    for size in BEGINNINGS:
        long = np.flatnonzero(ends - starts > size)
        first = starts[long]
        # Another constant for each size keeps beginnings apart from whole words.
        found.append((text[long], hashes(first, first + size) * np.uint64(2 * size + 1)))
    texts = np.concatenate([x[0] for x in found])
    buckets = np.concatenate([x[1] for x in found]) >> np.uint64(64 - 20)
    return texts, buckets.astype(np.int64)


def _slices(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, number, text, bucket) of slices of the texts, so that features of few texts
    are held at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    first = 0
    for part in common.steps(batch, "text"):
        yield first, part.num_rows, *features(part.column(0))
        first += part.num_rows


def counts(texts: list[str], chosen: np.ndarray) -> np.ndarray:
    """How often each chosen feature occurs in each text."""
    place = places(chosen)
    out = np.zeros((len(texts), len(chosen)), np.float32)
    for first, n, text, bucket in _slices(texts):
        own = place[bucket]
        at = text[own >= 0] * len(chosen) + own[own >= 0]
        out[first : first + n] = np.bincount(at, minlength=n * len(chosen)).reshape(n, -1)
    return out


def places(chosen: np.ndarray) -> np.ndarray:
    """For each bucket its place among the chosen ones, or -1."""
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    return place


def choose(texts: list[str], marked: np.ndarray) -> np.ndarray:
    """The buckets that are in more of the marked texts than of the others, best first."""
    inside, outside = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for first, n, text, bucket in _slices(texts):
        pairs = np.unique(text * BUCKETS + bucket)
        text, bucket = pairs // BUCKETS, pairs % BUCKETS
        own = marked[first : first + n][text]
        inside += np.bincount(bucket[own], minlength=BUCKETS)
        outside += np.bincount(bucket[~own], minlength=BUCKETS)
    rate_in = inside / max(1, marked.sum())
    rate_out = (outside + 0.5) / (max(1, (~marked).sum()) + 1)
    held = np.flatnonzero(inside)
    evidence = inside[held] * np.log(rate_in[held] / rate_out[held])
    good = np.flatnonzero((evidence >= MIN_EVIDENCE) & (rate_in[held] >= MIN_LIFT * rate_out[held]))
    return held[good[np.argsort(-evidence[good], kind="stable")[:FEATURES]]]


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    place: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...; a row for each score."""
        return logistic(scores[:, None] - self.cuts[None, :])

    def score(self, column: pa.Array) -> np.ndarray:
        texts, buckets = features(column)
        own = self.place[buckets]
        chosen = own >= 0
        pairs, times = np.unique(
            texts[chosen] * len(self.weights) + own[chosen], return_counts=True
        )
        at = pairs // max(1, len(self.weights)), pairs % max(1, len(self.weights))
        return np.bincount(
            at[0], np.log1p(times) * self.weights[at[1]], minlength=len(column)
        )


def fit(texts: list[str], grades: list[int], rounds: int = 300, rate: float = 0.1) -> Model:
    """Maximises the penalised likelihood by Adam; cuts are a first one and positive gaps."""
    grade = np.asarray(grades)
    top = int(grade.max(initial=0))
    if top < 1 or not (grade == 0).any():
        return Model(np.full(BUCKETS, -1), np.zeros(1), np.zeros(0))
    chosen = choose(texts, grade > 0)
    width = len(chosen)
    x = np.log1p(counts(texts, chosen))
    weight = np.full(len(grade), 1 / len(grade))
    state = np.concatenate([np.zeros(width), [1.0], np.full(top - 1, 0.5)])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    rows = np.arange(len(grade))
    for step in range(1, rounds + 1):
        gaps = np.exp(state[width + 1 :])
        cuts = state[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        p = logistic((x @ state[:width].astype(np.float32))[:, None] - cuts)
        # P(grade = g) is the difference of neighbouring cumulative probabilities.
        padded = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
        own = np.maximum(padded[rows, grade] - padded[rows, grade + 1], 1e-9)
        slope = padded * (1 - padded)
        by_score = -(slope[rows, grade] - slope[rows, grade + 1]) / own * weight
        by_cut = np.zeros((len(p), top + 2))
        by_cut[rows, grade] += slope[rows, grade] / own * weight
        by_cut[rows, grade + 1] -= slope[rows, grade + 1] / own * weight
        cut_slope = by_cut.sum(axis=0)[1 : top + 1]
        gradient = np.concatenate(
            [
                x.T @ by_score.astype(np.float32) + L2 * state[:width],
                [cut_slope.sum()],
                gaps * np.cumsum(cut_slope[::-1])[::-1][1:],
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        state = state - rate * move
    gaps = np.exp(state[width + 1 :])
    cuts = state[width] + np.concatenate([[0.0], np.cumsum(gaps)])
    return Model(places(chosen), state[:width], cuts)


def grades(texts: list[str], toxic: list[int]) -> list[int]:
    """Grades 0, 1 and 2 for 0/1 labels: a toxic text is severe if it has more features that
    mark toxic texts than the median of the toxic texts."""
    marked = np.asarray(toxic) > 0
    hits = counts(texts, choose(texts, marked)).sum(axis=1)
    middle = np.median(hits[marked]) if marked.any() else 0
    return (marked.astype(int) + (marked & (hits > middle))).tolist()


def sample(docs: DataFrame, labels: DataFrame, label: str, id_column: str, text: str):
    """(text, label) of the bounded sample, in order of a hash of the id."""
    graded = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
    graded = graded.groupBy(id_column).agg(F.max(label).cast("int").alias("grade"))
    texts = docs.where(F.octet_length(text) <= SAMPLE_BYTES).select(
        id_column, F.col(text).alias("text")
    )
    known = texts.select(id_column).join(graded, id_column).distinct()
    order = [F.xxhash64(F.col(id_column)), F.col(id_column)]
    parts = [
        known.where(which).orderBy(*order).limit(SAMPLE_ROWS) for which in ("grade = 0", "grade > 0")
    ]
    # At most 2 * SAMPLE_ROWS ids, so the texts are never shuffled.
    ids = F.broadcast(parts[0].unionByName(parts[1]))
    rows = texts.join(ids, id_column).groupBy(id_column).agg(
        F.min("text").alias("text"), F.first("grade").alias("grade")
    )
    found = sorted(rows.collect(), key=lambda row: str(row[id_column]))
    return [row.text for row in found], [row.grade for row in found]


ADDED = "severity double, p_toxic double, toxic boolean"


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None):
    """The documents with severity, p_toxic and toxic."""
    common.ready(docs.sparkSession)
    docs = docs.drop("severity", "p_toxic", "toxic")
    names = docs.columns if keep is None else keep
    schema = StructType([docs.schema[name] for name in names] + StructType.fromDDL(ADDED).fields)
    sent = docs.sparkSession.sparkContext.broadcast((model.place, model.weights, model.cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            for part in common.steps(batch, text):
                above = own.above(own.score(part.column(text)))
                severity = above.sum(axis=1)
                p = above[:, 0] if above.shape[1] else np.zeros(len(above))
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in names]
                    + [pa.array(severity), pa.array(p), pa.array(p >= TOXIC_PROBABILITY)],
                    names=schema.names,
                )

    wanted = list(dict.fromkeys([*names, text]))
    return docs.select(*wanted).mapInArrow(run, schema)


def trained(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_column: str = "doc_id",
    text: str = "text",
) -> Model:
    """The model of the sample; labels above 1 are grades, 0/1 labels are graded here."""
    texts, found = sample(docs, labels, label, id_column, text)
    if not found:
        return fit([], [])
    return fit(texts, found if max(found) > 1 else grades(texts, found))
