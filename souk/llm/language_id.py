"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the vectors of its subwords: all runs of ``SIZES`` UTF-8 bytes inside
its words, with a blank on either side of a word, hashed to ``BUCKETS`` vectors. Vectors and
softmax are fitted together by stochastic gradient descent in numpy, on short and long pieces of
a bounded sample of labelled rows: at most ``SAMPLE_ROWS`` rows (the same number for each language,
the most frequent ``MAX_LANGS`` of them), and of each one piece of ``PIECE`` characters from any place.

Every fifth row of the sample is held back from the fit and calibrates it: the temperature that
makes the probabilities right on them divides the logits, and the least score at which at most
``MAX_ERROR`` of those accepted are wrong becomes the threshold. Texts scored below are
``rejected``; their likeliest language is given all the same.

Texts are scored whole, in slices. Null texts and those without a letter are ``und``, score 0 and
rejected, and so are all texts if there is no labelled row. Rows without an id or a language
teach nothing. A text that many rows have is one row of the sample. Repeated rows count each in
the result, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm import common

SIZES = (2, 3, 4, 5)
BUCKETS = 1 << 16
DIMENSION = 16
SAMPLE_ROWS = 4000
MAX_LANGS = 250
PIECE = 1000
# Pieces that a sampled text is also learned from, and their bytes
SHORT_PIECES = 2
SHORT_BYTES = (15, 120)
ROUNDS = 4
RATE = 0.5
HELD_BACK = 5
MAX_ERROR = 0.01
UNKNOWN = "und"
SEED = 17
# Texts of the sample whose subwords are counted at once
EXAMPLES = 256

# Lower case for A-Z; all that is no letter by bytes is a blank.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[128:] = np.arange(128, 256)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of all subwords of the texts, size by size, in order of text."""
    padded = np.insert(_LETTERS[data], offsets, 32)
    offsets = offsets + np.arange(len(offsets))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    blanks = np.concatenate([[0], np.cumsum(padded == 32)])
    code = padded.astype(np.uint64)
    for size in range(2, max(SIZES) + 1):
        n = len(padded) - size + 1
        if n <= 0:
            return
        code = code[:n] * np.uint64(257) + padded[size - 1 :].astype(np.uint64) + np.uint64(1)
        if size not in SIZES:
            continue
        if size == 2:
            inside = (padded[:n] != 32) | (padded[1:] != 32)
        else:
            inside = blanks[size - 1 : size - 1 + n] == blanks[1 : 1 + n]
        at = np.flatnonzero(inside)
        # The last byte of a text's part is the blank before the next.
        mixed = (code[at] * _SPREAD) >> np.uint64(64 - BUCKETS.bit_length() + 1)
        yield mixed.astype(np.int64), text[np.minimum(at, len(text) - 1)]


@dataclass
class Model:
    langs: list[str]
    # Vectors of the buckets, and the linear layer over them
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row for each text. Sums are made of whichever is narrower, logits or vectors."""
        narrow = len(self.langs) <= self.vectors.shape[1]
        table = self.vectors @ self.weights if narrow else self.vectors
        sums = np.zeros((len(offsets) - 1, table.shape[1]))
        n = np.zeros(len(offsets) - 1)
        for bucket, text in subwords(data, offsets):
            if not len(bucket):
                continue
            first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            sums[text[first]] += np.add.reduceat(table[bucket], first, axis=0)
            n += np.bincount(text, minlength=len(n))
        means = sums / np.maximum(n, 1)[:, None]
        return (means if narrow else means @ self.weights) + self.bias

    def scores(self, logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language of each row and its calibrated probability."""
        p = softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def examples(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, share of the subwords) of each text, a few texts at a time."""
    made = []
    for start in range(0, len(texts), EXAMPLES):
        made += _examples(texts[start : start + EXAMPLES])
    return made


def _examples(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    data, offsets = joined(texts)
    parts = list(subwords(data, offsets))
    if not parts:
        return [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * len(texts)
    bucket, text = (np.concatenate(x) for x in zip(*parts))
    # Equal subwords of a text become one with their share.
    key, n = np.unique(text * BUCKETS + bucket, return_counts=True)
    cuts = np.searchsorted(key // BUCKETS, np.arange(1, len(texts)))
    total = np.maximum(np.bincount(text, minlength=len(texts)), 1)
    share = (n / total[key // BUCKETS]).astype(np.float32)
    return list(zip(np.split((key % BUCKETS).astype(np.int32), cuts), np.split(share, cuts)))


def pieces(texts: list[bytes], rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """Each text and a few short pieces of it, and the number of the text each is from."""
    out, of = [], []
    for i, text in enumerate(texts):
        out.append(text)
        for size in rng.integers(*SHORT_BYTES, SHORT_PIECES):
            start = int(rng.integers(0, max(1, len(text) - int(size))))
            out.append(text[start : start + int(size)])
        of += [i] * (1 + SHORT_PIECES)
    return out, np.asarray(of, np.int64)


def descended(own: list, grade: np.ndarray, langs: list[str]) -> Model:
    """Vectors and softmax after ``ROUNDS`` rounds of descent, example by example."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION)).astype(np.float32)
    weights = np.zeros((DIMENSION, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps, done = ROUNDS * len(own), 0
    for _ in range(ROUNDS):
        for i in rng.permutation(len(own)):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            bucket, share = own[i]
            mean = share @ vectors[bucket]
            x = mean @ weights + bias
            wrong = np.exp(x - x.max())
            wrong /= wrong.sum()
            wrong[grade[i]] -= 1
            back = weights @ wrong
            weights -= rate * np.outer(mean, wrong)
            bias -= rate * wrong
            # An example's vectors share its slope, so the rate is that of their average.
            vectors[bucket] -= rate * (share / max(float(share @ share), 1e-9))[:, None] * back
    return Model(langs, vectors.astype(np.float64), weights.astype(np.float64), bias.astype(np.float64))


def calibrated(model: Model, texts: list[bytes], grade: np.ndarray) -> Model:
    """The model with temperature and threshold from texts that it was not fitted on."""
    if not texts:
        return model
    logits = model.logits(*joined(texts))
    rows = np.arange(len(grade))
    losses = {
        t: -np.log(np.maximum(softmax(logits / t)[rows, grade], 1e-12)).mean()
        for t in np.geomspace(0.25, 16, 49).tolist()
    }
    model.temperature = min(losses, key=losses.get)
    best, score = model.scores(logits)
    order = np.argsort(-score, kind="stable")
    wrong = np.cumsum(best[order] != grade[order]) / np.arange(1, len(order) + 1)
    # Only between different scores can a threshold lie.
    last = np.append(score[order][1:] < score[order][:-1], True)
    good = np.flatnonzero(last & (wrong <= MAX_ERROR))
    model.threshold = float(score[order][good[-1]]) if len(good) else 1.0
    return model


def fit(texts: list[bytes], langs: list[str]) -> Model:
    known = sorted(set(langs), key=str.encode)
    if not known:
        none = np.zeros((BUCKETS, DIMENSION))
        return Model([], none, np.zeros((DIMENSION, 0)), np.zeros(0))
    place = {lang: i for i, lang in enumerate(known)}
    own, of = pieces(texts, np.random.default_rng(SEED))
    grade = np.asarray([place[lang] for lang in langs], np.int64)[of]
    back = of % HELD_BACK == HELD_BACK - 1
    made = examples(own)
    learned = [i for i in np.flatnonzero(~back) if len(made[i][0])]
    model = descended([made[i] for i in learned], grade[learned], known)
    # Whole pieces alone are like the rows that the threshold is for.
    held = [i for i in np.flatnonzero(back) if len(made[i][0]) and i % (1 + SHORT_PIECES) == 0]
    return calibrated(model, [own[i] for i in held], grade[held])


def remainder(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 4


def sample(docs: DataFrame, lang: str, id_column: str, text: str) -> tuple[list[bytes], list[str]]:
    """Pieces of texts and their languages, in order of a hash: at most ``SAMPLE_ROWS`` rows."""
    rows = docs.select(
        remainder(id_column).alias("part"), F.col(lang).alias("lang"), F.col(text).alias("text")
    ).where("part <> 2 and lang is not null and text is not null").drop("part")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.orderBy(F.desc("rows"), "lang").limit(MAX_LANGS).collect()
    if not sizes:
        return [], []
    each = max(1, SAMPLE_ROWS // len(sizes))
    # Twice the share wanted by a hash of the text; what is more goes by the order of the hash.
    shares = [(row.lang, min(1.0, 2 * each / row["rows"]) * 2**32) for row in sizes]
    limits = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))
    h = F.xxhash64("text")
    size = F.greatest(F.char_length("text") - PIECE, F.lit(0))
    piece = F.substr(F.col("text"), (F.pmod(h, size + 1) + 1).cast("int"), F.lit(PIECE))
    chosen = (
        rows.join(limits, "lang")
        .where(F.pmod(h, F.lit(2**32)) < F.col("share"))
        .select("lang", h.alias("h"), piece.cast("binary").alias("piece"))
        .groupBy("lang", "h")
        .agg(F.min("piece").alias("piece"))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    found = chosen.withColumn("place", place).where(F.col("place") <= each).orderBy("h", "lang").collect()
    return [bytes(row.piece) for row in found], [row.lang for row in found]


def trained(docs: DataFrame, lang: str = "lang", id_column: str = "doc_id", text: str = "text") -> Model:
    """The model of the labelled rows whose id has no CRC-32 of remainder 2 by 4."""
    common.ready(docs.sparkSession)
    return fit(*sample(docs, lang, id_column, text))


ADDED = "held_out boolean, lang_pred string, score double, rejected boolean"


def predicted(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) of every row."""
    common.ready(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(remainder(id_column) == 2, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
        F.col(text).alias("text"),
    )
    schema = StructType([rows.schema["id"], *StructType.fromDDL(ADDED).fields])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        names = np.asarray([*own.langs, UNKNOWN], object)
        for batch in batches:
            for part in common.steps(batch, "text"):
                letters = part.column("letters").to_numpy(zero_copy_only=False) & bool(own.langs)
                best, score = np.full(len(letters), len(own.langs)), np.zeros(len(letters))
                if letters.any():
                    found, p = own.scores(own.logits(*common.flat(part.column("text"))))
                    best, score = np.where(letters, found, best), np.where(letters, p, score)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("held_out"),
                        pa.array(names[best], pa.string()),
                        pa.array(score),
                        pa.array(~letters | (score < own.threshold)),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)
