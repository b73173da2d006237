"""Shared by the operators: written tables, Arrow columns as byte arrays, word runs and hashes."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from souk.session import shared_folder

# Bytes of text that one step of array work covers; a longer text is a step of its own.
STEP_BYTES = 1 << 20
# Rows an Arrow batch may hold, so that a batch of long texts stays small.
BATCH_ROWS = 1000

BASE = np.uint64(0x9E3779B97F4A7C15)


_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Bounds Arrow batches, and gives Python workers this package from the shared folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}/{package.name}.zip"
    out = _delete_at_end(spark, path).create(context._jvm.org.apache.hadoop.fs.Path(path))
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def _delete_at_end(spark: SparkSession, path: str):
    """The file system of a path that is deleted when the application ends."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.deleteOnExit(hadoop_path)
    return system


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows as a table in the cluster's shared folder, deleted when the application ends.

    With ``by``, each value of that column has a folder of its own. Later steps read the files, so a lost executor costs a re-read and nothing is computed twice.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}/{name}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    _delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into slices of at most ``limit`` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    row = 0
    while row < len(sizes):
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(row, stop - row)
        row = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, and the offset of each; a null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends where its text ends."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joins = inside.copy()
    joins[1:] &= inside[:-1]
    joins[0] = False
    first = offsets[:-1]
    joins[first[first < len(inside)]] = False
    starts = np.flatnonzero(inside & ~joins)
    last = inside.copy()
    last[:-1] &= ~joins[1:]
    return starts, np.flatnonzero(last) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the odd hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        size = max(n + 1, STEP_BYTES + 1)
        kept = []
        for base in (BASE, inverse):
            steps_ = np.full(size, base, np.uint64)
            steps_[0] = 1
            kept.append(np.multiply.accumulate(steps_))
        if n > 4 * STEP_BYTES:
            return kept[0], kept[1]
        _powers["up"], _powers["down"] = kept
    return _powers["up"], _powers["down"]


class Substrings:
    """Hashes of any byte ranges of one array, from prefix sums; equal bytes, equal hash."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data))
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for every k hashes in a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * BASE + hashes[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have : width - have + n])

