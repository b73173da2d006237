"""Session settings the models rely on, and the shared folder for written tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

# Run-time settings, safe to apply to a session somebody else created.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join key may hold a large share of all rows. AQE splits such shuffle partitions,
    # and does so even where the split costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Whether a query's shuffle files go as soon as it ends. Without it they stay until the driver
# happens to collect its garbage.
DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes: dict[SparkSession, tuple[int, str | None]] = {}
_counting = Lock()

MB = 1024 * 1024
# Input one shuffle partition should stand for: little, as rows take many times the bytes of
# their Parquet files when they are sorted. Beyond a number of partitions, they get larger.
SHUFFLE_BYTES = 8 * MB
MANY_PARTITIONS = 8192
MOST_SHUFFLE_BYTES = 128 * MB
# Input of one scan task
SCAN_BYTES = 128 * MB
# Shuffled bytes of a task that writes rebalanced rows
LEAST_REBALANCED, MOST_REBALANCED = 4 * MB, 64 * MB


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Total size of the files below a folder, from their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.selectExpr("coalesce(sum(length), 0) as size").first()["size"]


def partition_sizes(size: int, partitions: int) -> dict[str, str]:
    """Settings for an input of this many bytes, given the session's shuffle partitions.

    AQE merges shuffle partitions that turn out small but splits none that turn out large
    (skewed joins aside), so a shuffle starts with many.
    """
    wanted = max(min(-(-size // SHUFFLE_BYTES), MANY_PARTITIONS), -(-size // MOST_SHUFFLE_BYTES))
    # A rebalance before a write makes tasks of this size; small tables keep all cores busy.
    rebalanced = min(MOST_REBALANCED, max(LEAST_REBALANCED, size // partitions))
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(rebalanced),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(wanted, partitions)),
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
    }


def shuffle_partitions(spark: SparkSession) -> int:
    """The number that a shuffle starts with."""
    default = spark.conf.get("spark.sql.shuffle.partitions")
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    return int(spark.conf.get(name, None) or default)


def fit_to_input(spark: SparkSession, folder: str) -> None:
    """Size shuffles and scans for the data in a folder."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in partition_sizes(input_bytes(spark, folder), partitions).items():
        spark.conf.set(key, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that are run in here keep no shuffle files.

    Only for writes: a DataFrame that is made in here could not be collected twice without
    computing its shuffles again.
    """
    with _counting:
        running, before = _writes.get(spark) or (0, spark.conf.get(DROPS_SHUFFLES, None))
        _writes[spark] = (running + 1, before)
        spark.conf.set(DROPS_SHUFFLES, "true")
    try:
        yield
    finally:
        with _counting:
            running, before = _writes.pop(spark)
            if running > 1:
                _writes[spark] = (running - 1, before)
            elif before is None:
                spark.conf.unset(DROPS_SHUFFLES)
            else:
                spark.conf.set(DROPS_SHUFFLES, before)


def local_session(cores: int | str = "*", app_name: str = "souk", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        # Recording the call site of every column expression costs more than planning it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it; else one in the warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Has the path deleted when the application ends."""
    target, files = _hadoop(spark, path)
    files.deleteOnExit(target)


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _hadoop(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    target, files = _hadoop(spark, path)
    files.delete(target, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Gives a file or folder another place, in one step where the file system can."""
    source, files = _hadoop(spark, path)
    target, _ = _hadoop(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"{path} could not be renamed to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, files = _hadoop(spark, path)
    out = files.create(target, True)
    out.write(text.encode())
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or nothing where there is none."""
    target, files = _hadoop(spark, path)
    if not files.exists(target):
        return None
    opened = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
