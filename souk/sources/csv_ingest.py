"""Loading raw tables from CSV, with bad records set aside and counted.

Fields are read as text and typed by the staging models. Quoting follows RFC 4180: quotes
inside a quoted field are doubled, and a quoted field may span lines.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk.functions.expressions import half_up
from souk.operators.quality import union_all
from souk.sources.raw_tables import RAW_TABLES, RawTable
from souk.sources.store import TableStore

# Text that a tolerant load reads as a missing value
NA_TOKENS = [
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

RECORD = "_record"
OUTCOME = "_outcome"
# Place of a piece of a record that is too long; 0 for the first, NULL for whole records
PART = "_part"
LOADED, SKIPPED = "loaded", "skipped"

# Bytes of a record of several lines. A longer one, as an unclosed quote makes it, is set aside
# in pieces of this size, so that no task ever holds more.
RECORD_BYTES = 1 << 20


@dataclass(frozen=True)
class Ingested:
    clean: DataFrame
    quarantine: DataFrame
    stats: DataFrame


# One field: quoted if it begins with a quote, else plain text in which quotes mean nothing.
# Every loop is possessive, so long fields neither backtrack nor recurse.
_QUOTED = '"(?:[^"]++|"")*+'
_FIELD = f'(?:{_QUOTED}"[^,]*+|[^",][^,]*+)?+'
_OPEN_AT_END = f"^(?:{_FIELD},)*+{_QUOTED}\\z"
_COUNTED = f"\\G(?:{_FIELD},|{_QUOTED}\\z)"

_BLOCK = ["_file", "_block"]
_CHUNK = [*_BLOCK, "_chunk"]

# A chunk has this many bits' worth of lines at most, so that a window holds no more of them.
CHUNK_BITS = 14


def open_at_end(text: Column) -> Column:
    """Whether the text, read from the start of a field, ends inside a quoted one."""
    return text.rlike(_OPEN_AT_END)


def field_count(record: Column) -> Column:
    """Fields in the text of a record."""
    return F.regexp_count(F.concat(record, F.lit(",")), F.lit(_COUNTED))


def _with_states(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Whether each row begins and ends inside a quoted field, by where its group begins.

    A row turns its beginning into its end by (`_plain`, `_quoted`): where it ends if it begins
    outside, and inside, a quoted field. Rows whose two ends agree settle the state whatever
    came before; after them, only the number of rows that swap the two matters.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order)
    odd_swaps = F.count_if(F.col("_plain") & ~F.col("_quoted")).over(so_far) % 2 == 1
    settled = F.when(F.col("_plain") == F.col("_quoted"), F.col("_plain") != F.col("_odd"))
    df = df.withColumn("_odd", odd_swaps)
    df = df.withColumn("_settled", F.last(settled, ignorenulls=True).over(so_far))
    for start, begin in ((0, F.lit(False)), (1, F.lit(True))):
        end = F.coalesce(F.col("_settled"), begin) != F.col("_odd")
        df = df.withColumn(f"_end{start}", end)
        df = df.withColumn(f"_begin{start}", F.lag(f"_end{start}", 1, bool(start)).over(so_far))
    return df.drop("_odd", "_settled", "_plain", "_quoted")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files with their place, and where each ends for both ways it may begin.

    A block is what one scan task reads of a file, so it is bounded by the scan's split size; a
    chunk is a run of lines of a block.
    """
    value = F.col("value")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    # A line without a quote ends as it begins.
    quote = F.contains(value, F.lit('"'))
    return lines.select(
        *_BLOCK,
        F.shiftright("_line", CHUNK_BITS).alias("_chunk"),
        "_line",
        "value",
        (quote & open_at_end(value)).alias("_plain"),
        (~quote | open_at_end(F.concat(F.lit('"'), value))).alias("_quoted"),
    )


def _chunks(lines: DataFrame) -> DataFrame:
    """One row per chunk, and whether any of its lines may end otherwise than it begins."""
    return lines.groupBy(*_CHUNK).agg(
        F.count(F.lit(1)).alias("_lines"),
        F.min("_line").alias("_first"),
        F.max(F.col("_plain") | ~F.col("_quoted")).alias("_changing"),
    )


def _stated(lines: DataFrame) -> DataFrame:
    """Lines with their state and the records begun, for both ways their chunk may begin."""
    lines = _with_states(lines, _CHUNK, "_line")
    so_far = Window.partitionBy(*_CHUNK).orderBy("_line")
    for start in (0, 1):
        lines = lines.withColumn(
            f"_record{start}", F.count_if(~F.col(f"_begin{start}")).over(so_far)
        )
    return lines


def _borders(chunks: DataFrame, lines: DataFrame) -> DataFrame:
    """Where each chunk begins (in a quoted field or not), the records begun before it in its
    file, and the first line of its block."""
    states = lines.select(*_CHUNK, "_line", "_plain", "_quoted")
    ends = (
        _stated(states.join(chunks.where("_changing"), _CHUNK, "left_semi"))
        .groupBy(*_CHUNK)
        .agg(
            F.max_by("_end0", "_line").alias("_plain"),
            F.max_by("_end1", "_line").alias("_quoted"),
            F.max("_record0").alias("_records0"),
            F.max("_record1").alias("_records1"),
        )
    )
    # A chunk without changes ends as it begins; outside a field, each of its lines is a record.
    chunks = chunks.join(ends, _CHUNK, "left").withColumns(
        {
            "_plain": F.coalesce("_plain", F.lit(False)),
            "_quoted": F.coalesce("_quoted", F.lit(True)),
            "_records0": F.coalesce("_records0", "_lines"),
            "_records1": F.coalesce("_records1", F.lit(0)),
        }
    )
    chunks = _with_states(chunks, ["_file"], "_block", "_chunk")
    begun = F.when(F.col("_begin0"), F.col("_records1")).otherwise(F.col("_records0"))
    earlier = Window.partitionBy("_file").orderBy("_block", "_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return chunks.select(
        *_CHUNK,
        "_first",
        "_changing",
        F.col("_begin0").alias("_inside"),
        F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("_before"),
        F.min("_first").over(Window.partitionBy(*_BLOCK)).alias("_start"),
    )


def lines_table(name: str) -> str:
    return f"{name}_lines"


def chunks_table(name: str) -> str:
    return f"{name}_chunks"


def borders_table(name: str) -> str:
    return f"{name}_borders"


def pieces_table(name: str) -> str:
    return f"{name}_pieces"


def long_table(name: str) -> str:
    return f"{name}_long"


def record_texts(spark: SparkSession, path: str, store: TableStore, name: str) -> DataFrame:
    """The text of every record, headers and blank lines excluded, and its `_part`.

    Files are split whether or not records span lines. Lines are written as they are scanned;
    a pass over one row per chunk of them tells how each chunk begins, and numbers the records.
    Only chunks with quotes, or inside a quoted field, are read for both ways they may begin and
    have their lines brought together, up to `RECORD_BYTES` a record; the text of a longer record
    stays in pieces. The lines of all other chunks are records without a shuffle.
    """
    lines = store.replace(_lines(spark, path), lines_table(name))
    # Written, as small tables are broadcast to the lines and aggregates are not.
    chunks = store.replace(_chunks(lines), chunks_table(name))
    borders = store.replace(_borders(chunks, lines), borders_table(name))
    quoted = F.col("_changing") | F.col("_inside")
    header = (F.col("_before") == 0) & (F.col("_line") == F.col("_first"))
    texts = (
        lines.join(borders.where(~quoted), _CHUNK)
        .where(~header)
        .select(F.col("value").alias("text"), F.lit(None).cast("long").alias(PART))
    )
    texts = texts.unionAll(_pieces(_placed(lines.join(borders.where(quoted), _CHUNK)), store, name))
    return texts.select(F.regexp_replace("text", "\r\\z", "").alias("text"), PART).where(
        F.trim("text") != ""
    )


def _placed(lines: DataFrame) -> DataFrame:
    """Lines of chunks with their borders: the state and the record of each, headers excluded."""
    inside = F.col("_inside")
    return (
        _stated(lines)
        .select(
            *_CHUNK,
            "_line",
            "_start",
            "value",
            F.when(inside, F.col("_begin1")).otherwise(F.col("_begin0")).alias("_begin"),
            F.when(inside, F.col("_end1")).otherwise(F.col("_end0")).alias("_end"),
            (F.col("_before") + F.when(inside, F.col("_record1")).otherwise(F.col("_record0"))).alias(
                "_record"
            ),
            F.sum(F.octet_length("value") + 1)
            .over(Window.partitionBy(*_CHUNK).orderBy("_line"))
            .alias("_bytes"),
        )
        .where("_record > 1")
    )


def _together(parts: Column) -> Column:
    """The text of (place, text) parts in order of place."""
    return F.array_join(F.array_sort(F.collect_list(parts))["text"], "\n").alias("text")


def _pieces(lines: DataFrame, store: TableStore, name: str) -> DataFrame:
    """(text, part) of the records of these lines.

    Lines come together in two steps: those of a record between two multiples of `RECORD_BYTES`
    of a chunk, which takes no shuffle of its own, then those pieces, but for records that are
    whole already or too long. Neither step gathers more than that size, whatever the length of
    a record.
    """
    slot = F.floor(F.col("_bytes") / RECORD_BYTES)
    size = F.octet_length("value") + 1
    line = F.struct(F.col("_line").alias("place"), F.col("value").alias("text"))
    # A record's first line begins, and its last one ends, outside a field.
    ended = F.max(~F.col("_begin")) & F.max(~F.col("_end"))
    every = lines.groupBy(*_CHUNK, "_record", slot.alias("_slot")).agg(
        _together(line),
        # A line has a byte at least, so this is before the place of all in the next block.
        F.min(F.col("_block") + F.col("_line") - F.col("_start")).alias("_place"),
        F.sum(size).alias("_size"),
        (ended & ((F.sum(size) <= RECORD_BYTES) | (F.count(F.lit(1)) == 1))).alias("_whole"),
    )
    every = store.replace(every.drop("_block", "_chunk", "_slot"), pieces_table(name))
    whole = every.where("_whole").select("text", F.lit(None).cast("long").alias(PART))
    pieces = every.where("not _whole").drop("_whole")
    sizes = pieces.groupBy("_file", "_record").agg(
        F.sum("_size").alias("_total"), F.min("_place").alias("_first")
    )
    # Written, as Spark splits the pieces of a very long record only between plain tables.
    too_long = store.replace(sizes.where(F.col("_total") > RECORD_BYTES).drop("_total"), long_table(name))
    marked = pieces.join(too_long, ["_file", "_record"], "left")
    short = (
        marked.where("_first is null")
        .groupBy("_file", "_record")
        .agg(_together(F.struct(F.col("_place").alias("place"), "text")))
        .select("text", F.lit(None).cast("long").alias(PART))
    )
    place = F.when(F.col("_place") == F.col("_first"), 0).otherwise(F.col("_place"))
    long = marked.where("_first is not null").select("text", place.cast("long").alias(PART))
    return whole.unionAll(short).unionAll(long)


def read_records(spark: SparkSession, path: str, store: TableStore, name: str) -> DataFrame:
    """All records as text columns named by the header, plus the text of malformed ones.
    Records that are too long are left out.

    Short records keep their leading fields, long ones their first fields; both carry their
    full text in `_record`, which is NULL for the others.
    """
    texts = record_texts(spark, path, store, name)
    return _parsed(spark, path, texts.where(F.col(PART).isNull()))


def _parsed(spark: SparkSession, path: str, texts: DataFrame) -> DataFrame:
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    names = [column.lstrip("\ufeff") for column in header]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, RECORD])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    fields = F.from_csv("text", schema, options)
    return texts.select(fields.alias("fields")).select("fields.*")


def classified(records: DataFrame, strict: bool) -> DataFrame:
    """The records with their outcome and with missing values settled.

    Strict: only records of exactly the header's width are loaded, and an empty field is an
    empty text. Tolerant: only over-long records are skipped, and empty or NA-like fields
    are NULL.
    """
    names = [c for c in records.columns if c != RECORD]
    if strict:
        skipped = F.col(RECORD).isNotNull()
        fields = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in names]
    else:
        skipped = F.col(RECORD).isNotNull() & (field_count(F.col(RECORD)) > len(names))
        fields = [F.when(~F.col(c).isin(NA_TOKENS), F.col(c)).alias(c) for c in names]
    return records.select(
        *fields, RECORD, F.when(skipped, SKIPPED).otherwise(LOADED).alias(OUTCOME)
    )


def loaded_rows(landed: DataFrame) -> DataFrame:
    return landed.where(F.col(OUTCOME) == LOADED).drop(RECORD, OUTCOME, PART)


def ingest(
    spark: SparkSession,
    path: str,
    table: RawTable,
    store: TableStore,
) -> Ingested:
    """Replace one raw table by the content of its CSV file or folder.

    The text is parsed once, into a table split by outcome. Loaded rows, set-aside records
    and counts are all read from there.
    """
    texts = record_texts(spark, path, store, table.name)
    records = _parsed(spark, path, texts.where(F.col(PART).isNull()))
    pieces = texts.where(F.col(PART).isNotNull()).select(
        F.col("text").alias(RECORD), F.lit(SKIPPED).alias(OUTCOME), PART
    )
    every = classified(records, table.strict).unionByName(pieces, allowMissingColumns=True)
    landed = store.replace(every, table.name, [OUTCOME])
    for scratch in (lines_table, chunks_table, borders_table, pieces_table, long_table):
        store.drop(scratch(table.name))
    loaded = F.count_if(F.col(OUTCOME) == LOADED)
    # A record in pieces counts by its first.
    skipped = F.count_if((F.col(OUTCOME) == SKIPPED) & (F.coalesce(PART, F.lit(0)) == 0))
    stats = landed.agg(
        loaded.alias("rows_loaded"),
        skipped.alias("rows_skipped"),
        half_up(F.try_divide(skipped * 100.0, loaded + skipped), 1).alias("skipped_pct"),
    ).select(F.lit(table.name).alias("table"), "rows_loaded", "rows_skipped", "skipped_pct")
    return Ingested(
        clean=loaded_rows(landed),
        quarantine=landed.where(F.col(OUTCOME) == SKIPPED).select(
            F.lit(table.name).alias("table"), F.col(RECORD).alias("record")
        ),
        stats=stats,
    )


class _RawTables(Mapping):
    def __iter__(self) -> Iterator[str]:
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)


class LoadedTables(_RawTables):
    """The raw tables as an earlier load left them in the store."""

    def __init__(self, store: TableStore):
        self.store = store

    def __getitem__(self, name: str) -> DataFrame:
        return loaded_rows(self.store.read(RAW_TABLES[name].name))


class CsvTables(_RawTables):
    """The raw tables from `<folder>/<table>.csv` files or folders, loaded on first use."""

    def __init__(self, spark: SparkSession, folder: str, store: TableStore):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.store = store
        self._ingested: dict[str, Ingested] = {}

    def ingested(self, name: str) -> Ingested:
        if name not in self._ingested:
            path = f"{self.folder}/{name}.csv"
            self._ingested[name] = ingest(self.spark, path, RAW_TABLES[name], self.store)
        return self._ingested[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.ingested(name).clean

    def stats(self) -> DataFrame:
        """Rows loaded and skipped, one row per table."""
        return union_all([self.ingested(name).stats for name in self])
