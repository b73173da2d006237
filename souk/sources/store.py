"""Tables on shared storage: full-replace writes, plain reads, and lazy views."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from souk.session import (
    delete_at_end,
    delete_path,
    path_exists,
    read_text,
    rename,
    shared_folder,
    shuffles_dropped,
    write_text,
)

# Versions of tables on their way into place; Spark's listings leave names with a dot out.
VERSIONS = ".versions"
# Figures of a table, in its folder
FIGURES = "_figures.json"
# Tables are written once and read a few times; this takes about two thirds of Spark's default.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Layout:
    """How the files of a table are arranged.

    ``partition_by``: a folder for each value, which a filter on it skips. Rows of a value are
    brought together, and split again where they are more than a file should hold.
    ``bucket_by``: a fixed number of files by hash of a column. Tables of the same number join on
    that column without a shuffle. A bucket is read by one task, so rows of one value must be few.
    """

    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None
    buckets: int = 0


PLAIN = Layout()


class TableStore:
    """Named Parquet tables below one folder.

    A written table cuts the lineage: a lost executor costs a re-read, not a rebuild.

    A table is replaced in three steps. Its next version is written in full to a folder of its
    own. One rename makes it current: from then on the store reads it, up to then the old rows.
    Last, it is moved into the table's own folder, which any Parquet reader can read. A failure
    before the rename leaves the old rows, one after it the new ones, and the next replacement
    ends what was left undone.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @classmethod
    def scratch(cls, spark: SparkSession, name: str) -> "TableStore":
        """A store of this application's own below the cluster's shared folder, gone at its end."""
        root = f"{shared_folder(spark)}/souk/{spark.sparkContext.applicationId}"
        delete_at_end(spark, root)
        return cls(spark, f"{root}/{name}")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _version(self, table: str, name: str) -> str:
        return f"{self.root}/{VERSIONS}/{table}/{name}"

    def location(self, table: str) -> str:
        """The folder that holds the table's rows now."""
        current = self._version(table, "current")
        return current if path_exists(self.spark, current) else self.path(table)

    def replace(
        self,
        df: DataFrame,
        table: str,
        partition_by: list[str] | None = None,
        layout: Layout = PLAIN,
        figures: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Replace the table by these rows and return it as read back.

        ``figures`` are aggregates that the write observes; they are kept beside the rows as
        text, and become current with them. What the write shuffled is gone when it ends.
        """
        schema = df.schema
        next_ = f"{self.root}/{VERSIONS}/_next/{table}-{uuid.uuid4().hex}"
        if layout.partition_by:
            df = df.hint("rebalance", *layout.partition_by)
        if figures:
            # Last before the write: only there is a repeated task counted once.
            observation = Observation()
            df = df.observe(observation, *[f.alias(name) for name, f in figures.items()])
        with shuffles_dropped(self.spark):
            self._write(df, next_, partition_by, layout)
        if figures:
            values = {name: None if v is None else str(v) for name, v in observation.get.items()}
            write_text(self.spark, f"{next_}/{FIGURES}", json.dumps(values))
        self._settle(table)
        rename(self.spark, next_, self._version(table, "current"))
        self._settle(table)
        return self._read_as(table, schema, layout)

    def _write(self, df: DataFrame, path: str, partition_by, layout: Layout) -> None:
        keys = list(partition_by or layout.partition_by)
        writer = df.write.mode("overwrite").option("compression", COMPRESSION)
        if keys:
            writer = writer.partitionBy(*keys)
        if not layout.bucket_by:
            writer.parquet(path)
            return
        name = f"souk_{uuid.uuid4().hex}"
        writer = writer.format("parquet").bucketBy(layout.buckets, layout.bucket_by)
        writer.sortBy(layout.bucket_by).option("path", path).saveAsTable(name)
        # The files stay; the name was only for the write.
        self.spark.sql(f"drop table {name}")

    def _settle(self, table: str) -> None:
        """Moves a current version into the table's own folder, and ends other versions."""
        current = self._version(table, "current")
        if path_exists(self.spark, current):
            delete_path(self.spark, self.path(table))
            rename(self.spark, current, self.path(table))
            delete_path(self.spark, f"{self.root}/{VERSIONS}/{table}")

    def _read_as(self, table: str, schema: StructType, layout: Layout) -> DataFrame:
        # The schema is known, so no footer has to be read to infer it.
        if not layout.bucket_by:
            return self.spark.read.schema(schema).parquet(self.location(table)).select(*schema.names)
        name = self._catalog_name(table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        key = layout.bucket_by
        self.spark.sql(f"drop table if exists {name}")
        self.spark.sql(
            f"create table {name} ({columns}) using parquet clustered by (`{key}`) "
            f"sorted by (`{key}`) into {layout.buckets} buckets location '{self.location(table)}'"
        )
        return self.spark.table(name)

    def _catalog_name(self, table: str) -> str:
        return f"souk_{sha256(self.path(table).encode()).hexdigest()[:24]}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.location(table))

    def figures(self, table: str) -> dict | None:
        """What was kept beside the rows when they were written."""
        text = read_text(self.spark, f"{self.location(table)}/{FIGURES}")
        return json.loads(text) if text else None

    def write_note(self, name: str, text: str) -> None:
        """Replace a small text that is kept beside the tables."""
        beside = f"{self.root}/{VERSIONS}/_next/{name}-{uuid.uuid4().hex}"
        write_text(self.spark, beside, text)
        delete_path(self.spark, self._note(name))
        rename(self.spark, beside, self._note(name))

    def read_note(self, name: str) -> str | None:
        return read_text(self.spark, self._note(name))

    def _note(self, name: str) -> str:
        return f"{self.root}/_{name}.json"

    def has(self, table: str) -> bool:
        return path_exists(self.spark, self.location(table))

    def drop(self, table: str) -> None:
        self.spark.sql(f"drop table if exists {self._catalog_name(table)}")
        delete_path(self.spark, self.path(table))
        delete_path(self.spark, f"{self.root}/{VERSIONS}/{table}")
