"""Cleaning of a text corpus: each stage works on all that the one before it kept.

The stages call operators of ``souk.llm``. Every stage but the last returns the columns of
documents; the last returns the digests of the encoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import common, line_dedup, piece_codec, simhash, toxicity, winnowing
from souk.llm.queries import PIECE_MODEL


def _as_row(docs: DataFrame) -> DataFrame:
    """(row, text): operators add columns whose names documents may have too."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones among them, lets pass."""
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(_as_row(docs), model, keep=["row"])
    return scored.where(~F.col("toxic")).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated or near-duplicate lines; n_chars follows the text."""
    left = line_dedup.apply(docs, short=True)
    if "n_chars" not in docs.columns:
        return left
    length = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't quote the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = winnowing.contamination(_as_row(docs), benchmark, keep=["row"])
    return found.where(~F.col("contaminated")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_codec.digests(docs, PIECE_MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# SQL can express neither the fitted model nor the encoder; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
