"""One query for each operator, over its whole table, and DuckDB statements of the same results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import (
    collocations,
    host_rules,
    language_id,
    line_dedup,
    merkle,
    page_text,
    piece_codec,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.judged(table(spark, sf_dir, "documents"), short=True)


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.report(table(spark, sf_dir, "documents"))
    return found.withColumn("repeated", F.col("n_removed") > 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"])


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(table(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predicted(docs, language_id.trained(docs))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_sentencepiece,
        op2_line_dedup,
        op3_host_rules,
        op4_sharding,
        op5_secrets,
        op6_suffix_dedup,
        op7_simhash,
        op8_toxicity,
        op9_winnowing,
        op10_page_text,
        op11_merkle,
        op12_language,
        op13_collocations,
    )
}

WINNOWING_SQL = r"""
with docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
),
tests as (
    select row_number() over () as t, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
),
test_places as (
    select t, item_id, least(len(w), 13) as size, w,
        unnest(range(1, len(w) - least(len(w), 13) + 2)) as i
    from tests where len(w) > 0
),
test_windows as (
    select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as win from test_places
),
sizes as (select distinct size from test_windows),
doc_places as (
    select r, size, w, unnest(range(1, len(w) - size + 2)) as i
    from docs, sizes where len(w) >= size
),
doc_windows as (
    select r, i, size, array_to_string(w[i:i + size - 1], ' ') as win from doc_places
),
met as (select r, i, size, item_id from doc_windows join test_windows using (size, win)),
words_hit as (
    select r, count(distinct word) as n_hit
    from (select r, unnest(range(i, i + size)) as word from met) group by r
),
items_met as (
    select r, count(*) as n_items, string_agg(id, ',' order by id) as joined
    from (select distinct r, item_id::varchar as id from met where item_id is not null) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit,
    coalesce(n_items, 0) as n_items, sha256(coalesce(joined, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words_hit using (r) left join items_met using (r)
"""

ORACLE_SQL = {
    "op3_host_rules": host_rules.ORACLE_SQL,
    "op4_sharding": sharding.ORACLE_SQL.format(limit=sharding.SHARD_BYTES),
    "op9_winnowing": WINNOWING_SQL,
    "op11_merkle": merkle.oracle_sql(),
    "op13_collocations": collocations.ORACLE_SQL,
}
