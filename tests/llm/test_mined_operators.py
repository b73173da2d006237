"""Manifest, languages and collocations against plain Python, and awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import collocations, language_id, merkle
from souk.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


def oracle(name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    return con.sql(ORACLE_SQL[name])


def compared(spark, name):
    want = oracle(name)
    got = QUERIES[name](spark, SMALL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


# --- manifest


def plain_digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([plain_digest(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def plain_path(levels, i):
    path = []
    for level in levels[:-1]:
        run = i // 3 * 3
        path.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return path


def plain_leaf(row):
    return plain_digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_proofs(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {name: sorted(groups[name], key=lambda x: x[:3]) for name in names}
    trees = {name: plain_levels([x[2] for x in own[name]]) for name in names}
    upper = plain_levels([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(own[name]):
            path = plain_path(trees[name], i) + plain_path(upper, k)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            top = plain_leaf((*row[:4], text))
            for before, behind in path:
                top = plain_digest(*before, top, *behind)
            proof = plain_digest(*(d for before, behind in path for d in before + behind))
            root = upper[-1][0]
            out.append((row[0], leaf, trees[name][-1][0], root, proof, top, top == root))
    return sorted(out, key=str)


def test_manifest_of_the_corpus(spark):
    compared(spark, "op11_merkle")


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_in_blocks_of_any_height(spark, docs, levels, monkeypatch):
    rng = random.Random(levels)
    rows = [tuple(row) for row in docs.select(*merkle.FIELDS).collect()]
    rows += [(i, rng.choice(["a", "b", None, "é", "A"]), None, i, f"x\n{i}") for i in range(20, 140)]
    rows += [(7, "hot", "en", 1, "same\n")] * 30
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    # Names that the operator uses inside
    table = table.withColumns({name: F.lit(1) for name in ("tree", "place", "digest", "leaf", "root")})
    found = merkle.manifest(table, merkle.without_line_ends(table), levels=levels)
    proof = F.sha2(F.array_join(F.flatten("path.siblings"), ""), 256)
    root = F.coalesce("version", "root")
    got = found.select("doc_id", "leaf", "subroot", "root", proof, root, root == F.col("root"))
    assert sorted(map(tuple, got.collect()), key=str) == plain_proofs(rows)


def test_manifest_of_few_rows(spark, docs, empty):
    assert merkle.proofs(empty).count() == 0
    one = docs.where("doc_id = 1")
    row = merkle.proofs(one).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == plain_digest("")


def test_versions_share_all_nodes_off_the_way():
    tree, levels = merkle.grown([plain_digest(str(i)) for i in range(20)], None)
    way = merkle.turns(13, levels)
    other = merkle.version(tree, way, "changed")

    def nodes(node):
        return {id(node): node} | {k: v for child in node.children for k, v in nodes(child).items()}

    fresh = nodes(other).keys() - nodes(tree).keys()
    assert len(fresh) == levels + 1 and len(nodes(other)) == len(nodes(tree))
    assert merkle.folded("changed", merkle.siblings(tree, way)) == other.digest != tree.digest
    assert merkle.version(tree, way, plain_digest("13")).digest == tree.digest


def test_equal_rows_are_dealt_to_several_tasks(spark):
    rows = spark.range(3000).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.lit("t").alias("text"),
    )
    found = merkle.manifest(rows, levels=3)
    assert sorted(r.place for r in found.select("place").collect()) == list(range(3000))
    levels = plain_levels([plain_leaf((1, "s", "en", 1, "t"))] * 3000)
    assert {r.root for r in found.select("root").distinct().collect()} == {levels[-1][0]}


# --- languages


def plain_subwords(text):
    text = re.sub(rb"[^a-z\x80-\xff]", b" ", b" " + text.lower() + b" ")
    for size in language_id.SIZES:
        for i in range(len(text) - size + 1):
            part = text[i : i + size]
            if b" " not in part[1:-1] and part.strip(b" "):
                code = part[0]
                for byte in part[1:]:
                    code = (code * 257 + byte + 1) % 2**64
                yield code * 0x9E3779B97F4A7C15 % 2**64 >> 48


@pytest.mark.parametrize("langs", [3, 20])
def test_logits_are_averages_over_subwords(langs):
    rng = np.random.default_rng(3)
    model = language_id.Model(
        [str(i) for i in range(langs)], rng.normal(size=(language_id.BUCKETS, language_id.DIMENSION)),
        rng.normal(size=(language_id.DIMENSION, langs)), rng.normal(size=langs),
    )
    texts = ["", "Ab c", "x", "  ", "été où ça", "1 2", "z" * 3000, "den Übermut ", "日本"]
    got = model.logits(*language_id.joined([t.encode() for t in texts]))
    for text, row in zip(texts, got):
        own = list(plain_subwords(text.encode()))
        mean = model.vectors[own].mean(axis=0) if own else np.zeros(language_id.DIMENSION)
        assert np.allclose(row, mean @ model.weights + model.bias)


def test_languages_of_held_out_documents(corpus):
    model = language_id.trained(corpus)
    rows = language_id.predicted(corpus, model).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == corpus.count()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row.held_out]
    assert np.mean([row.lang == row.lang_pred for row in held]) > 0.97
    assert np.mean([row.rejected for row in held]) < 0.1
    assert all(0 <= row.score <= 1 for row in rows)


def test_labels_of_held_out_rows_teach_nothing(corpus):
    other = F.when(language_id.remainder("doc_id") == 2, F.lit("xx")).otherwise(F.col("lang"))
    models = [language_id.trained(rows) for rows in (corpus, corpus.withColumn("lang", other))]
    assert models[0].langs == models[1].langs and np.array_equal(models[0].vectors, models[1].vectors)


def test_rejection_holds_wrong_texts_back():
    rng = random.Random(5)
    alphabets = {"a": "abcdef", "g": "ghijkl"}

    def text(lang):
        return " ".join("".join(rng.choices(alphabets[lang], k=5)) for _ in range(30)).encode()

    langs = [rng.choice("ag") for _ in range(300)]
    model = language_id.fit([text(lang) for lang in langs], langs)
    best, score = model.scores(model.logits(*language_id.joined([text("a"), text("g"), b"adgj gjad " * 9])))
    assert [model.langs[i] for i in best[:2]] == ["a", "g"]
    assert score[:2].min() >= model.threshold > 0 and score[2] < score[:2].min()


def test_languages_of_odd_rows(docs, empty, corpus):
    model = language_id.trained(corpus)
    rows = language_id.predicted(docs.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == docs.count()
    blank = [row for row in rows if row.doc_id in (4, 5, 8)]
    assert {(row.lang_pred, row.score, row.rejected) for row in blank} == {("und", 0.0, True)}
    assert not any(row.held_out for row in rows if row.doc_id is None)
    assert {row.lang_pred for row in rows if row.doc_id == 6} <= set(model.langs)
    assert language_id.predicted(empty, model).count() == 0
    untaught = language_id.trained(empty)
    assert {row.lang_pred for row in language_id.predicted(docs, untaught).collect()} == {"und"}
    assert language_id.trained(docs.withColumn("lang", F.lit(None).cast("string"))).langs == []


# --- collocations


def plain_collocations(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    found = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *words), a in found.items():
        inside = [b for (other, *p), b in found.items()
                  if other == lang and len(p) > len(words) and (p[:-1] == words or p[1:] == words)]
        if any(100 * b >= 50 * a for b in inside):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, " ".join(words), a, l, r, totals[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranked, rank = [], Counter()
    for lang, *rest in out:
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], *rest))
    return ranked


def test_collocations_of_the_corpus(spark):
    compared(spark, "op13_collocations")


@pytest.mark.parametrize(("shards", "cells", "least", "top"), [(1, 64, 2, 50), (4, 1 << 12, 3, 2000), (7, 1 << 16, 10, 5)])
def test_collocations_of_random_texts(spark, shards, cells, least, top):
    rng = random.Random(shards)

    def text():
        words = rng.choices(["a", "B", "b", "cc", "é", "É", "d-d", "\0", "und"], [9, 4, 4, 3, 2, 2, 1, 1, 1], k=rng.randint(0, 40))
        return "".join(word + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", "!"]) for word in words)

    rows = [(rng.choice(["x", "x", None, "und"]), text()) for _ in range(90)]
    # Words that only the last shards have come to their count late.
    rows += [("x", "late later latest " * 12)] + [("x", None), (None, ""), ("x", " \t "), ("y", "q " * 400)]
    rows += [("z", "one two three")] * 15
    table = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {name: F.lit(1) for name in ("phrase", "n", "size", "shard", "rank")}
    )
    got = collocations.mined(table, top, shards=shards, cells=cells, least=least)
    got = sorted(map(tuple, got.collect()), key=lambda row: (row[0], row[1]))
    assert got == plain_collocations(rows, least, top)


def test_scores_pass_64_bits(spark):
    a, l, r = 3_000_000_000_000, 7_000_000_000_000, 5_000_000_000_001
    rows = [("x", 1, "p", l), ("x", 1, "q", r), ("x", 2, "p q", a)]
    found = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    assert collocations.judged(found).first().score == 1000000 * a * a // (l * r)


def test_collocations_of_nothing(empty, docs):
    assert collocations.mined(empty).count() == 0
    assert {row.lang for row in collocations.mined(docs).collect()} == {"en"}


def test_phrases_are_counted_once_they_can_be_frequent(spark):
    """A scan counts no phrase whose parts have not come to their count before it."""
    table = spark.createDataFrame([("x", "a b c " * 20 + ". rare one")], "lang string, text string")
    starts = np.full(1 << 12, collocations.UNSET, np.uint8)
    first = collocations.summed(collocations.scanned(table, 0, 2, starts, 3))
    assert {row.size for row in first.collect()} == {0, 1}
    parts = first.where("n >= 10 and size > 0")
    starts[collocations.found_cells(parts, 1 << 12)] = 1
    second = collocations.summed(collocations.scanned(table, 1, 2, starts, 3)).where("size > 1")
    assert {(row.phrase, row.scan) for row in second.collect()} == {("a b", 1), ("b c", 1), ("c a", 1)}
