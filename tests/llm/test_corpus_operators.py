"""Operators on whole tables against plain Python, and awkward rows."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from souk.llm import components, host_rules, line_dedup, sharding, simhash, suffix_dedup
from souk.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


def joined(nodes, pairs):
    """The least member of each node's component."""
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(30)] + [(5, 5), (None, 3)]
    rows = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert dict(map(tuple, rows)) == joined({x for e in real for x in e}, real)
    assert len(rows) == len({r.node for r in rows})


@pytest.mark.parametrize("chunk", [2048, 8])
def test_simhash_links(corpus, texts, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    got = {r.doc_id: r for r in simhash.near_duplicates(corpus).collect()}
    prints = {}
    for doc, text in texts.items():
        words = text.encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[doc].fingerprint == f"{prints[doc]:016x}"
    docs = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(docs) for b in docs[:i] if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {d: r.component_id for d, r in got.items()} == joined(docs, pairs)


def test_simhash_odd_rows(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    blank = {r.component_id for r in rows if int(r.fingerprint, 16) == 0}
    assert blank == {4}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 4").count() == 1


def test_one_of_each_group_stays_whatever_the_ids(spark):
    def text(seed):
        return " ".join(random.Random(seed).choices("abcdefghijklmnop", k=200))

    rows = [(None, text(1), "x"), (None, text(1), "y"), (1, text(1), "z"), (1, text(2), "own")]
    rows += [(None, text(3), "b"), (None, text(3), "a"), (None, text(4), "c")]
    rows += [(5, text(5), "e")] * 30 + [(5, text(5), "d"), (6, text(5), "f"), (5, text(6), None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = simhash.keep_one(table)
    want = [(1, text(1), "z"), (1, text(2), "own"), (None, text(3), "a"), (None, text(4), "c")]
    want += [(5, text(5), "d"), (5, text(6), None)]
    assert left.columns == table.columns
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, want))


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, most):
    text = list(text)
    for _ in range(rng.randint(0, most)):
        i, kind = rng.randint(0, len(text)), rng.randint(0, 2)
        text[i : i + (kind > 0)] = [] if kind == 1 else [rng.choice("abcé")]
    return "".join(text)


def test_band_against_the_full_table():
    rng = random.Random(3)
    a = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    b = [changed(rng, x + "a", 4) for x in a]
    want = [edits(x, y) <= 2 for x, y in zip(a, b)]
    assert line_dedup.within_band(a, b).tolist() == want and 0 < sum(want) < len(want)


@pytest.mark.parametrize("chunk", [2048, 8])
def test_line_classes(spark, monkeypatch, chunk):
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(38, 70))) for _ in range(60)]
    rows = [(d, "\n".join(changed(rng, rng.choice(base), 4) for _ in range(rng.randint(0, 5)))) for d in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = [(d, i, x) for d, t in rows for i, x in enumerate(t.split("\n")) if len(x) >= 40]
    lines = sorted({x for _, _, x in places})
    pairs = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if abs(len(a) - len(b)) < 3 and edits(a, b) < 3]
    root, first, want = joined(lines, pairs), {}, defaultdict(list)
    for d, i, x in places:
        if first.setdefault(root[x], (d, i)) != (d, i):
            want[d].append(i)
    assert pairs and {r.doc_id: r.removed for r in line_dedup.judged(docs).collect()} == {d: want[d] for d, _ in rows}


def test_line_dedup_odd_rows(docs, empty):
    kept = line_dedup.apply(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns
    by_id = defaultdict(list)
    for row in rows:
        by_id[row.doc_id].append(row.text)
    # Line "one" differs in few letters from "two"; both copies of 3 lose their only line.
    assert 3 not in by_id and by_id[4] == [""] and by_id[5] == [None]
    assert len(by_id[None]) == 2
    assert line_dedup.judged(docs).count() == docs.count()
    assert line_dedup.judged(empty).count() == 0


def test_short_lines_that_repeat_go(spark):
    notice, long = "Released under the MIT License.", "A line of its own, longer than the others are, number "
    rows = [(i, f"{notice}\n\n{long}{chr(97 + i) * 9}\n \nno. {i}") for i in range(9)] + [(20, "é"), (21, "é"), (None, notice)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.removed for r in line_dedup.judged(docs, short=True).collect()}
    # A null id comes first; near copies that are short are different lines.
    assert got == {i: [0] for i in range(9)} | {20: [], 21: [0], None: []}
    left = {r.doc_id: r.text for r in line_dedup.apply(docs, short=True).collect()}
    assert set(left) == {*range(9), 20, None}
    assert left[3] == rows[3][1].removeprefix(notice + "\n") and left[None] == notice


def oracle(name, **tables):
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register(table, frame.toPandas())
    return sorted(map(repr, con.sql(ORACLE_SQL[name]).fetchall()))


def test_host_rules(corpus, docs, empty):
    for table in (corpus, docs):
        got = sorted(repr(tuple(r)) for r in host_rules.quality(table).collect())
        assert len(got) == table.count()
        if table is corpus:
            assert got == oracle("op3_host_rules", documents=table)
    assert host_rules.quality(empty).count() == 0


def test_a_failing_host_loses_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"good{i % 3}", good) for i in range(60)]
    rows += [(100 + i, "bad", good if i < 3 else "junk") for i in range(40)]
    got = {r.doc_id: r for r in host_rules.quality(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert all(got[i].kept for i in range(60))
    assert not got[100].base_failed and not got[100].kept
    assert 0.5 < got[100].host_rate <= 37 / 40


@pytest.mark.parametrize("limit", [200, 3000, 10**9])
def test_shards(spark, docs, corpus, limit):
    same = spark.createDataFrame([(1, "x" * 50)] * 40 + [(None, None)], "doc_id long, text string")
    for table in (same, docs.select("doc_id", "text"), corpus.select("doc_id", "text")):
        rows = sharding.assign(table, limit=limit).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in table.collect())
        sizes, number = Counter(), Counter()
        for r in rows:
            sizes[r["shard"]] += r.n_bytes
            number[r["shard"]] += 1
        for r in rows:
            shard = r["shard"]
            assert (sizes[shard], number[shard]) == (r.shard_bytes, r.shard_docs)
            assert r.shard_bytes <= limit or r.shard_docs == 1
            # The bucket above had to split.
            if shard and not shard.endswith("-"):
                assert sum(n for s, n in sizes.items() if s.startswith(shard[:-1])) > limit
    assert sharding.assign(docs.limit(0), limit=limit).count() == 0


def test_written_shards_are_those_assigned(spark, tmp_path):
    rows = [(7, "x" * 50)] * 40 + [(7, "y" * 30)] * 25 + [(None, "é" * 20)] * 40 + [(None, None)] * 3
    rows += [(i, "z" * i) for i in range(10, 30)] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sharding.write_shards(table, str(tmp_path / "out"), limit=400)
    want = Counter((r["shard"], r.doc_id, r.n_bytes) for r in sharding.assign(table, limit=400).collect())
    got, back = Counter(), Counter()
    for folder in (tmp_path / "out").glob("shard=*"):
        for r in spark.read.parquet(str(folder)).collect():
            got[folder.name.removeprefix("shard="), r.doc_id, len((r.text or "").encode())] += 1
            back[tuple(r)] += 1
    assert got == want and back == Counter(rows)
    assert any(shard.count("-") and i == 7 for shard, i, _ in got)


def covered(rows, size=400):
    times = Counter(t[i : i + size] for _, t in rows for i in range(len(t) - size + 1))
    out = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - size + 1):
            if times[text[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [512, 1])
def test_repeated_passages(spark, docs, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_STRETCHES", most)
    rng = random.Random(6)

    def text(n):
        return "".join(rng.choice("ab é") for _ in range(n))

    passage, rows = text(700), []
    for doc in range(25):
        a, b = sorted((rng.randint(0, 300), rng.randint(380, 700)))
        rows.append((doc, text(rng.randint(0, 500)) + passage[a:b] + text(rng.randint(0, 500))))
    rows += [(30, "z" * 900), (31, rows[3][1]), (31, rows[3][1]), (None, None), (32, "ab" * 450)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for own in (table, docs.select("doc_id", "text")):
        want = covered([(r.doc_id, (r.text or "").encode()) for r in own.collect()])
        assert sorted((tuple(r) for r in suffix_dedup.report(own).collect()), key=repr) == want
    assert suffix_dedup.apply(docs).columns == [*docs.columns, "kept"]
    assert suffix_dedup.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("strings", [1, 333, 5000])
def test_repeats_beyond_the_parts_of_a_long_text(spark, monkeypatch, strings):
    monkeypatch.setattr(suffix_dedup, "PART_STRINGS", strings)
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", 14)
    rng = random.Random(9)

    def text(n):
        return "".join(rng.choice("abcd é") for _ in range(n))

    passage = text(700)
    rows = [(1, text(9000) + passage + text(3000) + passage[100:600]), (2, passage[50:640] + text(50))]
    rows += [(3, text(2000)), (4, None), (5, text(401)), (6, passage)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    if strings == 1:
        table = table.where("doc_id <> 1")
    want = covered([(r.doc_id, (r.text or "").encode()) for r in table.collect()])
    assert sorted((tuple(r) for r in suffix_dedup.report(table).collect()), key=repr) == want
    assert sum(row[2] for row in want) > 1000


def test_expansion_against_counting():
    rng = random.Random(5)
    for _ in range(40):
        base = bytes(rng.choice(b"ab") for _ in range(300))
        texts = []
        for _ in range(rng.randint(1, 8)):
            a = rng.randint(0, 200)
            own = bytearray(base[a : a + rng.randint(40, 100)])
            own[rng.randrange(len(own))] = rng.choice(b"abc")
            texts.append(bytes(own))
        starts = np.array([rng.randint(1, len(t) - 19) for t in texts])
        keys = [t[i : i + 20] for t, n in zip(texts, starts) for i in range(n)]
        times = Counter(keys)
        assert suffix_dedup.repeats(texts, starts, 20).tolist() == [times[k] > 1 for k in keys]


def test_suffixes_told_apart_are_not_sorted_again(monkeypatch):
    """Rounds of the suffix sort are over suffixes that are still the same, not over all."""
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(32, 127, 600).astype(np.uint8)) for _ in range(50)]
    texts[7] = texts[3][:500]
    sizes, argsort = [], np.argsort

    def counted(keys, *args, **options):
        sizes.append(len(keys))
        return argsort(keys, *args, **options)

    symbols = np.concatenate([np.frombuffer(t + b"\0", np.uint8) for t in texts]).astype(np.uint16)
    # With no bits to spare, all sorting is by argsort.
    monkeypatch.setattr(suffix_dedup, "_order_of", lambda keys, bits: np.argsort(keys), raising=False)
    monkeypatch.setattr(np, "argsort", counted)
    order = suffix_dedup.suffix_order(symbols, 400)
    assert sum(sizes) < 1.5 * len(symbols)
    raw = symbols.astype(np.uint8).tobytes()
    first = [raw[i : i + 400] for i in order]
    assert first == sorted(first) and sorted(order) == list(range(len(raw)))


def test_order_of_keys_with_and_without_room_for_their_places():
    rng = np.random.default_rng(8)
    for bits in (1, 20, 52, 53, 60, 63):
        keys = rng.integers(0, 1 << bits, 3000, dtype=np.uint64)
        order = suffix_dedup._order_of(keys, bits)
        assert (keys[order] == np.sort(keys)).all() and sorted(order) == list(range(len(keys)))


def test_expansion_where_symbols_were_last_seen_far_above():
    """Many texts of one middle and few symbols: large intervals, told by boundaries far above."""
    rng = random.Random(12)
    for symbols, number in ((b"ab", 60), (b"abcdefgh", 200), (b"a", 5)):
        base = bytes(rng.choice(symbols) for _ in range(200))
        texts = []
        for _ in range(number):
            a, b = rng.randint(0, 60), rng.randint(120, 200)
            ends = [bytes(rng.choice(symbols) for _ in range(rng.randint(0, 30))) for _ in "ab"]
            texts.append(ends[0] + base[a:b] + ends[1])
        starts = np.array([len(t) - 49 for t in texts])
        keys = [t[i : i + 50] for t, n in zip(texts, starts) for i in range(n)]
        times = Counter(keys)
        assert suffix_dedup.repeats(texts, starts, 50).tolist() == [times[k] > 1 for k in keys]


def test_pipeline_stages(spark, corpus):
    documents = corpus
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, documents, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == documents.columns
            documents = out
    assert 0 < out.count() <= documents.count() < corpus.count()
    assert len(QUERIES) == 13


def test_pipeline_takes_odd_rows(spark, docs, empty):
    for table in (docs, empty):
        documents = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            documents = stage(spark, documents, SMALL)
            assert documents.columns == table.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, documents, SMALL).count()
        assert rows == documents.count() <= table.count()


CLASHING = ("toxic", "severity", "p_toxic", "n_hit", "n_words", "items", "contaminated", "row", "h", "line", "spans")
CLASHING += ("hit_spans", "fingerprint", "component_id", "kept", "digest", "data", "id", "place", "lines", "part")


def test_stages_leave_columns_of_any_name_alone(spark, corpus):
    own = [F.concat(F.lit(f"own {name} "), F.col("doc_id")).alias(name) for name in CLASHING]
    documents = corpus.select("*", *own)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        documents = stage(spark, documents, SMALL)
        assert documents.columns == [*corpus.columns, *CLASHING]
    rows = documents.collect()
    assert rows and all(row[name] == f"own {name} {row.doc_id}" for row in rows for name in CLASHING)
