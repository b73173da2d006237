"""Operators on single texts against plain Python."""

import hashlib
import random
import re
import time
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from souk.llm import page_text, piece_codec, secrets, toxicity, winnowing
from souk.llm.queries import PIECE_MODEL, op9_winnowing

SMALL = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_equal_the_library(corpus, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for table in (corpus, docs):
        want = []
        for row in table.collect():
            ids = library.encode(row.text or "")
            decoded = library.decode(ids) if ids else ""
            want.append((row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
        got = piece_codec.digests(table, PIECE_MODEL).collect()
        assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(want, key=repr)


def test_spans_are_the_bytes_that_pieces_stand_for():
    codec = piece_codec.Codec(PIECE_MODEL)
    rng = random.Random(1)
    alphabet = "ab \n▁é€😀\0.Tthe"
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        ids, starts, ends = codec.encode(text)
        raw = text.encode()
        pieces = codec.library.encode(text, return_type="proto").pieces if text else []
        assert ids.tolist() == [p.id for p in pieces]
        assert (starts[1:] <= ends[1:]).all() if len(ids) else not text
        for piece, a, b in zip(pieces, starts, ends):
            if not piece.piece.startswith("<0x"):
                assert raw[a:b].decode() == piece.surface


def trie(entries: dict[bytes, int]) -> bytes:
    """A double-array trie in the format of a compiled character map, built the plain way."""
    units = {0: 0}
    taken = {0}

    def place(node: int, items: dict[bytes, int]) -> None:
        labels = sorted({key[:1] or b"\0" for key in items})
        offset = next(
            o for o in range(1, 1 << 16)
            if all((node ^ o ^ x[0]) not in taken for x in labels) and all((node ^ o ^ x[0]) > 0 for x in labels)
        )
        units[node] |= offset << 10
        taken.update(node ^ offset ^ x[0] for x in labels)
        for label in labels:
            at = node ^ offset ^ label[0]
            if label == b"\0" and b"" in items:
                units[at] = items[b""] | 0x80000000
                units[node] |= 0x100
            else:
                units[at] = label[0]
                place(at, {k[1:]: v for k, v in items.items() if k[:1] == label})

    place(0, entries)
    size = -(-(max(units) + 1) // 256) * 256
    return np.array([units.get(i, 0) for i in range(size)], "<u4").tobytes()


@pytest.mark.parametrize("squeeze", [False, True])
def test_longest_prefix_normalisation_equals_the_library(squeeze):
    model = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    replaced = {b"A": b"a", b"AB": b"x", b"ABC": b"", "é".encode(): b"e", b"\t": b" "}
    texts, places = b"", {}
    for key, value in replaced.items():
        places[key] = len(texts)
        texts += value + b"\0"
    blob = trie(places)
    model.normalizer_spec.precompiled_charsmap = len(blob).to_bytes(4, "little") + blob + texts
    model.normalizer_spec.remove_extra_whitespaces = squeeze
    codec = piece_codec.Codec.of(model.SerializeToString())
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("ABCé\t x") for _ in range(rng.randint(1, 14)))
        data, places_ = codec.normalise(text)
        assert data.decode() == codec.library.normalize(text)
        assert len(places_) == len(data) + 1 and (np.diff(places_) >= 0).all()
        assert codec.encode(text)[0].tolist() == codec.library.encode(text)


def test_winnowing_finds_every_window(spark, corpus, texts):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    some = word.findall(texts[1].translate(low))
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items += [("s1", " ".join(some[3:5])), ("s2", " ".join(some[7:16])), ("e", " . "), ("n", None)]
    # By the contract, words of an item without an id are hit too.
    items += [(None, " ".join(some))]
    test = spark.createDataFrame(items, "item_id string, text string")
    found = winnowing.contamination(corpus, test)
    windows: dict[tuple, set] = {}
    for name, text in items:
        words = word.findall((text or "").translate(low))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(name)
    for row in found.collect():
        words = word.findall(texts[row.doc_id].translate(low))
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= own
        names.discard(None)
        assert (row.n_words, row.n_hit, row["items"]) == (len(words), len(hit), sorted(names))
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))


def test_blocks_of_test_items_give_the_same(spark, corpus, monkeypatch):
    whole = op9_winnowing(spark, SMALL).collect()
    monkeypatch.setattr(winnowing, "BLOCK_BYTES", 4000)
    assert sorted(op9_winnowing(spark, SMALL).collect()) == sorted(whole)


def test_odd_rows_are_clean(docs, empty, spark):
    test = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.contamination(docs, test).where("n_hit > 0 or contaminated").count() == 0
    assert winnowing.contamination(docs, test).count() == docs.count()
    assert winnowing.contamination(empty, test).count() == 0


BASE = {
    "assign": re.compile(
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def test_base_secrets(corpus, texts, docs):
    for row in secrets.secrets(corpus).collect():
        want = []
        for kind, pattern in BASE.items():
            for m in pattern.finditer(texts[row.doc_id]):
                size = len(m[2]) if kind == "assign" else len(m[0])
                if size >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                    want.append((m.start(), list(BASE).index(kind), kind, m.end()))
        want = [(kind, a, b) for a, _, kind, b in sorted(want)]
        assert [tuple(s) for s in row.spans if s.kind != "novel"] == want
    assert secrets.report(docs).count() == docs.count()


def test_novel_secrets_need_context_and_novelty():
    strange = "Zq8Lw3Xv9Tn5Rb2Kj7Hd4"
    text = f"é private cert is {strange} there"
    assert secrets.scan(text.encode()) == [("novel", text.index(strange), text.index(strange) + len(strange))]
    assert secrets.scan(f"a plain word is {strange} there".encode()) == []
    known = f"{strange} comes first\nprivate cert is {strange}"
    assert secrets.scan(known.encode()) == []


def test_a_repeated_secret_is_reported_at_all_its_sensitive_places():
    strange = "Zq8Lw3Xv9Tn5Rb2Kj7Hd4"
    config = f"name: é\nprivate cert is {strange}\nmore\n"
    for text in (config * 2, config * 3 + "x" * 900 + config, f"cookie {strange}, session {strange}"):
        want = [("novel", m.start(), m.end()) for m in re.finditer(strange, text)]
        assert len(want) > 1 and secrets.scan(text.encode()) == want


@pytest.mark.parametrize(
    "alphabet", ["0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123), 43, 47]))]
)
@pytest.mark.parametrize("size", [40, 62, 63, 64, 65, 100, 127, 400, 3000])
def test_long_random_strings_are_novel(alphabet, size):
    rng = random.Random(size)
    for _ in range(50):
        strange = "A1" + "".join(rng.choices(alphabet, k=size - 2))
        # Long runs of digits are hexadecimal strings of the fixed patterns.
        strange = re.sub("[0-9]{15}", lambda run: run[0][:-1] + "G", strange)
        text = f"private cert is {strange}"
        assert secrets.scan(text.encode()) == [("novel", 16, 16 + size)]
        twice = (strange[:18] * size)[:size]
        assert secrets.scan(f"private cert is {twice}".encode()) == []


def test_many_secrets_in_one_text_take_time_in_proportion():
    rng = random.Random(2)

    def lines(n):
        parts = ["Zq" + "".join(rng.choices("GHIJKLMNOPQRSTUVWXYZ23456789", k=30)) for _ in range(n)]
        return "\n".join(f'password = "abcdefgh{i:08}" token key {part}' for i, part in enumerate(parts)).encode()

    times = []
    for n in (1000, 16000):
        text = lines(n)
        start = time.perf_counter()
        assert Counter(kind for kind, _, _ in secrets.scan(text)) == {"assign": n, "novel": n}
        times.append(time.perf_counter() - start)
    assert times[1] < 16 * 3 * times[0]


def test_a_sensitive_word_counts_for_the_whole_line():
    rng = random.Random(8)
    parts = ["A1" + "".join(rng.choices("GHIJKLMNOPQRSTUVWXYZ23456789", k=40)) for _ in range(3)]
    text = "bearer is " + ".".join(parts)
    want = [("novel", text.index(p), text.index(p) + len(p)) for p in parts]
    assert secrets.scan(text.encode()) == want
    assert secrets.scan(text.replace(" is ", " is\n").encode()) == []


def test_page_text_is_the_article(spark, docs):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {row.page_id: row.html for row in pages.collect()}
    for row in page_text.main_text(pages).collect():
        article = re.search("<article>(.*?)</article>", html[row.page_id], re.S)[1]
        parts = [re.sub("<[^>]*>", "", p) for p in re.split(r"</?(?:p|h1)\b[^>]*>", article)]
        want = "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        assert (row.text, row.n_chars) == (want, len(want))


def test_page_parts_that_are_not_text():
    body = "Main words of the article go on for a while here."
    html = (
        "<nav><a href=x>Home</a></nav><article><h1>Head &amp; tail</h1><p>" + body
        + "<div class='comments'><p>First!</p></div><script>x = '</p>';</script><p>"
        + body + "</p></article><footer>&copy; us</footer>"
    )
    weights = page_text.learn([html] * 5)
    assert page_text.extract(html, weights) == f"Head & tail\n{body}\n{body}"
    for odd in (None, "", "<p>", "<<>>", "<!-- x", "<nav><a>Menu</a></nav>"):
        assert page_text.extract(odd, weights) in ("", "<<>>")


WRAPPED = [
    "<body class='single no-sidebar'>{}</body>",
    "<body class='comments-open'><div>{}</div></body>",
    "<body><article class='post has-sidebar'>{}</article></body>",
    "<article class='related-post'>{}</article>",
    "<div class='with-banner'>{}</div>",
    "<form action=x>{}</form>",
    "<main class='has-sidebar'><article>{}</article></main>",
]


@pytest.mark.parametrize("wrap", WRAPPED)
def test_names_around_the_main_text_say_nothing(wrap):
    body = " ".join(f"word{i} goes on and on." for i in range(300))
    noise = "<nav>Home</nav>{}<footer>Imprint</footer>"
    weights = page_text.learn([noise.format(f"<article><p>{body}</p></article>")] * 5)
    parts = f"<p>{body}</p><div class='comments'><p>First! So good.</p></div><p>{body}</p>"
    assert page_text.extract(noise.format(wrap.format(parts)), weights) == f"{body}\n{body}"


def test_a_header_in_the_article_has_its_title():
    body = "Main words of the article go on for a while here. " * 9
    title = "A title of some length that says what the article is about"
    html = f"<header>Site</header><article><header><h1>{title}</h1></header><p>{body}</p></article>"
    assert page_text.extract(html, page_text.learn([html] * 5)) == f"{title}\n{body.strip()}"


def test_broken_pages_take_time_in_proportion():
    weights = page_text.learn(["<nav>a</nav><article><p>b c d</p></article>"] * 3)
    n = 30000
    odd = ["<a " * n, "<div>" * n + "</b>" * n, "<div><p>x" * n, "<nav>" * n + "x", '<a "' * n, "<!" * n]
    for html in odd:
        start = time.perf_counter()
        page_text.extract(html, weights)
        assert time.perf_counter() - start < 5, html[:10]


def test_page_text_of_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", "plain words " * 5), (2, "v", "plain words " * 5)]
    rows += [(3, "w", "<p>" + "long text here " * 200000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = page_text.main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got.collect())
    plain, long = ("plain words " * 5).strip(), ("long text here " * 200000).strip()
    assert texts == [
        (0, "", "", 0), (1, "u", "", 0), (1, "u", "", 0), (2, "v", plain, len(plain)),
        (2, "v", plain, len(plain)), (3, "w", long, len(long)),
    ]
    assert page_text.main_text(pages.limit(0)).count() == 0


def test_items_without_an_id_are_hit_but_not_listed(spark, docs):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, "nothing of it " * 9), (3, " ".join(words[:20]) + " own " * 30)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit(7))
    items = [(None, " ".join(words)), ("b", " ".join(words[2:18])), (None, None), ("c", "")]
    test = spark.createDataFrame(items, "item_id string, text string")
    found = winnowing.contamination(table, test).collect()
    got = {r.doc_id: (r.n_hit, list(r["items"]), r.contaminated) for r in found}
    assert got == {1: (40, ["b"], True), 2: (0, [], False), 3: (20, ["b"], True)}


def test_best_part_against_all_parts():
    rng = random.Random(4)
    for _ in range(200):
        scores = [rng.uniform(-2, 1) for _ in range(rng.randint(0, 12))]
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        start, end, score = page_text.best_part(scores)
        assert abs(score - max([0.0, *sums])) < 1e-9 and abs(sum(scores[start:end]) - score) < 1e-9


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    corpus = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    texts, toxic = toxicity.sample(corpus, labels, "toxic", "doc_id", "text")
    learn, rest = slice(0, None, 2), slice(1, None, 2)
    model = toxicity.fit(texts[learn], toxicity.grades(texts[learn], toxic[learn]))
    assert (np.diff(model.cuts) > 0).all()
    above = model.above(model.score(pa.array(texts[rest])))
    found, truth = above[:, 0] >= 0.5, np.array(toxic[rest]) > 0
    assert found[truth].mean() > 0.85 and found[~truth].mean() < 0.03
    assert (np.diff(above, axis=1) <= 0).all()


def test_toxicity_without_labels(spark, docs, empty):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.trained(docs, none)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all(r.severity == 0 and not r.toxic for r in rows)
    assert toxicity.score(empty, model).count() == 0
