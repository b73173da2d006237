"""Main text of web pages as a maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score above zero, the more the likelier
their innermost element holds main text; tags score below zero, the more the likelier they stand
outside of it. One linear scan finds the contiguous part with the greatest sum.

The scores come from labelled pages: those whose own markup names their main part by exactly one
``article`` or ``main`` element, a bounded sample of ``SAMPLE_PAGES`` pages of at most
``SAMPLE_BYTES`` bytes, by a hash of the page. Elements are told apart by name and class; unseen
classes go by their name, unseen names by all pages.

Within the part found, elements that are not main text by name or by class are left out, but for
those around it, which hold at least ``AROUND`` of its words: names and classes of a body, a form or
a wrapper say nothing about what they wrap. A header is left out only outside of article and main.
Character references are decoded; white space in a block becomes one space; blocks are joined by
a line feed. A null or empty page, or one whose best part scores below ``MIN_SCORE``, has an
empty text. Repeated rows are read alike, each on its own. Without labelled pages all words
score alike and so do all tags. Other columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import common

SAMPLE_PAGES = 400
SAMPLE_BYTES = 100_000
# What a tag outside of main text costs, and what any word or tag counts at least
TAG_COST = 3.0
LEAST = 0.01
MIN_SCORE = 0.5
# Share of the part's words that an element around it holds
AROUND = 0.9

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe)\b(?:\"[^\"]*\"|'[^']*'|[^\"'<>])*>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'<>])*)>"
    r"|<[!?][^<>]*>"
    r"|([^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Elements that do not end a block
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp
    small span strike strong sub sup time tt u var wbr""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements and classes that are never main text
NEVER = frozenset(
    "nav header footer aside form button select option menu dialog head title".split()
)
NEVER_CLASS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|popup|modal"
    r"|newsletter|subscribe|menu|nav|navbar|navigation|breadcrumbs?|sidebar|widget|share|social"
    r"|comments?|replies|respond|footer|header|masthead|related)(?:$|[\s_-])",
    re.I,
)


class Item:
    """A tag, or the words between two tags: key of the element, text and number of words (text
    is None for a tag), block, number of the innermost element to be left out, and depth within
    article or main.

    Words in a row have one element and so one score; the best part never starts or ends among
    them, hence they are one item.
    """

    __slots__ = ("key", "text", "words", "block", "out", "mark")

    def __init__(self, key, text, words, block, out, mark):
        self.key, self.text, self.words = key, text, words
        self.block, self.out, self.mark = block, out, mark


class Open:
    """The open elements. All steps take the same time, but for closing several at once."""

    def __init__(self):
        # (name, key, what `out` was before)
        self.stack: list[tuple[str, str, int]] = []
        self.places: dict[str, list[int]] = {}
        # Open elements that are neither inline nor a paragraph, up to each place
        self.blocks: list[int] = [0]
        # Elements to be left out have numbers from 1; the innermost open one, and the one around each
        self.out = 0
        self.around = [0]
        self.mark = 0

    def add(self, name: str, key: str, left: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.blocks.append(self.blocks[-1] + (name not in INLINE and name != "p"))
        self.mark += name in ("article", "main")
        self.stack.append((name, key, self.out))
        if left:
            self.around.append(self.out)
            self.out = len(self.around) - 1

    def last(self, name: str) -> int | None:
        places = self.places.get(name)
        return places[-1] if places else None

    def close(self, at: int) -> None:
        """Closes the element at a place and all within."""
        while len(self.stack) > at:
            name, _, self.out = self.stack.pop()
            self.places[name].pop()
            self.blocks.pop()
            self.mark -= name in ("article", "main")

    def close_paragraph(self) -> None:
        """A new paragraph ends an open one, if only inline elements are open in it."""
        at = self.last("p")
        if at is not None and self.blocks[at] == self.blocks[-1]:
            self.close(at)


def items(html: str) -> tuple[list[Item], list[int]]:
    """The words and tags of a page in order, and for each element to be left out the next such
    around it."""
    found: list[Item] = []
    open_ = Open()
    block = 0
    for match in TOKEN.finditer(html):
        raw, closing, name, rest, text = match.groups()
        if text is not None:
            key = open_.stack[-1][1] if open_.stack else ""
            if "&" in text:
                text = unescape(text)
            found.append(Item(key, text, len(text.split()), block, open_.out, open_.mark))
            continue
        if name is None:
            continue
        name = name.lower()
        names = " ".join(x for y in NAMES.findall(rest) for x in y if x).lower()
        key = f"{name} {names}".strip()
        if name == "br":
            found.append(Item("br", None, 0, block, open_.out, open_.mark))
            found.append(Item("br", " ", 0, block, open_.out, open_.mark))
            continue
        if name not in INLINE:
            block += 1
        if closing:
            at = open_.last(name)
            if at is not None:
                key = open_.stack[at][1]
                open_.close(at)
            found.append(Item("/" + key, None, 0, block, open_.out, open_.mark))
        else:
            found.append(Item(key, None, 0, block, open_.out, open_.mark))
            if name not in VOID and not rest.rstrip().endswith("/"):
                if name == "p":
                    open_.close_paragraph()
                never = name in NEVER and not (name == "header" and open_.mark)
                open_.add(name, key, never or bool(NEVER_CLASS.search(names)))
    return found, open_.around


def hidden(part: list[Item], around: list[int]) -> list[bool]:
    """Whether what is in each element to be left out goes: not if all open ones are around the
    part, rather than in it."""
    words = [0] * len(around)
    for x in part:
        if x.text is not None:
            words[x.out] += x.words
    total = sum(words)
    # Elements come after those around them.
    for number in range(len(around) - 1, 0, -1):
        words[around[number]] += words[number]
    gone = [False] * len(around)
    for number in range(1, len(around)):
        gone[number] = gone[around[number]] or words[number] < AROUND * total
    return gone


def _names(key: str) -> Iterator[str]:
    """The key itself, then the name of its element alone."""
    yield key
    if " " in key:
        yield key.split(" ", 1)[0]


Weights = dict[str, dict[str, float]]


def learn(pages: list[str]) -> Weights:
    """Scores of words by element and of tags, from pages that name their main part."""
    seen = {kind: (Counter(), Counter()) for kind in ("word", "tag")}
    for html in pages:
        found, _ = items(html)
        opened = sum(x.text is None and x.key.split(" ")[0] in ("article", "main") for x in found)
        if opened != 1:
            continue
        for x in found:
            kind = "tag" if x.text is None else "word"
            for key in {"*", *_names(x.key)}:
                seen[kind][x.mark > 0][key] += 1 if x.text is None else x.words
    weights: Weights = {}
    for kind, (outside, inside) in seen.items():
        weights[kind] = {
            key: (inside[key] + 0.5) / (inside[key] + outside[key] + 1)
            for key in {*outside, *inside}
        }
    return {
        "word": {key: max(LEAST, p) for key, p in weights["word"].items()},
        "tag": {key: -max(LEAST, TAG_COST * (1 - p)) for key, p in weights["tag"].items()},
    }


def best_part(scores: list[float]) -> tuple[int, int, float]:
    """Start and end of the contiguous part with the greatest sum, and that sum."""
    best, best_start, best_end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_start, best_end = total, start, i + 1
    return best_start, best_end, best


def _scores(found: list[Item], weights: Weights) -> list[float]:
    defaults = {
        "word": weights.get("word", {}).get("*", 1.0),
        "tag": weights.get("tag", {}).get("*", -1.0),
    }
    known: dict[tuple[str, str], float] = {}
    out = []
    for x in found:
        kind = "tag" if x.text is None else "word"
        score = known.get((kind, x.key))
        if score is None:
            own = weights.get(kind, {})
            score = next((own[key] for key in _names(x.key) if key in own), defaults[kind])
            known[kind, x.key] = score
        out.append(score if x.text is None else score * x.words)
    return out


def extract(html: str | None, weights: Weights) -> str:
    """The main text of a page."""
    found, around = items(html or "")
    start, end, score = best_part(_scores(found, weights))
    if score < MIN_SCORE:
        return ""
    part = found[start:end]
    gone = hidden(part, around)
    blocks: dict[int, list[str]] = {}
    for x in part:
        if x.text is not None and not gone[x.out]:
            blocks.setdefault(x.block, []).append(x.text)
    texts = (" ".join("".join(own).split()) for own in blocks.values())
    return "\n".join(text for text in texts if text)


def labelled(pages: DataFrame, html: str = "html") -> list[str]:
    """The bounded sample of pages to learn from."""
    named = F.lower(html).rlike(r"<(article|main)[\s>]") & (F.octet_length(html) <= SAMPLE_BYTES)
    rows = pages.where(named).select(F.xxhash64(html).alias("h"), F.col(html).alias("html"))
    # Only hashes are put in order, and few of them, so that no page is sent in vain.
    least = rows.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES)
    found = rows.join(F.broadcast(least), "h").groupBy("h").agg(F.min("html").alias("html"))
    return sorted(row.html for row in found.collect())


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    common.ready(pages.sparkSession)
    weights = learn(labelled(pages)) if weights is None else weights
    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html, weights) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
