"""Phrases whose words occur together more often than apart, by dynamic itemset counting.

Texts are dealt to ``SHARDS`` shards that are scanned in turn, again and again. Words are counted
from the first scan on. A phrase of two or three words starts to be counted in the scan after the
one in which both of its parts (all words but the last, all but the first) have come to
``MIN_COUNT`` occurrences, and is done after one full cycle of scans, so it meets each shard once,
in whatever scan it started. Scans end when no phrase waits for a shard.

When a part came to its count is kept in a table of ``CELLS`` bytes that goes to every task: the
cells of a frequent phrase hold the first scan in which phrases made of it are counted. A cell is
set once and never changed, so every task sees each phrase start in the same scan. Phrases that
start because others share their cells cost work, not correctness: counts are kept by the phrases
themselves. The table's size doesn't grow; where it fills up, more phrases are counted.

Each task reduces its slices of text to counts of different phrases before anything is shuffled,
so a frequent phrase is no hot key. The phrases of a slice that go to one part (by hash) are one row,
their texts on end, which shuffles at a few bytes for each; rows are taken apart in the part. After
a scan only the phrases that it counted are summed, over the scans that counted them.

Words are runs of anything but blanks, tabs and ``BREAKS``, in lower case by A-Z only; a phrase
doesn't cross one of ``BREAKS``, a text or a language. A null text has no words; a null language
is ``und``, like rows that say so. Repeated rows count each. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from souk.llm import common

MIN_COUNT = 10
SHARDS = 2
TOP = 2000
# Percent of a phrase's occurrences that lie in one longer phrase from which on it is dropped
INSIDE_PERCENT = 50
SCALE = 1000000
# Cells of the table of frequent parts, and the value of one that is not set
CELLS = 1 << 23
UNSET = 255
# Bytes of text that a task counts at once
SLICE_BYTES = 1 << 22
# Parts that the best of a language are first taken from
SALTS = 64

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(BLANKS + BREAKS)] = False
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(BREAKS)] = True

# Counts of phrases of one part, language, size and first scan; size 0 has the words of a language
COUNTS = "part int, lang string, size int, scan int, phrases string, counts array<int>"
# Parts of a table of PART_BYTES. They grow with the root of the input: their size grows too, but
# not as much, and so does the number of rows that a slice gives.
PARTS = 64
PART_BYTES = 1 << 24


def seeds(langs: list[str]) -> np.ndarray:
    digests = [blake2b(lang.encode(), digest_size=8).digest() for lang in langs]
    return np.frombuffer(b"".join(digests), np.uint64)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return common.mix(first * common.BASE + second)


def cells_of(hashes: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    return (low % np.uint64(cells)).astype(np.int64), (high % np.uint64(cells)).astype(np.int64)


def since(starts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The first scan in which phrases made of the hashed ones are counted, or UNSET."""
    one, two = cells_of(hashes, len(starts))
    return np.maximum(starts[one], starts[two])


class Slice:
    """The words of some texts and the phrases to count in one scan."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = common.flat(texts)
        begin, end = common.runs(_IS_WORD[data], offsets)
        lengths = end - begin
        ends = np.concatenate([[0], np.cumsum(lengths)])
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin),
            [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[_IS_WORD[data]])],
        ).dictionary_encode()
        self.words = packed.dictionary.cast(pa.large_string())
        self.word = packed.indices.to_numpy().astype(np.int64)
        text = np.searchsorted(offsets, begin, "right") - 1
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy().astype(np.int64)[text]
        broken = np.cumsum(_IS_BREAK[data], dtype=np.int32)
        # Whether a word and the next are in one piece
        self.joined = (text[1:] == text[:-1]) & (broken[begin[1:]] == broken[end[:-1] - 1])

    def __len__(self) -> int:
        return len(self.word)

    def hashes(self) -> np.ndarray:
        """One for every word, its language included."""
        data, offsets = common.flat(self.words.cast(pa.large_binary()))
        own = common.Substrings(data)(offsets[:-1], offsets[1:])
        return common.mix(own[self.word] + seeds(self.langs.to_pylist())[self.lang])

    def counted(
        self, places: np.ndarray, size: int, hashes: np.ndarray, first_scan: np.ndarray, parts: int
    ) -> pa.RecordBatch:
        """Counts of the different phrases of ``size`` words that start at these places.

        ``hashes`` and ``first_scan`` are those of the phrase at each place.
        """
        key = self.word[places] * len(self.langs) + self.lang[places]
        for step in range(1, size):
            _, key = np.unique(key, return_inverse=True)
            key = key * len(self.words) + self.word[places + step]
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        at, part = places[first], (hashes[first] % np.uint64(parts)).astype(np.int64)
        group = (part * len(self.langs) + self.lang[at]) * (UNSET + 1) + first_scan[first]
        order = np.argsort(group, kind="stable")
        group, at, n = group[order], at[order], n[order]
        words = [self.words.take(pa.array(self.word[at + step])) for step in range(size)]
        phrases = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        return self._rows(size, group[begin], np.append(begin, len(group)), phrases, n)

    def totals(self) -> pa.RecordBatch:
        """The number of words of each language."""
        n = np.bincount(self.lang, minlength=len(self.langs))
        group = np.arange(len(self.langs)) * (UNSET + 1)
        phrases = pa.array([""] * len(n), pa.large_string())
        return self._rows(0, group, np.arange(len(n) + 1), phrases, n)

    def _rows(self, size: int, group: np.ndarray, bounds, phrases, n) -> pa.RecordBatch:
        """One row for each group of the phrases; groups are of part, language and first scan."""
        bounds = pa.array(bounds.astype(np.int32))
        texts = pc.binary_join(pa.ListArray.from_arrays(bounds, phrases.cast(pa.string())), "\n")
        lang = group // (UNSET + 1) % len(self.langs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array((group // (UNSET + 1) // len(self.langs)).astype(np.int32)),
                self.langs.take(pa.array(lang)).cast(pa.string()),
                pa.array(np.full(len(group), size, np.int32)),
                pa.array((group % (UNSET + 1)).astype(np.int32)),
                texts,
                pa.ListArray.from_arrays(bounds, pa.array(n.astype(np.int32))),
            ],
            names=["part", "lang", "size", "scan", "phrases", "counts"],
        )

    def scanned(self, scan: int, shards: int, starts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
        """Counts of the phrases that this scan is one of the full cycle of."""
        hashes = self.hashes()
        if scan < shards:
            yield self.totals()
            places = np.arange(len(self))
            yield self.counted(places, 1, hashes, np.zeros(len(self), np.int64), parts)
        if not scan or len(self) < 2:
            return
        # A phrase starts with the later of its parts.
        word = since(starts, hashes).astype(np.int64)
        pair = np.where(self.joined, np.maximum(word[1:], word[:-1]), UNSET)
        known = np.flatnonzero(pair <= scan)
        pairs = pair_hash(hashes[known], hashes[known + 1])
        now = scan < pair[known] + shards
        if now.any():
            yield self.counted(known[now], 2, pairs[now], pair[known[now]], parts)
        triple = np.maximum(pair[known], since(starts, pairs))
        next_ = np.flatnonzero(known[1:] == known[:-1] + 1)
        first_scan = np.maximum(triple[next_], triple[next_ + 1])
        now = (first_scan <= scan) & (scan < first_scan + shards)
        next_, first_scan = next_[now], first_scan[now]
        if len(next_):
            at = known[next_]
            yield self.counted(at, 3, pair_hash(pairs[next_], hashes[at + 2]), first_scan, parts)


def scanned(shard: DataFrame, scan: int, shards: int, starts: np.ndarray, parts: int) -> DataFrame:
    """Counts of a scan over the texts (lang, text) of a shard."""
    sent = shard.sparkSession.sparkContext.broadcast(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.steps(batch, "text", SLICE_BYTES):
                own = Slice(part.column("text"), part.column("lang"))
                if len(own):
                    yield from own.scanned(scan, shards, sent.value, parts)

    return shard.select("lang", "text").mapInArrow(run, COUNTS)


def summed(counts: DataFrame) -> DataFrame:
    """(lang, size, phrase, scan, n) of the phrases in counts."""
    # Rows come to their part as they are, so phrases are grouped there without a shuffle of theirs.
    phrase = F.split("phrases", "\n").alias("phrase")
    rows = counts.repartition("part").select(
        "part", "lang", "size", "scan", F.inline(F.arrays_zip(phrase, F.col("counts").alias("n")))
    )
    return rows.groupBy("part", "lang", "size", "phrase", "scan").agg(F.sum("n").alias("n")).drop("part")


def found_cells(phrases: DataFrame, cells: int) -> np.ndarray:
    """The cells of the phrases (lang, phrase) of one or two words, as a mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = common.flat(batch.column("phrase"))
            begin, end = common.runs(data != ord(" "), offsets)
            text = np.searchsorted(offsets, begin, "right") - 1
            coded = batch.column("lang").dictionary_encode()
            lang = seeds(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            own = common.mix(common.Substrings(data)(begin, end) + lang[text])
            first = np.searchsorted(text, np.arange(batch.num_rows))
            last = np.append(first[1:], len(text)) - 1
            hashes = np.where(first == last, own[first], pair_hash(own[first], own[last]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.unique(np.concatenate(cells_of(hashes, cells))))], names=["cell"]
            )

    found = phrases.select("lang", "phrase").mapInArrow(run, "cell long")
    # At most CELLS / 64 rows come to the driver.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("cell") % 64).cast("int"))
    words = found.groupBy(F.floor(F.col("cell") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
    table = words.toArrow()
    mask = np.zeros(cells // 64, np.int64)
    mask[table["word"].to_numpy()] = table["bits"].to_numpy()
    return np.unpackbits(mask.view(np.uint8), bitorder="little").view(bool)


def frequent(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = MIN_COUNT,
    shards: int = SHARDS,
    cells: int = CELLS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n) of all phrases of one to three words with ``least`` occurrences or
    more, and (lang, total) with the occurrences of all words of languages with as many."""
    common.ready(docs.sparkSession)
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower())
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        lower.alias("text"), dealt.alias("shard"),
    )
    size = Observation()
    texts = texts.where("text <> ''").observe(size, F.sum(F.octet_length("text")).alias("bytes"))
    texts = common.written(texts, "shards", by="shard")
    parts = PARTS * max(1, round(math.sqrt((size.get["bytes"] or 0) / PART_BYTES)))
    starts = np.full(cells, UNSET, np.uint8)
    scans: list[DataFrame] = []
    done: list[DataFrame] = []
    newest = 0
    while len(scans) < newest + shards:
        scan = len(scans)
        counts = scanned(texts.where(F.col("shard") == scan % shards), scan, shards, starts, parts)
        scans.append(common.written(counts, f"scan_{scan}"))
        # Words and pairs get new occurrences in the first two cycles only.
        if scan < 2 * shards:
            own = F.col("scan").between(scan - shards + 1, scan) & (F.col("size") < 3)
            counted = summed(_all(scans[-shards:]).where(own)).where(F.col("n") >= least)
            counted = common.written(counted, f"counted_{scan}")
            done.append(counted.where(F.col("scan") == scan - shards + 1))
            new = found_cells(counted.where("size > 0"), cells) & (starts == UNSET)
            if new.any():
                newest = scan + 1
                starts[new] = newest
    triples = summed(_all(scans).where("size = 3")).where(F.col("n") >= least)
    found = common.written(_all([*done, triples]).drop("scan"), "frequent")
    totals = found.where("size = 0").select("lang", F.col("n").alias("total"))
    return found.where("size > 0"), totals


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _whole(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def judged(found: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one takes the place of.

    ``found`` is the first table of ``frequent``.
    """

    def piece(lo: int, hi: int) -> Column:
        return F.array_join(F.slice("words", lo, hi - lo), " ")

    def part(role: str, lo: int, hi: int) -> Column:
        return F.struct(F.lit(role).alias("role"), piece(lo, hi).alias("part"))

    words = found.where("size > 1").withColumn("words", F.split("phrase", " "))
    two = F.array(part("l1", 1, 2), part("r1", 2, 3))
    three = F.array(part("l1", 1, 2), part("r1", 2, 4), part("l2", 1, 3), part("r2", 3, 4))
    parts = words.select(
        "lang", "phrase", F.inline(F.when(F.col("size") == 2, two).otherwise(three))
    )
    counts = found.select("lang", F.col("phrase").alias("part"), F.col("n").alias("value"))
    # Both sides are written tables, so Spark can split a word that many phrases have.
    values = parts.join(counts, ["lang", "part"]).select("lang", "phrase", "role", "value")
    own = words.select("lang", "phrase", F.lit("a").alias("role"), F.col("n").alias("value"))
    longer = words.where("size = 3").select(
        "lang", F.explode(F.array(piece(1, 3), piece(2, 4))).alias("phrase"),
        F.lit("longer").alias("role"), F.col("n").alias("value"),
    )
    roles = ("a", "l1", "r1", "l2", "r2", "longer")
    rows = values.unionByName(own).unionByName(longer).groupBy("lang", "phrase").agg(
        *[F.max(F.when(F.col("role") == role, F.col("value"))).alias(role) for role in roles]
    )
    rows = rows.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))

    def cut(k: int) -> Column:
        """Score, place and parts of a cut; null where the phrase has none there."""
        a, l, r = _whole("a"), _whole(f"l{k}"), _whole(f"r{k}")
        square = (F.lit(SCALE).cast("decimal(7,0)") * a * a).cast("decimal(38,0)")
        score = F.call_function("div", square, (l * r).cast("decimal(38,0)"))
        cells = F.struct(
            score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")
        )
        return F.when(F.col(f"l{k}").isNotNull(), cells)

    return rows.withColumn("cut", F.least(cut(1), cut(2))).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def best(scored: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first of each language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of a few parts of a language, then of those.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    parts = scored.withColumn("salt", salt)
    place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    parts = parts.withColumn("rank", place).where(F.col("rank") <= top).drop("rank", "salt")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = parts.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def mined(docs: DataFrame, top: int = TOP, **how) -> DataFrame:
    """The best collocations of each language; ``how`` goes to ``frequent``."""
    found, totals = frequent(docs, **how)
    return best(judged(found), totals, top)


ORACLE_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, row_number() over () as piece,
        list_filter(string_split_regex(p, '[ \t]'), lambda w: w <> '') as w
    from (
        select lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as p
        from documents
    )
),
f as (
    select lang, size, phrase, count(*) as n
    from (
        select lang, size, unnest([array_to_string(w[i:i + size - 1], ' ')
            for i in range(1, len(w) - size + 2)]) as phrase
        from pieces, (values (1), (2), (3)) s(size)
    )
    group by all
),
totals as (select lang, sum(n)::bigint as n from f where size = 1 group by lang),
candidates as (
    select lang, size, phrase, n as a, string_split(phrase, ' ') as w from f where size > 1 and n >= 10
),
cuts as (
    select c.*, k, array_to_string(w[:k], ' ') as head, array_to_string(w[k + 1:], ' ') as tail
    from candidates c, (values (1), (2)) s(k) where k < size
),
scored as (
    select c.lang, c.phrase, c.size, a, k, l.n as l, r.n as r,
        (1000000::hugeint * a * a // (l.n::hugeint * r.n))::bigint as score
    from cuts c join f l on l.lang = c.lang and l.phrase = head
    join f r on r.lang = c.lang and r.phrase = tail
),
lowest as (
    select * from scored
    qualify row_number() over (partition by lang, phrase order by score, k) = 1
),
longer as (
    select lang, phrase, max(n) as n
    from (select lang, a as n, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')])
        as phrase from candidates where size = 3)
    group by all
),
ranked as (
    select s.*, row_number() over (
        partition by s.lang order by score desc, a desc, s.phrase) as rank
    from lowest s left join longer b on b.lang = s.lang and b.phrase = s.phrase
    where b.n is null or 100 * b.n < 50 * a
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
