"""Secret scans: fixed patterns, and novelty against a primed zstandard compressor.

Patterns are searched in the UTF-8 bytes: assigned values, access keys and hexadecimal strings.
Beyond them, each string of ``MIN_NOVEL`` or more key characters that has letters and digits and
follows a sensitive word on its line is a candidate. A compressor is primed with a dictionary of
common identifiers and the text around the candidate, but for its other places that follow a
sensitive word. The bytes that the candidate adds to compressed text are its novelty; those that
add nearly all of their length (``MIN_NOVELTY``) share nothing with names or text nearby and are
reported as kind "novel", at all of their sensitive places.

Spans are in code points, end exclusive. Null or empty texts have none. Repeated rows are
scanned alike, each on its own; texts are scanned whole. Other columns are left out, but for
those named.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm import common

KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 12, 18, 16
ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{%d,}" % MIN_HEX)
# Parts that every assignment has, in lower case
ASSIGN_PARTS = (b"passw", b"secret", b"token", b"api")

MIN_NOVEL = 16
MIN_NOVELTY = 0.9
# Bytes around a candidate that prime the compressor
AROUND = 1024
# Bytes that zstandard never entropy-codes, so that random ones cost their length
PIECE = 63
# Bytes of the header of a compressed block
HEADER = 3
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_NOVEL)
DIGIT = re.compile(rb"[0-9]")
LETTER = re.compile(rb"[A-Za-z]")
SENSITIVE = re.compile(
    rb"(?i)pass|secret|token|key|auth|credential|private|bearer|signature|salt|cookie|session"
)
# Names that code and configuration use often
IDENTIFIERS = b" ".join(
    b"""
    access account address algorithm application apikey argument array assert async attribute
    authorization await background base64 boolean bucket buffer build bytes cache callback
    certificate class client cluster column command comment commit component config connection
    console const constructor container content context cookie count create credentials current
    customer data database datetime debug decode default delete description digest directory
    document domain double element email enable encode encoding endpoint entity enum environment
    error event exception export extends factory false field file filter final float folder format
    function gateway generate getter github global group handler hash header hidden host hostname
    http https identifier image import include index input insert instance integer interface
    internal item iterator json lambda language length level library license line link list
    listener local localhost location logger login main manager master message method middleware
    migration model module mutable namespace network node null number object option order output
    override package parameter parent parse password path pattern payload permission port prefix
    primary private process production profile project property protected protocol provider proxy
    public query queue random reader record redirect reference region register release remote
    render repository request required resource response result return role route runtime sample
    scheduler schema scope script search secret section select self server service session setting
    signature source stack start state static status storage stream string struct suffix super
    system table target task template temporary test text thread timeout timestamp title token
    total transaction true type undefined unique update upload user username utils uuid valid value
    variable version view void volume warning webhook widget width window worker writer yield
    0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
    """.split()
)

Span = tuple[str, int, int]


def novelty(candidate: bytes, around: bytes) -> float:
    """Bytes that the candidate adds to compressed text, as a share of its own.

    A long candidate is measured in pieces, each after the ones before it: as a whole, random
    characters of a small alphabet would be entropy-coded and fall short of their length.
    """
    primed = zstandard.ZstdCompressionDict(
        IDENTIFIERS + b"\n" + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    compressor = zstandard.ZstdCompressor(
        level=3, dict_data=primed, write_content_size=False, write_dict_id=False
    )
    if len(candidate) >= PIECE:
        stream = compressor.compressobj(size=len(candidate) + 1)
        stream.compress(b" ")
        stream.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)
        added = 0
        for at in range(0, len(candidate), PIECE):
            out = stream.compress(candidate[at : at + PIECE])
            out += stream.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)
            added += len(out) - HEADER
        return added / len(candidate)
    without, with_it = compressor.compress(b" "), compressor.compress(b" " + candidate)
    return (len(with_it) - len(without)) / len(candidate)


def base_spans(raw: bytes) -> list[Span]:
    """The fixed patterns' spans in bytes."""
    found: list[Span] = []
    low = raw.lower()
    if any(part in low for part in ASSIGN_PARTS):
        for match in ASSIGN.finditer(raw):
            if match.end(2) - match.start(2) >= MIN_ASSIGNED:
                found.append(("assign", *match.span()))
    if b"AKIA" in raw:
        for match in ACCESS.finditer(raw):
            if match.end() - match.start() >= MIN_ACCESS:
                found.append(("access", *match.span()))
    found += [("hex", *match.span()) for match in HEX.finditer(raw)]
    return found


def contexts(raw: bytes) -> list[tuple[int, int]]:
    """On each line with a sensitive word, the place after the first one and the line's end."""
    found, at = [], 0
    while match := SENSITIVE.search(raw, at):
        at = raw.find(b"\n", match.end())
        at = len(raw) if at < 0 else at
        found.append((match.end(), at))
    return found


def primer(raw: bytes, start: int, end: int, sensitive: Callable[[int], bool]) -> bytes:
    """The text around a candidate without the candidate's other places in a sensitive context."""
    text, parts = raw[start:end], []
    low, high = max(0, start - AROUND), end + AROUND
    # Copies may lie across the ends of what primes the compressor.
    at, place = low, raw.find(text, max(0, low - len(text) + 1), high + len(text))
    while 0 <= place < high:
        if place == start or sensitive(place):
            parts.append(raw[at:place])
            at = place + len(text)
            place = raw.find(text, at, high + len(text))
        else:
            place = raw.find(text, place + 1, high + len(text))
    return b"\n".join([*parts, raw[at:high]])


def novel_spans(raw: bytes, taken: list[Span]) -> list[Span]:
    """Incompressible strings in a sensitive context that no pattern found, in bytes."""
    found: list[Span] = []
    if not DIGIT.search(raw):
        return found
    lines: list[tuple[int, int]] | None = None
    # Where the taken spans begin, and where the longest so far ends
    begins = sorted(a for _, a, _ in taken)
    ends = list(accumulate((b for _, _, b in sorted(taken, key=lambda x: x[1])), max))

    def sensitive(place: int) -> bool:
        line = bisect_right(lines, (place, len(raw))) - 1
        return line >= 0 and place <= lines[line][1]

    for match in CANDIDATE.finditer(raw):
        start, end = match.span()
        text = match.group()
        if not (DIGIT.search(text) and LETTER.search(text)):
            continue
        if lines is None:
            lines = contexts(raw)
        if not sensitive(start):
            continue
        before = bisect_left(begins, end)
        if before and ends[before - 1] > start:
            continue
        if novelty(text, primer(raw, start, end, sensitive)) >= MIN_NOVELTY:
            found.append(("novel", start, end))
    return found


def scan(raw: bytes) -> list[Span]:
    """All spans of a text in code points, by start, then kind."""
    found = base_spans(raw)
    found += novel_spans(raw, found)
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    if not found or raw.isascii():
        return found
    places = sorted({place for _, a, b in found for place in (a, b)})
    points, at, count = {}, 0, 0
    for place in places:
        count += len(raw[at:place].decode())
        points[place], at = count, place
    return [(kind, points[a], points[b]) for kind, a, b in found]


SPANS = "spans array<struct<kind:string,start:int,stop:int>>"


def secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The named columns and the spans found in each row's text."""
    common.ready(docs.sparkSession)
    names = ["doc_id"] if keep is None else keep
    schema = StructType([docs.schema[name] for name in names] + StructType.fromDDL(SPANS).fields)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(text):
                raw = value.as_buffer()
                own = scan(raw.to_pybytes()) if raw is not None else []
                found.append([{"kind": k, "start": a, "stop": b} for k, a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in names] + [pa.array(found, pa.list_(span))],
                names=[*names, "spans"],
            )

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    found = secrets(docs)

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
        return F.array_join(parts, ",")

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
