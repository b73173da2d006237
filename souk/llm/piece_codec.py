"""SentencePiece encoding that keeps source offsets, and decoding.

A text is first normalised here: at each place the longest prefix that the model's compiled
character map knows is replaced (one character stays as it is where none is known), spaces
become the model's space mark, and for every normalised byte the byte of the source it came
from is noted. Pieces are encoded by the sentencepiece library. Laid end to end they are the
normalised text, so the noted places give each piece the bytes of the source it stands for.

Merges never cross the start of a word if no piece of the model has a space mark after another
character, which is tested when the model is loaded. Then words are encoded once and kept in a
bounded table; otherwise whole texts are encoded. Both ways are exact.

A null text is empty; an empty text has no pieces and decodes to an empty text. Repeated rows
are encoded alike, each on its own; texts of any length are encoded whole. Other columns are
left out, but for those named.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from sentencepiece import sentencepiece_model_pb2

from souk.llm import common

MARK = "▁"
# Encoded words above which a task forgets them, and words that are encoded in one call
KEPT_WORDS = 400_000
WORDS_AT_ONCE = 50


class CharacterMap:
    """Longest-prefix lookup in a compiled map: a double-array trie and the replacements.

    A trie unit holds the label in its low byte, or for a leaf the value with the top bit set;
    bit 8 tells that a leaf follows, the bits from 10 the offset, bit 9 that it is in 256s.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if blob else []
        self.texts = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """The bytes that the longest known prefix has, and what replaces them."""
        units, found = self.units, None
        at = self._offset(units[0])
        for length, byte in enumerate(data[start:], 1):
            at ^= byte
            if at >= len(units) or units[at] & 0x800000FF != byte:
                break
            unit = units[at]
            at ^= self._offset(unit)
            if unit & 0x100:
                found = length, units[at] & 0x7FFFFFFF
        if found is None:
            return None
        length, place = found
        return length, self.texts[place : self.texts.index(0, place)]


class Codec:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._load(file.read())

    @classmethod
    def of(cls, model: bytes) -> Codec:
        codec = cls.__new__(cls)
        codec._load(model)
        return codec

    def _load(self, raw: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(raw)
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.escape = spec.escape_whitespaces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.byte_ids = np.array([piece.type == kinds.BYTE for piece in model.pieces])
        self.sizes = np.array(
            [
                1 if piece.type == kinds.BYTE else len(piece.piece.encode())
                for piece in model.pieces
            ],
            np.int64,
        )
        names = np.array([f"{i},".encode() for i in range(len(model.pieces))])
        self._digits = names.view(np.uint8).reshape(len(names), -1)
        self.leads = np.array([piece.piece.startswith(MARK) for piece in model.pieces])
        self.by_word = (
            model.trainer_spec.model_type == model.trainer_spec.BPE
            and not self.map.units
            and self.prefix
            and not self.squeeze
            and self.escape
            and not self.suffix
            and self.byte_ids.sum() == 256
            and not any(
                piece.type == kinds.USER_DEFINED or MARK in piece.piece.lstrip(MARK)
                for piece in model.pieces
            )
        )
        self._kept: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each and the end the place in the source's bytes."""
        source = text.encode()
        if not source:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            return self._plain(source)
        parts, places, at = [], [], 0
        while at < len(source):
            found = self.map.longest(source, at) if self.map.units else None
            if found is None:
                first = source[at]
                length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                found = length, source[at : at + length]
            parts.append(found[1])
            places.append(at)
            at += found[0]
        places.append(len(source))
        return self._spaced(parts, places)

    def _spaced(self, parts: list[bytes], places: list[int]) -> tuple[bytes, np.ndarray]:
        """Joins replaced prefixes, with spaces squeezed, marked and led by one as the model asks."""
        mark = MARK.encode() if self.escape else b" "
        first, last = 0, len(parts)
        if self.squeeze:
            while first < last and parts[first] == b" ":
                first += 1
        if first == last:
            return b"", np.array([places[-1]], np.int64)
        out, source = bytearray(), []
        if self.prefix and not self.suffix:
            out += mark
            source += [places[first]] * len(mark)
        space = self.squeeze
        for part, place in zip(parts[first:last], places[first:last]):
            if space:
                part = part.lstrip(b" ")
            if part:
                for byte in part:
                    new = mark if byte == 0x20 else bytes([byte])
                    out += new
                    source += [place] * len(new)
                space = part.endswith(b" ")
            if not self.squeeze:
                space = False
        end = places[last]
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                end = source[-len(mark)]
                del source[-len(mark) :]
        if self.prefix and self.suffix:
            out += mark
            source += [end] * len(mark)
        return bytes(out), np.array([*source, end], np.int64)

    def _plain(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """The same where no prefix is replaced and no space squeezed."""
        mark = MARK.encode() if self.escape else b" "
        lead = mark if self.prefix and not self.suffix else b""
        tail = mark if self.prefix and self.suffix else b""
        data = np.frombuffer(source, np.uint8)
        width = np.where(data == 0x20, len(mark), 1)
        # Bytes of one character share its place, as its first byte does.
        place = np.arange(len(data))
        place[(data & 0xC0) == 0x80] = 0
        place = np.maximum.accumulate(place)
        inner = np.repeat(place, width)
        places = np.concatenate([np.zeros(len(lead), np.int64), inner])
        places = np.concatenate([places, np.full(len(tail) + 1, len(source))])
        return lead + source.replace(b" ", mark) + tail, places

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids, as bytes, of words without their mark; no word is empty or holds a mark.

        Many are encoded as one text. A word's first piece, and no other, starts with a mark.
        """
        texts = [" ".join(words[i : i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
        found = self.library.encode(texts, num_threads=1)
        ids = np.fromiter(chain.from_iterable(found), np.int32)
        at = 4 * np.append(np.flatnonzero(self.leads[ids]), len(ids))
        raw, at = ids.tobytes(), at.tolist()
        return {word: raw[a:b] for word, a, b in zip(words, at, at[1:])}

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its ids, and the bytes of the source where each piece starts and ends."""
        normal = [self.normalise(text) for text in texts]
        words = [data.decode().split(MARK)[1:] if self.by_word else [""] for data, _ in normal]
        # Marks in a row can be one piece, so texts that have some are encoded whole.
        simple = [all(own) for own in words]
        kept = self._kept
        if len(kept) > KEPT_WORDS:
            kept.clear()
        new = set().union(*(own for own, fit in zip(words, simple) if fit)).difference(kept)
        kept.update(self._learn(list(new)))
        for text, own, fit, (data, places) in zip(texts, words, simple, normal):
            if not fit:
                yield self._whole(text, data, places)
                continue
            ids = np.frombuffer(b"".join(map(kept.__getitem__, own)), np.int32)
            sizes = self.sizes[ids]
            ends = np.cumsum(sizes)
            yield ids, places[ends - sizes], places[ends]

    def joined(self, ids: np.ndarray) -> bytes:
        """The decimal ids, joined by commas."""
        digits = self._digits[ids].ravel()
        return digits[digits > 0].tobytes()[:-1]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return next(iter(self.encode_all([text])))

    def _whole(self, text: str, normal: bytes, places: np.ndarray):
        pieces = self.library.encode(text, return_type="proto").pieces if text else []
        ids = np.array([piece.id for piece in pieces], np.int32)
        # An unknown piece has its own text, so its size is not that of the id.
        sizes = [
            1 if self.byte_ids[piece.id] else len(piece.piece.encode()) for piece in pieces
        ]
        sizes = np.array(sizes, np.int64)
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("the pieces are not the normalised text")
        return ids, places[ends - sizes], places[ends]

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids) if len(ids) else ""


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


ENCODED = "ids array<int>, starts array<long>, ends array<long>, decoded string"
DIGESTS = (
    "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, n_bytes long"
)


def _over(docs: DataFrame, model: str, text: str, keep: list[str], columns: str, one) -> DataFrame:
    """One row for each document: the columns to keep, and what ``one`` makes of its text."""
    common.ready(docs.sparkSession)
    added = StructType.fromDDL(columns)
    schema = StructType([docs.schema[name] for name in keep] + added.fields)
    fields = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for part in common.steps(batch, text):
                texts = [value or "" for value in part.column(text).to_pylist()]
                rows = [one(codec, *encoded) for encoded in codec.encode_all(texts)]
                made = [pa.array(x, field.type) for x, field in zip(zip(*rows), fields)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(name) for name in keep] + made, names=schema.names
                )

    wanted = list(dict.fromkeys([*keep, text]))
    return docs.select(*wanted).mapInArrow(run, schema)


def encode(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None):
    """ids, starts and ends (bytes of the source) of the pieces, and the decoded text."""

    def one(codec: Codec, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        return ids, starts, ends, codec.decode(ids)

    return _over(docs, model, text, ["doc_id"] if keep is None else keep, ENCODED, one)


def digests(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None):
    """Digests of the same: of joined ids, of the decoded text, and of the spans.

    spans_sha256 is over the starts, then the ends, as little-endian 64-bit integers; n_bytes
    counts the source bytes from the first span to the last.
    """

    def one(codec: Codec, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        spans = sha256(starts.astype("<i8").tobytes())
        spans.update(ends.astype("<i8").tobytes())
        return (
            len(ids),
            sha256(codec.joined(ids)).hexdigest(),
            sha256(codec.decode(ids).encode()).hexdigest(),
            spans.hexdigest(),
            int(ends[-1] - starts[0]) if len(ids) else 0,
        )

    return _over(docs, model, text, ["doc_id"] if keep is None else keep, DIGESTS, one)
