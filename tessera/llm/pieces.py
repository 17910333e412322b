"""SentencePiece encoding and decoding with the byte span of every piece.

The normaliser walks the model's compiled character map (a double-array trie): at each
place the longest prefix that the map knows is replaced, anything else stays.  Blanks
become U+2581 and a dummy one is put in front, as the model asks.  For every normalised
byte it records where it came from, so the lengths of the pieces project to spans of the
original UTF-8 bytes.  Ids and decoded texts are the library's own.

Null texts count as empty: the end id alone, decoded to "".  Rows with a null doc_id and
repeated rows are encoded like any other; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lean, slices
from tessera.llm.words import vocabulary

MODEL = "piece_bpe_32k.model"
SLICE_CHARS = 2 << 20
BLANK = "▁"           # fixed value: the library's mark for a blank


class CharacterMap:
    """Longest-prefix replacement by a compiled character map (empty: every character stays)."""

    def __init__(self, blob: bytes):
        self.units, self.strings = np.zeros(0, np.uint32), b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", size // 4, 4)
            self.strings = blob[4 + size:]
        self.trie = self.units.tolist()
        self.memo: dict[bytes, tuple[bytes, int]] = {}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes it takes) of the longest known prefix of raw[at:]."""
        if not self.trie:
            return None
        node, found = self._offset(self.trie[0]), None
        for length in range(1, len(raw) - at + 1):
            byte = raw[at + length - 1]
            node ^= byte
            if node >= len(self.trie):
                break
            unit = self.trie[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (self.trie[node] & 0x7FFFFFFF, length)
        if found is None:
            return None
        start = found[0]
        return self.strings[start: self.strings.index(b"\0", start)], found[1]


class Normalizer:
    """Normalised bytes of a text and, for each of them and the end, the original byte offset."""

    def __init__(self, spec, whitespace_suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = (spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                                  spec.escape_whitespaces)
        self.suffix = whitespace_suffix
        self.blank = BLANK.encode() if self.escape else b" "
        self.plain = not self.map.trie and not self.squeeze

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        if not raw:
            return b"", np.zeros(1, np.int64)
        if self.plain:  # nothing is replaced but blanks
            data = np.frombuffer(raw, np.uint8)
            places = np.repeat(np.arange(len(raw)), np.where(data == 0x20, len(self.blank), 1))
            front = len(self.blank) if self.prefix and not self.suffix else 0
            back = len(self.blank) if self.prefix and self.suffix else 0
            return (self.blank * bool(front) + raw.replace(b" ", self.blank) + self.blank * bool(back),
                    np.concatenate([np.zeros(front, np.int64), places, np.full(back + 1, len(raw))]))
        return self._walk(raw)

    def _next(self, raw: bytes, at: int) -> tuple[bytes, int]:
        hit = self.map.longest(raw, at)
        if hit:
            return hit
        size = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
        return raw[at: at + size], size

    def _walk(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        at, out, places = 0, bytearray(), []
        if self.squeeze:
            while at < len(raw):
                text, size = self._next(raw, at)
                if text != b" ":
                    break
                at += size
            if at == len(raw):
                return b"", np.full(1, at)

        def put(text: bytes, place: int) -> None:
            out.extend(text)
            places.extend([place] * len(text))

        if self.prefix and not self.suffix:
            put(self.blank, at)
        after_blank = self.squeeze
        while at < len(raw):
            text, size = self._next(raw, at)
            if after_blank and self.squeeze:
                text = text.lstrip(b" ")
            if text:
                put(text.replace(b" ", self.blank), at)
                after_blank = text.endswith(b" ")
            at += size
            if not self.squeeze:
                after_blank = False
        if self.squeeze:
            while out.endswith(self.blank):
                at = places[len(out) - len(self.blank)]
                del out[-len(self.blank):], places[-len(self.blank):]
        if self.prefix and self.suffix:
            put(self.blank, at)
        return bytes(out), np.array([*places, at], np.int64)


class PieceEncoder:
    """Library ids of whole texts, each with its pieces' spans in the original bytes."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb
        if proto is None:
            with open(path, "rb") as f:  # a vocabulary file, installed on every worker
                proto = f.read()
        self.library = spm.SentencePieceProcessor(model_proto=proto)
        model = pb.ModelProto()
        model.ParseFromString(proto)
        self.normalizer = Normalizer(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix)
        byte = pb.ModelProto.SentencePiece.BYTE
        self.lengths = np.array([1 if p.type == byte else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown, self.end = self.library.unk_id(), self.library.eos_id()
        self.digits = [str(i) for i in range(len(model.pieces))]

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(begin, stop) bytes of each piece; the pieces cover the normalised text in order."""
        normal, places = self.normalizer(text.encode())
        sizes = self.lengths[ids] if ids else np.zeros(0, np.int64)
        if self.unknown in ids:  # an unknown piece is as long as what it stands for
            names = self.library.encode(text, out_type=str)
            sizes = np.array([n if i != self.unknown else len(p.encode())
                              for i, n, p in zip(ids, sizes.tolist(), names)], np.int64)
        stops = np.cumsum(sizes)
        if len(stops) and stops[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return places[stops - sizes], places[stops]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(ids with the end id, begins, stops) of each text; the end id stands after the last byte."""
        for text, ids in zip(texts, self.library.encode(texts, num_threads=1)):
            begin, stop = self.spans(text, ids)
            size = len(text.encode())
            yield [*ids, self.end], np.append(begin, size), np.append(stop, size)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _run(docs: DataFrame, model: str, schema: str, make) -> DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary(model))
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in slices(map(len, texts), SLICE_CHARS):
                cols = zip(*[make(enc, *got) for got in enc.encode(texts[lo:hi])])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *map(pa.array, cols)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run, 1), schema)


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, begins, stops): ids with the end id, and each piece's byte span in the text."""
    return _run(docs, model, "doc_id long, ids array<int>, begins array<long>, stops array<long>",
                lambda _, ids, begin, stop: (np.array(ids, np.int32), begin, stop))


def decoded(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of ``tokens(doc_id, ids)`` by the library; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary(model))
        for batch in batches:
            texts = [enc.library.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(lean(run), "doc_id long, text string")


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32) of a round trip of each text.

    ``spans_crc32`` is over the pieces' (begin, stop) as little-endian 64-bit numbers.
    """
    def make(enc: PieceEncoder, ids: list[int], begin: np.ndarray, stop: np.ndarray):
        digits = enc.digits
        return (len(ids), hashlib.sha256(" ".join([digits[i] for i in ids]).encode()).hexdigest(),
                hashlib.sha256(enc.library.decode(ids).encode()).hexdigest(),
                zlib.crc32(np.stack([begin, stop], axis=1).astype("<i8").tobytes()))

    return _run(docs, model, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long", make)
