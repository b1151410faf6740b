"""Byte-level BPE through a sentencepiece BPE model that is serialised directly from a vocabulary of ranks.

Every token's bytes become printable characters, one for one; the model has these pieces with the score -rank and no
normalisation, prefix or white-space rule, so sentencepiece merges in rank order.  Each match of the pre-token pattern
is encoded by itself; a match that is a token as a whole is that token, as in tiktoken.  Decoding maps ids back to
bytes.  Special tokens' strings are ordinary text.

Null and empty texts have no ids and decode to empty bytes; a text may have any length; every row is encoded by itself, so
repeated rows repeat their ids; an empty table gives no rows; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import struct
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame

from . import shared
from .chunks import Chunks


@cache
def byte_characters() -> str:
    """A printable character for each byte: itself where printable Latin-1, else the next from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in plain else chr(next(rest)) for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from lines of base64 and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One field on the protobuf wire: float as 32 bits, int as varint, else length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialised_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: piece 0 is the unknown one, piece r + 1 the token of rank r."""
    table = byte_characters()
    pieces = [_field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)]
    pieces += [_field(1, "".join(table[b] for b in t)) + _field(2, -float(r)) + _field(3, 1) for r, t in enumerate(tokens)]
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, 0)  # model_type BPE, vocab_size, unk_id
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, nothing removed or escaped
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    def __init__(self, path: str, pattern: str):
        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(tokens))
        self.matches = regex.compile(pattern).findall
        self.latin = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        self.whole = {t.decode("latin-1").translate(self.latin): r for r, t in enumerate(tokens)}
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.chunks = Chunks(self._chunk_ids, 390_000)  # the model beside it takes its room; arrays stay within 2 ** 19 entries

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        mapped = [[m.encode().decode("latin-1").translate(self.latin) for m in self.matches(c)] for c in chunks]
        whole = self.whole
        rest = list({m for c in mapped for m in c if m not in whole})
        known = dict(zip(rest, ([i - 1 for i in x] for x in self.model.encode(rest, out_type=int, num_threads=1)), strict=True)) if rest else {}
        ids = [[i for m in c for i in ((whole[m],) if m in whole else known[m])] for c in mapped]
        return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and len + 1 offsets of the texts among them."""
        return self.chunks(*shared.utf8(column))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        n = self.lengths[ids]
        return self.bytes[np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(path: str, pattern: str) -> Codec:
    """One for each Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (ranks), a row per document."""

    def run(batches):
        codec = _codec(path, pattern)
        for batch in batches:
            for part in shared.pieces(batch):
                ids, ends = codec.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))], ["doc_id", "ids"])

    return shared.id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for."""

    def run(batches):
        codec = _codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column("ids")
                flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *pc.list_value_length(ids).fill_null(0).to_pylist()])
                size = np.concatenate([[0], np.cumsum(codec.lengths[flat])])[ends]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(codec.decode(flat))])], ["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, and restored: whether decoding the ids gives the text's bytes, a row per document."""

    def run(batches):
        codec = _codec(path, pattern)
        for batch in batches:
            for part in shared.pieces(batch):
                ids, ends = codec.encode(part.column("text"))
                raw, offsets = shared.utf8(part.column("text"))
                restored = pa.array([np.array_equal(codec.decode(ids[i:j]), raw[a:b]) for i, j, a, b in zip(ends[:-1], ends[1:], offsets[:-1], offsets[1:], strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), restored], ["doc_id", "ids", "restored"])

    return shared.id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, restored boolean")
