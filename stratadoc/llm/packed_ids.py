"""Token-ID output in fixed-width binary files.

Every id takes the fewest bits that hold the vocabulary's largest id.  Ids are packed in blocks of ``BLOCK`` ids, each a
whole number of bytes; the footer has the byte offset of every block and, for every document, its id and the place of
its first token.  Any range of tokens is read by fetching its blocks alone and unpacking them with numpy.

Layout (little-endian): magic, payload blocks, footer (block offsets u64, doc_ids i64, starts u64 with the end last),
then bits u32, block ids u32, n_ids u64, n_docs u64, payload end u64, magic.

Documents are range-partitioned and sorted by doc_id (null ids first; repeated ids stay neighbours), one file a
partition.  A task writes under a name of its own; only files of successful tasks enter the manifest, so retried or
duplicate tasks do no harm.  Null and empty texts have only the end id; an empty table has no file; a text may have any
length; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .chunks import Chunks

MAGIC, BLOCK = b"PACKIDS1", 4096
_TAIL = struct.Struct("<IIQQQ8s")
_NO_DOC = np.iinfo(np.int64).min  # stands for a null doc_id


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, least bit first; the last byte is filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flags.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    def __init__(self, out, bits: int):
        self.out, self.bits, self.rest = out, bits, np.zeros(0, np.uint32)
        self.offsets, self.docs, self.starts, self.n = [], [], [0], 0
        self.at = out.write(MAGIC)

    def add(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of some documents one after the other, and how many each has."""
        self.docs += [_NO_DOC if d is None else d for d in doc_ids]
        self.starts += (self.n + np.cumsum(sizes)).tolist()
        self.n = self.starts[-1]
        every = np.concatenate([self.rest, ids])
        whole = len(every) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            self._block(every[at : at + BLOCK])
        self.rest = every[whole:]

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.at)
        self.at += self.out.write(pack(ids, self.bits))

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        self.out.write(np.array(self.offsets, "<u8").tobytes() + np.array(self.docs, "<i8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self.out.write(_TAIL.pack(self.bits, BLOCK, self.n, len(self.docs), self.at, MAGIC))


class Reader:
    def __init__(self, file):
        self.file = file
        file.seek(file.size() - _TAIL.size)
        self.bits, self.block, self.n, docs, end, magic = _TAIL.unpack(file.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        blocks = -(-self.n // self.block)
        file.seek(end)
        foot = file.read(8 * (blocks + 2 * docs + 1))
        self.offsets = np.append(np.frombuffer(foot, "<u8", blocks), np.uint64(end))
        self.docs = np.frombuffer(foot, "<i8", docs, 8 * blocks)
        self.starts = np.frombuffer(foot, "<u8", docs + 1, 8 * (blocks + docs)).astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from start to end, reading their blocks only."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block + 1
        self.file.seek(int(self.offsets[first]))
        raw = self.file.read(int(self.offsets[last] - self.offsets[first]))
        held = unpack(raw, min(self.n, last * self.block) - first * self.block, self.bits)
        return held[start - first * self.block : end - first * self.block]

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """doc_ids, starts and ids of all documents, in groups of about ``most`` ids."""
        at = 0
        while at < len(self.docs):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + most, side="right")) - 1)
            ids = self.ids(int(self.starts[at]), int(self.starts[to]))
            yield self.docs[at:to], self.starts[at:to], np.split(ids, self.starts[at + 1 : to] - self.starts[at])
            at = to


_tokenizers: dict[str, Chunks] = {}
_GROUP = 512


def tokenizer_chunks(path: str) -> Chunks:
    """Ids of chunks by the tokenizers library as it loads the file; one for each Python worker.

    Its added tokens' strings are these tokens, as in the library; they are chunks of their own.  Words go to the
    library many at a time, with line breaks between: a line break after a word is a pre-token and a token of its own,
    so the ids between two of them are those of a word.
    """
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        added = list(model.get_added_tokens_decoder().values())
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("an added token that takes its neighbours along cannot be cut off")
        encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        cut = encode(["\n"])[0]

        def compute(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            out: dict[str, bytes] = {}
            words = [c for c in chunks if "\n" not in c and not c.isspace()] if len(cut) == 1 else []
            groups = [words[i : i + _GROUP] for i in range(0, len(words), _GROUP)]
            for group, ids in zip(groups, encode(["\n".join(g) for g in groups]), strict=True):
                ids = np.array(ids, "<u4")
                ends = (np.flatnonzero(ids == cut[0]) * 4).tolist()
                if len(ends) == len(group) - 1:
                    raw = ids.tobytes()
                    out.update(zip(group, [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)], strict=True)], strict=True))
            rest = [c for c in chunks if c not in out]
            out.update(zip(rest, (np.array(x, "<u4").tobytes() for x in encode(rest)), strict=True))
            parts = [out[c] for c in chunks]
            return np.frombuffer(b"".join(parts), "<i4"), np.array([len(p) // 4 for p in parts], np.int64)

        _tokenizers[path] = Chunks(compute, apart=[t.content for t in added])
    return _tokenizers[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme, as pyarrow takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = str(p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p))
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> list[dict]:
    """Encodes and writes all documents in ascending doc_id order; the manifest: a row per file, in that order.

    The manifest has as many rows as the write had partitions, whatever the number of documents.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits, folder = bits_for(vocabulary_size(tokenizer)), _qualified(spark, folder)

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        chunks = tokenizer_chunks(tokenizer)
        writer = out = None
        for batch in batches:
            for part in shared.pieces(batch):
                if writer is None:
                    system, root = fs.FileSystem.from_uri(folder)
                    system.create_dir(root, recursive=True)
                    name = f"{root}/{uuid.uuid4().hex}.packed"
                    out = system.open_output_stream(name)
                    writer, task = Writer(out, bits), part.column("part")[0].as_py()
                ids, at = chunks(*shared.utf8(part.column("text")))
                # the end id after each text's ids
                writer.add(part.column("doc_id").to_pylist(), np.insert(ids, at[1:], end_id).view(np.uint32), at[1:] - at[:-1] + 1)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [task], "path": [f"{folder}/{name.rpartition('/')[2]}"], "n_docs": [len(writer.docs)], "n_ids": [writer.n]})

    ordered = shared.id_and_text(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id().cast("long"))
    rows = ordered.mapInArrow(run, "part long, path string, n_docs long, n_ids long").collect()
    out, base = [], 0
    for r in sorted(rows):
        out.append({"path": r["path"], "start": base, "n_docs": r["n_docs"], "n_ids": r["n_ids"]})
        base += r["n_ids"]
    return out


def read(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """doc_id, start (over all files), n_tokens and ids_crc32 of every document, from the files alone."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                with system.open_input_file(path) as f:
                    for docs, starts, ids in Reader(f).documents():
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64(), mask=docs == _NO_DOC), "start": starts + row["start"], "n_tokens": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]})

    files = spark.createDataFrame([(m["path"], m["start"]) for m in manifest], "path string, start long")
    return files.repartition(len(manifest)).mapInArrow(run, schema)
