"""What the operators of this subpackage share: written intermediate tables, joins dealt by salt, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..work import bucketed, discard, fresh_dir, remove, work_dir, written  # noqa: F401

#: Text bytes that one step of a kernel handles at once, so that its arrays stay small whatever the batch.
STEP_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, as rows here hold whole texts; a setting of the user's stays."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, "1000")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that extra columns of any name never reach an operator."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def numbered(df: DataFrame) -> DataFrame:
    """A ``row`` number for every row.  Only fixed once written: a scan that is run again may number otherwise."""
    return df.withColumn("row", F.monotonically_increasing_id())


#: Parts that a key is dealt over where very many rows may have it (at most as many as a long has bits).
SALTS = 64


def salted(rows: DataFrame, unique: str) -> DataFrame:
    """``rows`` with their ``salt``, a hash of the column ``unique``."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(unique), F.lit(SALTS)).cast("int"))


def salts() -> Column:
    """What salts a group's rows have, a bit each."""
    return F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")


def dealt(whole: DataFrame) -> DataFrame:
    """A row of ``whole`` for each salt of its ``salts``."""
    return whole.withColumn("salt", F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> (shiftright(salts, s) & 1L) = 1L)"))).drop("salts")


def salted_join(rows: DataFrame, key: str, unique: str, where: str | None = None, **aggregates: Column) -> DataFrame:
    """``rows`` with aggregates over their key, in whose join no key meets in one place.

    The aggregates are partial before they are shuffled, and tell by a bit each what salts (a hash of the column
    ``unique``) a key's rows have; the join is by key and salt.  Keys whose aggregates fail ``where`` are left out.
    """
    own = salted(rows, unique)
    whole = own.groupBy(key).agg(*(c.alias(n) for n, c in aggregates.items()), salts())
    return own.join(dealt(whole.where(where) if where else whole), [key, "salt"]).drop("salt")


def salted_lookup(rows: DataFrame, key: str, unique: str, table: DataFrame, how: str = "left", of: DataFrame | None = None) -> DataFrame:
    """``rows`` joined to the one row that a table has for their key, in whose join no key meets in one place.

    ``of`` has the same (key, unique) as ``rows``, where these are dear to make again.
    """
    keys = salted(rows if of is None else of, unique).select(key, "salt").distinct()
    return salted(rows, unique).join(keys.join(table, key), [key, "salt"], how).drop("salt")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread_pieces(text: Column, chars: int, pieces: int = 8) -> Column:
    """The whole text up to ``chars`` characters; of a longer one as many, in pieces spread evenly from its start to its end."""
    size = chars // pieces
    at = lambda i: (F.floor((F.length(text) - size) * i / (pieces - 1)) + 1).cast("int")
    return F.when(F.length(text) > chars, F.concat_ws("\n", *(F.substring(text, at(i), F.lit(size)) for i in range(pieces)))).otherwise(text)


def pieces(batch: pa.RecordBatch, column: str = "text", step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``step`` bytes of text each; a longer text has a slice of its own."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + step, side="right")))
        yield batch.slice(at, to - at)
        at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and len + 1 offsets into it; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]
