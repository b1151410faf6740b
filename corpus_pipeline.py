"""A training-data pipeline over documents: quality rules, near-dedup, decontamination, secret scans, byte-level BPE.

Every stage works on whole rows, each a document of its own: rows of null or repeated doc_ids are kept, dropped or changed
by their own text.  All but the last return the columns they were given, whatever their names; an empty table gives an
empty table; a text may have any length.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratadoc.llm import decontaminate, order_minhash, piece_bpe, quality, secrets, shared
from stratadoc.llm.queries import RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or the quality classifier rejects go, null and empty texts (no words) among them."""
    return quality.good_documents(docs, shared.documents(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that of least doc_id, null last; of equal rows any one.

    Texts without a word are classes of their own and stay."""
    return order_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go; null texts and texts without a word have none and stay."""
    return decontaminate.decontaminated(docs, shared.documents(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, null texts stay null."""
    return secrets.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text's bytes; null and empty texts have no ids."""
    where = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return piece_bpe.round_trip(docs, *where).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "restored")


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("secret scans", secret_scan), ("byte-level BPE encoding", encode)]
ORACLE_SQL = None  # a fitted classifier and Order MinHash; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again by the next; what the next has used is deleted."""
    docs, last = shared.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last is not None:
            shared.discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
