"""Retrieval quality of all questions at once: hit@k, MRR, recall@k, diagnostics and buckets.

Cases are (case_id, question, expected_source_ids, expected_chunk_ids, sections, pages); results are (query_id,
chunk_id, source_chunk_id, rank).  A case is matched on source ids if it names any, else on chunk ids.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTS, MIN_TOP_K = (1, 3, 5), 5


def validate_top_k(k: int) -> int:
    if k < MIN_TOP_K:
        raise ValueError(f"top_k must be at least {MIN_TOP_K}")
    return k


def validate_cases(cases: DataFrame) -> DataFrame:
    """The cases; raises when one has no question or no expected id (one aggregate, nothing is collected)."""
    bad = cases.agg(F.count_if(F.coalesce(F.trim("question"), F.lit("")) == "").alias("q"), F.count_if(F.size(F.concat(F.coalesce("expected_source_ids", F.array().cast("array<string>")), F.coalesce("expected_chunk_ids", F.array().cast("array<string>")))) <= 0).alias("e")).head()
    if bad["q"] or bad["e"]:
        raise ValueError(f"{bad['q']} cases without a question, {bad['e']} without an expected id")
    return cases


def validate_dataset(dataset: dict) -> dict:
    """An evaluation set as read from JSON; raises at the first field that is missing or of the wrong kind."""
    for field in ("schema_version", "name", "cases"):
        if field not in dataset:
            raise ValueError(f"evaluation set without {field}")
    if not isinstance(dataset["cases"], list):
        raise ValueError("cases of an evaluation set are a list")
    for n, case in enumerate(dataset["cases"], 1):
        if not isinstance(case, dict):
            raise ValueError(f"case {n} is no object")
        name = case.get("id") or n
        if missing := [f for f in ("id", "question", "expected") if f not in case]:
            raise ValueError(f"case {name} without {missing[0]}")
        if not isinstance(case["expected"], dict):
            raise ValueError(f"expected of case {name} is no object")
        if not any(case["expected"].get(f) for f in ("source_chunk_ids", "chunk_ids")):
            raise ValueError(f"case {name} names no expected source_chunk_ids or chunk_ids")
    return dataset


def printed(metrics: dict) -> str:
    """The summary as one JSON object."""
    return json.dumps(metrics)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def from_matches(matches: DataFrame, expected: DataFrame) -> DataFrame:
    """matches (query_id, id, rank, matched) and expected (query_id, n_expected) to one row of metrics a case."""
    first = F.min(F.when(F.col("matched"), F.col("rank")))
    hits = {f"hits_{k}": F.count_distinct(F.when(F.col("matched") & (F.col("rank") <= k), F.col("id"))) for k in CUTS}
    found = matches.groupBy("query_id").agg(first.alias("first_rank"), *(v.alias(n) for n, v in hits.items()))
    out = expected.join(found, "query_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        "query_id", "n_expected", "first_rank",
        F.round(F.coalesce(1 / F.col("first_rank"), F.lit(0.0)), 9).alias("reciprocal_rank"),
        *((F.coalesce(F.col("first_rank") <= k, F.lit(False))).alias(f"top{k}_hit") for k in CUTS),
        *(F.round(ratio(zero(f"hits_{k}"), F.col("n_expected")), 9).alias(f"recall_at_{k}") for k in CUTS),
    )


def cases_metrics(cases: DataFrame, results: DataFrame, k: int) -> DataFrame:
    """A row of metrics a case, with the basis it was matched on."""
    none = F.array().cast("array<string>")
    by_source = F.size(F.coalesce("expected_source_ids", none)) > 0
    named = cases.select(F.col("case_id").alias("query_id"), F.when(by_source, "source_chunk_id").otherwise("chunk_id").alias("basis"), F.array_distinct(F.when(by_source, F.col("expected_source_ids")).otherwise(F.coalesce("expected_chunk_ids", none))).alias("ids"))
    joined = results.where(F.col("rank") <= k).join(named, "query_id")
    own = F.when(F.col("basis") == "source_chunk_id", F.col("source_chunk_id")).otherwise(F.col("chunk_id"))
    matches = joined.select("query_id", own.alias("id"), "rank", F.coalesce(F.array_contains("ids", own), F.lit(False)).alias("matched"))
    return from_matches(matches, named.select("query_id", F.size("ids").alias("n_expected"))).join(named.select("query_id", "basis"), "query_id")


def summary(metrics: DataFrame) -> DataFrame:
    """One row of means; 0 without cases."""
    mean = lambda c: F.round(F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)), 9)
    return metrics.agg(F.count("*").alias("cases"), *(mean(f"top{k}_hit").alias(f"top{k}_hit") for k in CUTS), mean("reciprocal_rank").alias("mrr"), *(mean(f"recall_at_{k}").alias(f"recall_at_{k}") for k in CUTS))


def diagnostics(metrics: DataFrame) -> DataFrame:
    hit = F.col("first_rank").isNotNull()
    return metrics.agg(F.count("*").alias("questions"), F.count_if(hit).alias("with_hit"), F.count_if(~hit).alias("without_hit"), F.count_if(F.col("basis") == "source_chunk_id").alias("by_source"), F.count_if(F.col("basis") == "chunk_id").alias("only_via_chunk_id"), F.count_if(hit & (F.col("first_rank") > 1)).alias("late_hit"))


def buckets(metrics: DataFrame, keys: DataFrame) -> DataFrame:
    """Of the cases with a hit, by key (query_id, key; each once a case): counts and mean recalls, keys as strings."""
    joined = metrics.where("first_rank IS NOT NULL").join(keys.select("query_id", F.col("key").cast("string").alias("key")).distinct(), "query_id")
    return joined.groupBy("key").agg(F.count("*").alias("hits"), *(F.round(F.avg(f"recall_at_{k}"), 9).alias(f"recall_at_{k}") for k in CUTS)).orderBy("key")
