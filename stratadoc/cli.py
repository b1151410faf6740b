"""Command line: ``python -m stratadoc.cli parse | chunk | index | query | evaluate``.

A model is given as ``module:function``; the function takes no argument and returns one of a list of texts to vectors.
Search is dense with a model and BM25 without one, or both fused (``--retriever hybrid``; the dense side is then term
vectors where no model is given), and may be reranked.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import evaluation as ev
from .operators import hierarchy as hi
from .operators import parsing
from .operators import retrieval as rt
from .session import ship
from .sources import readers, writers

TRUE = ("1", "true", "yes", "y", "on")
RETRIEVERS, RERANKERS = ("auto", "dense", "bm25", "hybrid"), ("none", "identity", "overlap")


@dataclass(frozen=True)
class Settings:
    """Defaults that the environment may change; fixed values."""

    embedding_model: str = "BAAI/bge-m3"
    top_k: int = rt.TOP_K
    similarity_threshold: float = 0.0
    index_path: str = "index/document_index.json"

    @classmethod
    def from_env(cls) -> Settings:
        read = lambda name, default: type(default)(os.environ.get(name, default))
        return cls(read("EMBEDDING_MODEL", cls.embedding_model), read("TOP_K", cls.top_k), read("SIMILARITY_THRESHOLD", cls.similarity_threshold), read("INDEX_PATH", cls.index_path))


def flag(name: str, default: bool = False) -> bool:
    value = os.environ.get(name)
    return default if value is None else value.strip().lower() in TRUE


def config_from_env() -> hi.HierarchyConfig:
    return hi.HierarchyConfig(int(os.environ.get("RAG_TARGET_CHUNK_CHARS", 1200)), int(os.environ.get("RAG_MAX_CHUNK_CHARS", 1800)), flag("RAG_INCLUDE_SECTION_CONTEXT", True))


def loader(name: str) -> Callable:
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def http_answers(url: str, model: str, timeout: float = 30) -> Callable[[list[str]], list[str]]:
    """A provider for ``answers.answered``: one POST of {model, prompt, stream: false} a prompt, the reply's "response"."""

    def generate(prompts: list[str]) -> list[str]:
        out = []
        for prompt in prompts:
            body = json.dumps({"model": model, "prompt": prompt, "stream": False}).encode()
            request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
            with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310
                out.append(str(json.load(reply).get("response") or ""))
        return out

    return generate


def build_index(spark: SparkSession, source: str, target: str, kind: str = "auto", model: str | None = None) -> None:
    # records that are no hierarchy yet are built with the default limits, whatever the environment says
    records = hi.indexable(readers.load_records(spark, source, hi.hierarchical, kind))
    writers.index(hi.embedded(records, loader(model)) if model else records, target)


def parse(spark: SparkSession, source: str, target: str, parser: str) -> None:
    """Sources of a parser (JSON Lines of document_id and what the parser reads) to blocks, chunks and reports."""
    out = parsing.process(readers.default_registry().get(parser)(readers.json_lines(spark, source)), parser_name=parser)
    writers.json_lines(out.blocks, f"{target}/blocks")
    writers.json_lines(writers.legacy(out.chunks), f"{target}/chunks")
    writers.json_lines(out.report, f"{target}/report")


def search(spark: SparkSession, index: DataFrame, questions: DataFrame, k: int, model: str | None = None, retriever: str = "auto", strategy: str = "rrf", reranker: str = "none", threshold: float | None = 0.0) -> DataFrame:
    """Results with the index's columns; ties by the order of the index."""
    if retriever not in RETRIEVERS or reranker not in RERANKERS:
        raise ValueError(f"retriever is one of {RETRIEVERS}, reranker one of {RERANKERS}")
    if retriever == "auto":
        retriever = "dense" if model else "bm25"
    texts = index.select("chunk_id", "content", *(c for c in ("ord",) if c in index.columns))
    depth = rt.dense_depth(k, reranker != "none")

    def dense() -> DataFrame:
        if not model:
            return rt.term_cosine(questions, texts, depth, threshold)
        order = "ord" if "ord" in index.columns else F.xxhash64("chunk_id").alias("ord")
        return rt.dense(hi.embedded(questions.withColumnRenamed("question", "content"), loader(model)), index.select("chunk_id", order, "embedding"), depth, threshold)

    if retriever == "hybrid":
        found = rt.fused(dense(), rt.bm25(questions, texts, depth), strategy, depth)
    else:
        found = dense() if retriever == "dense" else rt.bm25(questions, texts, depth)
    if reranker == "overlap":
        found = rt.rerank_overlap(found, questions, texts, k)
    elif reranker == "identity":
        found = rt.rerank_identity(found, k)
    return found.join(index, "chunk_id")


def main(argv: list[str] | None = None) -> None:
    settings = Settings.from_env()
    parser = argparse.ArgumentParser(prog="stratadoc")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("parse", "chunk", "index", "query", "evaluate"):
        p = sub.add_parser(name)
        if name in ("parse", "chunk"):
            p.add_argument("--input", required=True)
            p.add_argument("--output", required=True)
            if name == "parse":
                p.add_argument("--parser", default="html", choices=readers.default_registry().list())
            continue
        p.add_argument("--model")
        p.add_argument("--index", default=settings.index_path)
        if name == "index":
            p.add_argument("--input")
            p.add_argument("--input-type", default="auto")
        else:
            p.add_argument("--top-k", type=int, default=settings.top_k)
            p.add_argument("--retriever", default="auto", choices=RETRIEVERS)
            p.add_argument("--strategy", default="rrf", choices=("rrf", "weighted"))
            p.add_argument("--reranker", default="none", choices=RERANKERS)
            p.add_argument("--question" if name == "query" else "--dataset", required=True)
    args = parser.parse_args(argv)
    if args.command == "evaluate":
        ev.validate_top_k(args.top_k)  # before anything is loaded
    spark = SparkSession.builder.appName("stratadoc").getOrCreate()
    ship(spark)
    if args.command == "parse":
        return parse(spark, args.input, args.output, args.parser)
    if args.command == "chunk":
        return writers.json_lines(hi.hierarchical(readers.json_lines(spark, args.input), config_from_env()), args.output)
    if args.command == "index":
        return build_index(spark, args.input or readers.default_input_path(spark), args.index, args.input_type, args.model)
    index = readers.vector_index(spark, args.index)
    how = {"k": args.top_k, "model": args.model, "retriever": args.retriever, "strategy": args.strategy, "reranker": args.reranker, "threshold": settings.similarity_threshold}
    if args.command == "query":
        asked = spark.createDataFrame([("q", args.question)], "query_id string, question string")
        for row in writers.formatted(search(spark, index, asked, **how)).orderBy("rank").toLocalIterator():
            print(row["line"])
        return None
    cases = ev.validate_cases(readers.evaluation_cases(spark, args.dataset))
    found = search(spark, index, cases.select(F.col("case_id").alias("query_id"), "question"), **how)
    print(ev.printed(ev.summary(ev.cases_metrics(cases, found, args.top_k)).head().asDict()))
    return None


if __name__ == "__main__":
    main()
