"""Named queries of retrieval, fusion, reranking and evaluation over the whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import evaluation as ev
from ..operators import retrieval as rt
from ..sources.readers import spread


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("content")))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("question"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("vec_id").alias("ord"), "embedding", "label")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated query set: every vector whose id is divisible by 20."""
    return vectors(spark, sf_dir).where("ord % 20 = 0").select(F.col("chunk_id").alias("query_id"), "embedding", "label")


def rounded(results: DataFrame) -> DataFrame:
    """Scores to nine digits, once they are ranked."""
    return results.withColumns({c: F.round(c, 9) for c in results.columns if c.endswith("score")})


def tokenize_counts(spark, sf_dir):
    c = chunks(spark, sf_dir)
    t = tx.tokens(F.col("content"))
    return c.select("chunk_id", F.size(t).alias("n_tokens"), F.size(F.array_distinct(t)).alias("n_distinct"), F.array_join(F.slice(t, 1, 8), " ").alias("first_tokens"))


def term_frequency(spark, sf_dir):
    return rt.term_frequencies(chunks(spark, sf_dir), rt.query_terms(questions(spark, sf_dir)))


def bm25_idf_table(spark, sf_dir):
    c = chunks(spark, sf_dir)
    out = rt.idf_table(rt.term_frequencies(c, rt.query_terms(questions(spark, sf_dir))), rt.corpus_stats(rt.chunk_lengths(c)))
    return out.select("term", "df", F.round("idf", 9).alias("idf"))


def bm25_topk(spark, sf_dir):
    return rounded(rt.bm25(questions(spark, sf_dir), chunks(spark, sf_dir))).select("query_id", "chunk_id", "score", "rank")


def dense_topk(spark, sf_dir):
    return rounded(rt.dense(vector_queries(spark, sf_dir), vectors(spark, sf_dir)))


def dense_threshold(spark, sf_dir):
    return rounded(rt.dense(vector_queries(spark, sf_dir), vectors(spark, sf_dir), k=50, threshold=0.5))


def cosine_zero_guard(spark, sf_dir):
    v = vectors(spark, sf_dir)
    e = F.col("embedding").cast("array<double>")
    zero = F.transform(e, lambda x: x * 0)
    return v.select("chunk_id", F.round(rt.cosine(e, e), 6).alias("self"), rt.cosine(e, zero).alias("zero"), rt.cosine(e, F.slice(e, 1, 3)).alias("shorter"))


def _two_lists(spark, sf_dir):
    q, c = questions(spark, sf_dir), chunks(spark, sf_dir)
    return rt.term_cosine(q, c), rt.bm25(q, c)


def rrf_fusion(spark, sf_dir):
    return rounded(rt.fused(*_two_lists(spark, sf_dir))).select("query_id", "chunk_id", "score", "rank", "dense_rank", "sparse_rank", "weighted_score", "representative")


def weighted_fusion(spark, sf_dir):
    return rounded(rt.fused(*_two_lists(spark, sf_dir), strategy="weighted", dense_weight=0.7, sparse_weight=0.3)).select("query_id", "chunk_id", "score", "rank", "rrf_score")


def rerank_identity(spark, sf_dir):
    return rounded(rt.rerank_identity(rt.bm25(questions(spark, sf_dir), chunks(spark, sf_dir)), 5)).select("query_id", "chunk_id", "rank", "score", "rerank_score", "original_score", "reranker")


def rerank_overlap(spark, sf_dir):
    q, c = questions(spark, sf_dir), chunks(spark, sf_dir)
    return rounded(rt.rerank_overlap(rt.bm25(q, c), q, c, 5)).select("query_id", "chunk_id", "rank", "score", "rerank_score", "reranker")


def _label_metrics(spark, sf_dir):
    """Relevance by label: a result is right if it has the question's label."""
    v, q = vectors(spark, sf_dir), vector_queries(spark, sf_dir)
    found = rt.dense(q.select("query_id", "embedding"), v)
    matches = found.join(v.select("chunk_id", F.col("label").alias("l")), "chunk_id").join(q.select("query_id", "label"), "query_id").select("query_id", F.col("chunk_id").alias("id"), "rank", (F.col("l") == F.col("label")).alias("matched"))
    expected = q.join(v.groupBy("label").agg(F.count("*").alias("n_expected")), "label").select("query_id", "n_expected")
    return ev.from_matches(matches, expected)


def eval_case_metrics(spark, sf_dir):
    return _label_metrics(spark, sf_dir)


def eval_summary(spark, sf_dir):
    return ev.summary(_label_metrics(spark, sf_dir))


def eval_diagnostics(spark, sf_dir):
    return ev.diagnostics(_label_metrics(spark, sf_dir).withColumn("basis", F.lit("chunk_id")))


def eval_hits_by_bucket(spark, sf_dir):
    return ev.buckets(_label_metrics(spark, sf_dir), vector_queries(spark, sf_dir).select("query_id", F.col("label").alias("key")))


_TOK = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}]+')".format
_BASE = f"""c AS (SELECT doc_id AS chunk_id, text AS content, {_TOK('text')} AS t FROM documents),
q AS (SELECT CAST(item_id AS VARCHAR) AS query_id, {_TOK('text')} AS t FROM benchmark),
qt AS (SELECT DISTINCT query_id, unnest(t) AS term FROM q),
st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM c),
post AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(t) AS term FROM c) WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
w AS (SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM post, st GROUP BY term)"""
_BM25 = f"""{_BASE},
sparse AS (SELECT *, round(exact, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, chunk_id) AS rank FROM (
  SELECT query_id, chunk_id, CAST(sum(CAST(floor(idf * tf / (tf + 1.5 * (0.25 + 0.75 * len(t) / avgdl)) * 4398046511104 + 0.5) AS BIGINT)) AS DOUBLE) * 2.5 / 4398046511104 AS exact
  FROM qt JOIN post USING (term) JOIN w USING (term) JOIN c USING (chunk_id), st GROUP BY query_id, chunk_id) WHERE exact > 0) WHERE rank <= 10)"""
_LISTS = f"""{_BM25},
dense AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (
  SELECT query_id, chunk_id, count(*) / sqrt(any_value(len(list_distinct(q.t))) * any_value(len(list_distinct(c.t)))) AS score
  FROM qt JOIN post USING (term) JOIN c USING (chunk_id) JOIN q USING (query_id) GROUP BY query_id, chunk_id) WHERE score >= 0) WHERE rank <= 10),
both_ AS (SELECT query_id, chunk_id, d.rank AS dense_rank, s.rank AS sparse_rank, d.score AS dense_score, s.exact AS sparse_score,
  coalesce(1 / (60 + d.rank), 0) + coalesce(1 / (60 + s.rank), 0) AS rrf_score
  FROM dense d FULL OUTER JOIN sparse s USING (query_id, chunk_id))"""
_DENSE = """v AS (SELECT CAST(vec_id AS VARCHAR) AS chunk_id, vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
found AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
  SELECT q.chunk_id AS query_id, q.label AS ql, v.chunk_id, v.vec_id, v.label, list_cosine_similarity(q.e, v.e) AS score FROM v q, v WHERE q.vec_id % 20 = 0) WHERE score >= {})"""
_CASES = f"""{_DENSE.format('0.0')},
hits AS (SELECT query_id, min(CASE WHEN label = ql THEN rank END) AS first_rank, count(CASE WHEN label = ql AND rank <= 1 THEN 1 END) AS h1,
  count(CASE WHEN label = ql AND rank <= 3 THEN 1 END) AS h3, count(CASE WHEN label = ql AND rank <= 5 THEN 1 END) AS h5 FROM found WHERE rank <= 10 GROUP BY query_id),
m AS (SELECT v.chunk_id AS query_id, v.label, n AS n_expected, first_rank, round(coalesce(1 / first_rank, 0), 9) AS reciprocal_rank, coalesce(first_rank <= 1, false) AS top1_hit,
  coalesce(first_rank <= 3, false) AS top3_hit, coalesce(first_rank <= 5, false) AS top5_hit, round(coalesce(h1, 0) / n, 9) AS recall_at_1, round(coalesce(h3, 0) / n, 9) AS recall_at_3, round(coalesce(h5, 0) / n, 9) AS recall_at_5
  FROM v LEFT JOIN hits ON query_id = v.chunk_id JOIN (SELECT label, count(*) AS n FROM v GROUP BY label) USING (label) WHERE vec_id % 20 = 0)"""

ORACLE = {
    "tokenize_counts": f"WITH {_BASE} SELECT chunk_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, array_to_string(t[1:8], ' ') AS first_tokens FROM c",
    "term_frequency": f"WITH {_BASE} SELECT chunk_id, term, tf FROM post",
    "bm25_idf_table": f"WITH {_BASE} SELECT term, df, round(idf, 9) AS idf FROM w",
    "bm25_topk": f"WITH {_BM25} SELECT query_id, chunk_id, score, rank FROM sparse",
    "dense_topk": f"WITH {_DENSE.format('0.0')} SELECT query_id, chunk_id, round(score, 9) AS score, rank FROM found WHERE rank <= 10",
    "dense_threshold": f"WITH {_DENSE.format('0.5')} SELECT query_id, chunk_id, round(score, 9) AS score, rank FROM found WHERE rank <= 50",
    "cosine_zero_guard": "SELECT CAST(vec_id AS VARCHAR) AS chunk_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS self, 0.0::DOUBLE AS zero, 0.0::DOUBLE AS shorter FROM embeddings",
    "rrf_fusion": f"""WITH {_LISTS} SELECT * FROM (SELECT query_id, chunk_id, round(rrf_score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, dense_rank IS NULL, coalesce(dense_rank, sparse_rank), chunk_id) AS rank, dense_rank, sparse_rank,
  round(0.5 * coalesce(dense_score, 0) + 0.5 * coalesce(sparse_score, 0), 9) AS weighted_score, CASE WHEN dense_rank IS NOT NULL AND (sparse_rank IS NULL OR dense_rank <= sparse_rank) THEN 'dense' ELSE 'sparse' END AS representative FROM both_) WHERE rank <= 10""",
    "weighted_fusion": f"""WITH {_LISTS} SELECT query_id, chunk_id, round(score, 9) AS score, rank, round(rrf_score, 9) AS rrf_score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first0, first1, chunk_id) AS rank FROM (
  SELECT query_id, chunk_id, 0.7 * coalesce(dense_score, 0) + 0.3 * coalesce(sparse_score, 0) AS score, rrf_score, dense_rank IS NULL AS first0, coalesce(dense_rank, sparse_rank) AS first1 FROM both_)) WHERE rank <= 10""",
    "rerank_identity": f"WITH {_BM25} SELECT query_id, chunk_id, rank, score, score AS rerank_score, score AS original_score, 'identity' AS reranker FROM sparse WHERE rank <= 5",
    "rerank_overlap": f"""WITH {_BM25} SELECT * FROM (SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, old) AS rank, score, rerank_score, 'overlap' AS reranker FROM (
  SELECT s.query_id, s.chunk_id, s.rank AS old, s.score, CAST(len(list_filter(c.t, lambda x: list_contains(q.t, x))) AS DOUBLE) AS rerank_score FROM sparse s JOIN c USING (chunk_id) JOIN q USING (query_id))) WHERE rank <= 5""",
    "eval_case_metrics": f"WITH {_CASES} SELECT * EXCLUDE (label) FROM m",
    "eval_summary": f"""WITH {_CASES} SELECT count(*) AS cases, round(avg(top1_hit::INT), 9) AS top1_hit, round(avg(top3_hit::INT), 9) AS top3_hit, round(avg(top5_hit::INT), 9) AS top5_hit, round(avg(reciprocal_rank), 9) AS mrr,
  round(avg(recall_at_1), 9) AS recall_at_1, round(avg(recall_at_3), 9) AS recall_at_3, round(avg(recall_at_5), 9) AS recall_at_5 FROM m""",
    "eval_diagnostics": f"WITH {_CASES} SELECT count(*) AS questions, count(first_rank) AS with_hit, count(*) - count(first_rank) AS without_hit, 0::BIGINT AS by_source, count(*) AS only_via_chunk_id, count(CASE WHEN first_rank > 1 THEN 1 END) AS late_hit FROM m",
    "eval_hits_by_bucket": f"WITH {_CASES} SELECT CAST(label AS VARCHAR) AS key, count(*) AS hits, round(avg(recall_at_1), 9) AS recall_at_1, round(avg(recall_at_3), 9) AS recall_at_3, round(avg(recall_at_5), 9) AS recall_at_5 FROM m WHERE first_rank IS NOT NULL GROUP BY label",
}
QUERIES = {f.__name__: f for f in (tokenize_counts, term_frequency, bm25_idf_table, bm25_topk, dense_topk, dense_threshold, cosine_zero_guard, rrf_fusion, weighted_fusion, rerank_identity, rerank_overlap, eval_case_metrics, eval_summary, eval_diagnostics, eval_hits_by_bucket)}
