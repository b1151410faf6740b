"""Batch retrieval: every question of a table at once against every chunk, ranked by windows.

Questions are (query_id, question); chunks are (chunk_id, content) with an order column for ties; results are
(query_id, chunk_id, score, rank), rank from 1.  Scores are ranked by their full value, which no order of additions
changes: BM25 adds whole multiples of a small step, cosines are added dimension by dimension.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

#: BM25 parts are multiples of 1 / STEPS before k1 + 1 comes in, so 64 bits hold the sum of 60,000 of the rarest terms.
STEPS = 1 << 42
#: What a matrix product's cosines may differ from exact ones by, at most.
SLACK = 1e-9
TOP_K, K1, B, RRF_K = 10, 1.5, 0.75, 60
#: Questions that one pass over the vectors compares: what is broadcast never exceeds this many vectors.
QUERY_BLOCK = 4096
#: Question terms (a row for each question and term) up to which they are broadcast.
BROADCAST_TERMS = 200_000


def top_k(scored: DataFrame, k: int | None, *ties: str) -> DataFrame:
    """The k best of each question by score, then by ties ascending; None keeps all, 0 or less none."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), *ties)
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k) if k > 0 else ranked.where("false")


# ---- sparse

def term_frequencies(chunks: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(chunk_id, term, tf); of the given terms alone if there are any: others are dropped before rows are counted.

    With given terms rows are dealt by chunk_id, which serves the count, and later sums by (question, chunk) as well.
    """
    exploded = chunks.select("chunk_id", F.explode(tx.tokens(F.col("content"))).alias("term"))
    if terms is not None:
        exploded = exploded.join(terms.select("term").distinct(), "term", "left_semi").repartition("chunk_id")
    return exploded.groupBy("chunk_id", "term").agg(F.count("*").alias("tf"))


def chunk_lengths(chunks: DataFrame, *more: str) -> DataFrame:
    return chunks.select("chunk_id", *more, F.size(tx.tokens(F.coalesce("content", F.lit("")))).alias("length"))


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """One row: chunks and their mean length; chunks without a token count."""
    return lengths.agg(F.count("*").alias("n"), F.coalesce(F.avg("length"), F.lit(0.0)).alias("avgdl"))


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def query_terms(queries: DataFrame) -> DataFrame:
    """Each distinct term of each question."""
    return queries.select("query_id", F.explode(F.array_distinct(tx.tokens(F.col("question")))).alias("term"))


def idf_table(postings: DataFrame, stats: DataFrame) -> DataFrame:
    """(term, df, idf); the single row of statistics is broadcast."""
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(stats.select("n"))).select("term", "df", idf(F.col("n"), F.col("df")).alias("idf"))


def bm25(queries: DataFrame, chunks: DataFrame, k: int | None = TOP_K, k1: float = K1, b: float = B) -> DataFrame:
    """BM25 over distinct question terms; chunks without a question term are no results."""
    if k1 <= 0 or not 0 <= b <= 1:
        raise ValueError("k1 must be positive and b between 0 and 1")
    asked = query_terms(queries)
    order = [c for c in ("ord",) if c in chunks.columns]  # ties go by the order of insertion, where it is known
    lengths = chunk_lengths(chunks, *order)
    stats = corpus_stats(lengths)
    postings = term_frequencies(chunks, asked)
    weights = idf_table(postings, stats)
    weighted = asked.join(weights.select("term", "idf"), "term")
    if asked.count() <= BROADCAST_TERMS:  # few enough to come to the postings, which stay dealt by chunk
        weighted = F.broadcast(weighted)
    matched = postings.join(weighted, "term").join(lengths, "chunk_id").crossJoin(F.broadcast(stats.select("avgdl")))
    norm = 1 - b + b * F.col("length") / F.when(F.col("avgdl") > 0, F.col("avgdl")).otherwise(1.0)
    steps = (F.col("idf") * F.col("tf") / (F.col("tf") + k1 * norm) * STEPS + 0.5).cast("long")
    scored = matched.groupBy("query_id", "chunk_id", *order).agg((F.sum(steps) * (k1 + 1) / STEPS).alias("score")).where("score > 0")
    return top_k(scored, k, *order, "chunk_id")


# ---- dense

def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 where either is empty or zero, or their lengths differ."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    ok = (F.size(a) == F.size(b)) & (F.size(a) > 0) & (norm(a) > 0) & (norm(b) > 0)
    return F.when(ok, dot / (norm(a) * norm(b))).otherwise(0.0)


def _rows(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By dimension: which rows have it, and these rows as a matrix; without a copy per row."""
    if column.null_count:
        column = column.fill_null([])
    ends = column.offsets.to_numpy().astype(np.int64)
    size, flat = np.diff(ends), column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    out = []
    for dim in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == dim)
        out.append((at, np.nan_to_num(flat[ends[at][:, None] + np.arange(dim)])))
    return out


def _norms(m: np.ndarray) -> np.ndarray:
    """Of each row, added in the order of its dimensions."""
    return np.sqrt(np.cumsum(m * m, axis=1)[:, -1])


def _unit(m: np.ndarray) -> np.ndarray:
    norm = _norms(m)[:, None]
    return m / np.where(norm > 0, norm, 1)


def _cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of the rows i of a and j of b, pair by pair, the same whatever pairs are beside them; 0 with a zero vector."""
    norm_a, norm_b, out = _norms(a), _norms(b), np.zeros(len(i))
    step = max(1, (1 << 21) // a.shape[1])
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        both = norm_a[x] * norm_b[y]
        out[at : at + step] = np.cumsum(a[x] * b[y], axis=1)[:, -1] / np.where(both > 0, both, np.inf)
    return out + 0.0


def _block_best(ids: list, vectors: list, k: int | None, threshold: float | None):
    """For a block of questions: the k best of each Arrow batch of (chunk_id, ord, embedding).

    A matrix product finds all pairs that may be among them; their cosines are then added one dimension after the other.
    """
    asked = {m.shape[1]: (at, m, _unit(m)) for at, m in _rows(pa.array(vectors, pa.list_(pa.float64())))}

    def run(batches):
        names = pa.array(ids, pa.string())
        for batch in batches:
            n, pos, groups = batch.num_rows, batch.column("ord").to_numpy(), []
            near = np.zeros((len(ids), n))
            for at, m in _rows(batch.column("embedding")):
                if m.shape[1] in asked:
                    rows, raw, unit = asked[m.shape[1]]
                    near[np.ix_(rows, at)] = unit @ _unit(m).T
                    groups.append((rows, raw, at, m))
            if k is not None and k < n:  # all that may reach the k-th best score, so that ties are settled by ord below
                kept = (near >= np.partition(near, n - max(k, 1), axis=1)[:, [n - max(k, 1)]] - SLACK) & (k > 0)
            else:
                kept = np.ones(near.shape, bool)
            if threshold is not None:
                kept &= near >= threshold - SLACK
            q, c = np.nonzero(kept)
            score = np.zeros(len(q))
            for rows, raw, at, m in groups:
                row, col = np.full(len(ids), -1), np.full(n, -1)
                row[rows], col[at] = np.arange(len(rows)), np.arange(len(at))
                those = np.flatnonzero((row[q] >= 0) & (col[c] >= 0))
                score[those] = _cosines(raw, m, row[q[those]], col[c[those]])
            if threshold is not None:
                q, c, score = (x[score >= threshold] for x in (q, c, score))
            order = np.lexsort((pos[c], -score, q))
            q, c, score = q[order], c[order], score[order]
            if k is not None and len(q):
                first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
                best = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q)))) < k
                q, c, score = q[best], c[best], score[best]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(q)), batch.column("chunk_id").take(pa.array(c)), batch.column("ord").take(pa.array(c)), pa.array(score)], ["query_id", "chunk_id", "ord", "score"])

    return run


def dense(queries: DataFrame, vectors: DataFrame, k: int | None = TOP_K, threshold: float | None = 0.0) -> DataFrame:
    """Cosine top k of (query_id, embedding) against (chunk_id, ord, embedding); ties by ord.

    Questions go in blocks of bounded size; each pass keeps the k best of every Arrow batch, so little is shuffled.
    """
    if k is not None and k <= 0:
        k = 0
    source = vectors.select(F.col("chunk_id").cast("string").alias("chunk_id"), F.col("ord").cast("long").alias("ord"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    out, block = None, []

    def scan(block):
        return source.mapInArrow(_block_best([r[0] for r in block], [r[1] for r in block], k, threshold), "query_id string, chunk_id string, ord long, score double")

    for row in rows.toLocalIterator():  # at most a block is held
        block.append(row)
        if len(block) == QUERY_BLOCK:
            out, block = scan(block) if out is None else out.unionByName(scan(block)), []
    if block or out is None:
        out = scan(block) if out is None and block else out.unionByName(scan(block)) if block else source.where("false").selectExpr("chunk_id AS query_id", "chunk_id", "ord", "double(0) AS score")
    return top_k(out, k, "ord").select("query_id", "chunk_id", "score", "rank")


def dense_depth(k: int, reranked: bool, default: int = TOP_K) -> int:
    """With a reranker the dense side still gives its own default number of candidates."""
    return default if reranked else k


def term_cosine(queries: DataFrame, chunks: DataFrame, k: int | None = TOP_K, threshold: float | None = 0.0) -> DataFrame:
    """Cosine of one-hot term vectors (an embedder that needs no model), computed from postings, not from vectors."""
    asked = query_terms(queries)
    size_q = asked.groupBy("query_id").agg(F.count("*").alias("nq"))
    size_c = chunks.select("chunk_id", F.size(F.array_distinct(tx.tokens(F.col("content")))).alias("nc"))
    hit = asked.join(term_frequencies(chunks, asked), "term").groupBy("query_id", "chunk_id").agg(F.count("*").alias("both"))
    score = F.col("both") / F.sqrt(F.col("nq") * F.col("nc"))
    scored = hit.join(size_q, "query_id").join(size_c, "chunk_id").select("query_id", "chunk_id", score.alias("score"))
    return top_k(scored if threshold is None else scored.where(F.col("score") >= threshold), k, "chunk_id")


# ---- fusion

def _one_each(results: DataFrame, name: str) -> DataFrame:
    """Of a chunk that a list holds twice: the first place for order, the last rank and score."""
    return results.groupBy("query_id", "chunk_id").agg(F.min("rank").alias(f"{name}_first"), F.max("rank").alias(f"{name}_rank"), F.max_by("score", "rank").alias(f"{name}_score"))


def fused(dense_results: DataFrame, sparse_results: DataFrame, strategy: str = "rrf", k: int | None = TOP_K, rrf_k: float = RRF_K, dense_weight: float = 0.5, sparse_weight: float = 0.5) -> DataFrame:
    """Full outer join of two ranked lists; both fusion scores stay as diagnostics, ``strategy`` ranks.

    Ties: first seen (dense list, then sparse list), then chunk_id.  representative is the side with the better rank.
    """
    if strategy not in ("rrf", "weighted") or rrf_k < 0:
        raise ValueError("strategy is rrf or weighted, rrf_k is not negative")
    both = _one_each(dense_results, "dense").join(_one_each(sparse_results, "sparse"), ["query_id", "chunk_id"], "full_outer")
    place = lambda r: F.coalesce(1 / (F.lit(float(rrf_k)) + F.col(r)), F.lit(0.0))
    rrf = place("dense_rank") + place("sparse_rank")
    weighted = dense_weight * F.coalesce("dense_score", F.lit(0.0)) + sparse_weight * F.coalesce("sparse_score", F.lit(0.0))
    out = both.withColumns({"rrf_score": rrf, "weighted_score": weighted})
    out = out.withColumn("score", F.col("rrf_score" if strategy == "rrf" else "weighted_score")).withColumn("representative", F.when(F.col("dense_rank").isNotNull() & (F.col("sparse_rank").isNull() | (F.col("dense_rank") <= F.col("sparse_rank"))), "dense").otherwise("sparse"))
    order = F.when(F.col("dense_first").isNotNull(), F.struct(F.lit(0).alias("list"), F.col("dense_first").alias("at"))).otherwise(F.struct(F.lit(1).alias("list"), F.col("sparse_first").alias("at")))
    return top_k(out.withColumn("first_seen", order), k, "first_seen", "chunk_id").select("query_id", "chunk_id", "score", "rank", "dense_rank", "sparse_rank", "dense_score", "sparse_score", "rrf_score", "weighted_score", "representative")


def merged_list(*columns: Column) -> Column:
    """Union of arrays in order of first occurrence; null arrays are empty."""
    return F.array_distinct(F.flatten(F.filter(F.array(*columns), lambda x: x.isNotNull())))


# ---- reranking

def reranked(results: DataFrame, score: Column, name: str, k: int | None = None) -> DataFrame:
    """Order by a new score, then by the old rank; score stays, original_score, rerank_score and reranker are set."""
    out = results.withColumns({"rerank_score": score, "original_score": F.col("score"), "reranker": F.lit(name), "before": F.col("rank")})
    order = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), "before")
    out = out.withColumn("rank", F.row_number().over(order)).drop("before")
    return out if k is None else out.where(F.col("rank") <= max(0, k))


def rerank_identity(results: DataFrame, k: int | None = None) -> DataFrame:
    """Keeps order and scores, and says so."""
    out = results.withColumns({"rerank_score": F.col("score"), "original_score": F.col("score"), "reranker": F.lit("identity")})
    return out if k is None else out.where(F.col("rank") <= max(0, k))


def rerank_overlap(results: DataFrame, queries: DataFrame, chunks: DataFrame, k: int | None = None, given: DataFrame | None = None, default: float = 0.0) -> DataFrame:
    """Score of a chunk: the given one, else how many of its tokens (with repeats) are the question's, else default."""
    joined = results.join(queries.select("query_id", F.array_distinct(tx.tokens(F.col("question"))).alias("__q")), "query_id", "left").join(chunks.select("chunk_id", tx.tokens(F.col("content")).alias("__c")), "chunk_id", "left")
    overlap = F.size(F.filter("__c", lambda t: F.array_contains("__q", t))).cast("double")
    score = F.when(F.size("__q") > 0, overlap).otherwise(F.lit(default))
    if given is not None:
        joined = joined.join(given.select("chunk_id", F.col("score").alias("__given")), "chunk_id", "left")
        score = F.coalesce("__given", score)
    return reranked(joined, score, "overlap", k).drop("__q", "__c", "__given")


def rerank_model(results: DataFrame, queries: DataFrame, chunks: DataFrame, load, name: str, k: int | None = None) -> DataFrame:
    """A pair model's scores; ``load`` gives a function of (questions, contents), once for each Python worker."""
    joined = results.join(queries.select("query_id", "question"), "query_id").join(chunks.select("chunk_id", "content"), "chunk_id")

    def run(batches):
        model = load()
        for batch in batches:
            yield batch.append_column("__s", pa.array(np.asarray(model(batch.column("question").to_pylist(), batch.column("content").to_pylist()), np.float64)))

    scored = joined.mapInArrow(run, T.StructType([*joined.schema.fields, T.StructField("__s", T.DoubleType())]))
    return reranked(scored, F.col("__s"), name, k).drop("__s", "question", "content")
