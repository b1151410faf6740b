"""Named queries of the operators of this subpackage, thin over the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, language_id, order_minhash, packed_ids, piece_bpe, quality, secrets, shared, suffix_dedup, token_counts

IDS, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"


def op1_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared.fresh_dir(spark, "packed-ids")
    out = shared.written(packed_ids.read(spark, packed_ids.write(shared.documents(spark, sf_dir), folder, public_tokenizers.path(IDS), end_id=0)), "packed-ids-read")
    shared.remove(spark, folder)
    return out


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that have repeated passages; the operator itself has a row for every document."""
    out = suffix_dedup.repeated_passages(shared.documents(spark, sf_dir)).where(F.size("spans") > 0)
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_words", length.alias("n_repeated_words"), F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.secret_spans(shared.documents(spark, sf_dir))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in secrets.BASE]))
    return out.select("doc_id", *(count(r.kind) for r in secrets.BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(shared.documents(spark, sf_dir)).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(shared.documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.fit(language_id.sampled(docs.where(~held_out).select("doc_id", "lang", "text")))
    return language_id.identified(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(shared.documents(spark, sf_dir), shared.documents(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(shared.documents(spark, sf_dir), shared.documents(spark, sf_dir, "labels"))


def op9_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    out = piece_bpe.decoded(piece_bpe.encoded(shared.documents(spark, sf_dir), *where), *where)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = "</s>[INST] ok [/INST]"  # the template's own control strings
    rows = shared.documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], rows.schema)
    chat = shared.written(chat_format.formatted(rows.union(more)), "chat")
    out = shared.written(chat_format.digests(chat), "chat-digests")
    shared.discard(chat)
    return out


QUERIES = {f.__name__: f for f in (op1_packed_ids, op2_suffix_dedup, op3_secret_scan, op4_order_minhash, op5_token_counts, op6_language_id, op7_decontaminate, op8_quality_rules, op9_piece_bpe, op10_chat_format)}


def _found(i: int, rule: secrets.Rule) -> str:
    """Spans of one rule: the pieces between matches give the places of the matches."""
    p = rule.pattern.replace("'", "''")
    size = f"length(regexp_extract(m[j], '{p}', {rule.group}))" if rule.group else "length(m[j])"
    return f"""SELECT doc_id, {i} AS kind_no, '{rule.kind}' AS kind, s AS start_, e AS end_ FROM (SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda j: {{'s': list_sum(list_transform(g[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:j-1], lambda x: length(x))), 0), 'n': length(m[j]), 'ok': {size} >= {rule.least}}})) AS x
  FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS g FROM documents)), LATERAL (SELECT CAST(x.s AS BIGINT) AS s, CAST(x.s + x.n AS BIGINT) AS e) WHERE x.ok"""


_SECRETS = "WITH f AS (" + "\nUNION ALL ".join(_found(i, r) for i, r in enumerate(secrets.RULES)) + f""")
SELECT doc_id, count(CASE WHEN kind = 'assign' THEN 1 END) AS n_assign, count(CASE WHEN kind = 'access' THEN 1 END) AS n_access, count(CASE WHEN kind = 'hex' THEN 1 END) AS n_hex,
  sha256(coalesce(string_agg(CASE WHEN kind_no < {len(secrets.BASE)} THEN kind || ':' || start_ || ':' || end_ END, ',' ORDER BY start_, kind_no), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, kind_no), '') AS spans FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_HITS = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
n AS (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0), sizes AS (SELECT DISTINCT k FROM n),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM n)),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
h AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

_CHAT = r"""WITH u AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_matches(text, '</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE|\\[\\\[<]') AS esc FROM u)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256, CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
  CAST(sum(length(text) + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 WHEN 'system' THEN 19 END + CASE WHEN esc THEN length(regexp_replace(text, '[^\\\[<]', '', 'g')) ELSE 0 END) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id"""

ORACLE: dict[str, str] = {"op3_secret_scan": _SECRETS, "op7_decontaminate": _HITS, "op10_chat_format": _CHAT}
