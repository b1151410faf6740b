"""Named queries of document processing over the whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import work
from ..functions import headings as hd
from ..functions import text as tx
from ..operators import blocks as bl
from ..operators import chunks as ch
from ..sources.readers import spread

LINES_A_PAGE = 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as blocks: twenty a page; some begin with clause numbers, by their position."""
    lines = documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), F.split("text", "\n").alias("l"))
    rows = lines.select("document_id", F.size("l").alias("n"), F.posexplode("l").alias("i", "t"))
    i = F.col("i")
    text = F.when(i % 9 == 1, F.concat(i, F.lit(" "), "t")).when(i % 9 == 4, F.concat(i, F.lit("."), i % 5, F.lit(" "), "t")).otherwise(F.col("t"))
    return rows.select("document_id", (i + 1).alias("sequence_no"), F.floor(i / LINES_A_PAGE).cast("int").alias("page_no"), F.floor((F.col("n") - 1) / LINES_A_PAGE + 1).cast("int").alias("page_total"), F.lit("text").alias("label"), text.alias("text"))


def normalize_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.plain(F.col("text")).alias("normalized"))


def base64_marker_count(spark, sf_dir):
    decorated = F.concat("text", F.lit(" ![x](data:image/png;base64,aGk=) base64 and data:image/gif;base64,AA== Base64"))
    return documents(spark, sf_dir).select("doc_id", tx.asset_markers(decorated).alias("markers"), F.length(tx.without_assets(decorated)).alias("clean_chars"))


def table_stats(spark, sf_dir):
    s = bl.table_stats(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", s["rows"].alias("n_rows"), s["columns"].alias("n_columns"), s["quality"].alias("quality"), F.array_join(s["reasons"], ",").alias("reasons"))


def clause_parse(spark, sf_dir):
    n = hd.clause_number(F.col("text"))
    return line_blocks(spark, sf_dir).select("document_id", "sequence_no", n.alias("clause_number"), hd.clause_body(F.col("text")).alias("clause_body"), F.array_join(hd.clause_path(n), ">").alias("clause_path"), hd.heading_kind(F.col("text")).alias("kind"))


def content_type_counts(spark, sf_dir):
    return bl.normalized(line_blocks(spark, sf_dir)).groupBy("content_type").agg(F.count("*").alias("blocks"))


def repeated_header_footer(spark, sf_dir):
    """Each document's first line stands on top of every page."""
    blocks = line_blocks(spark, sf_dir)
    first = blocks.where("sequence_no = 1").select("document_id", F.col("text").alias("h"))
    pages = blocks.select("document_id", "page_no", "page_total").distinct().join(first, "document_id")
    heads = pages.select("document_id", (F.col("page_no") * LINES_A_PAGE).alias("sequence_no"), "page_no", "page_total", F.lit("text").alias("label"), F.col("h").alias("text"))
    out = bl.mark_repeated(bl.complete(heads.unionByName(blocks.where("sequence_no > 1"))))
    return out.where("repeated").groupBy("document_id").agg(F.count("*").alias("blocks"), F.round(F.max("repetition_ratio"), 9).alias("ratio"))


def section_propagation(spark, sf_dir):
    out = bl.with_sections(bl.normalized(line_blocks(spark, sf_dir)))
    return out.select("document_id", "sequence_no", "section_title", "subsection_title", F.array_join("clause_path", ">").alias("clause_path"), "is_front_matter")


def _built(spark, sf_dir):
    """Blocks and chunks that several parts of a query read: each made once."""
    blocks = work.written(bl.with_sections(bl.normalized(line_blocks(spark, sf_dir))), "blocks")
    return blocks, work.written(ch.built(blocks), "chunks")


def chunk_build(spark, sf_dir):
    """No SQL: running lengths that reset; tests hold it against a plain fold."""
    chunks = ch.built(bl.with_sections(bl.normalized(line_blocks(spark, sf_dir))))
    return chunks.select("document_id", "chunk_no", "chunk_id", "text", "page_start", "page_end", F.array_join("section_path", ">").alias("section_path"), F.size("source_spans").alias("n_spans"), "split_index", "split_total", "split_strategy", "starts_mid_sentence", "ends_mid_sentence")


def span_rebuild(spark, sf_dir):
    """Every chunk is rebuilt from its spans, and no character but white space is lost."""
    blocks, chunks = _built(spark, sf_dir)
    ok = chunks.select("document_id", "chunk_id", "text").join(ch.rebuilt(chunks, blocks).select("chunk_id", "rebuildable"), "chunk_id")
    return ok.groupBy("document_id").agg(F.bool_and("rebuildable").alias("rebuildable"), F.sum(F.length(F.regexp_replace("text", r"\s+", ""))).alias("chars"))


_LINES = """l AS (SELECT doc_id AS document_id, string_split(text, chr(10)) AS a FROM documents),
raw AS (SELECT document_id, len(a) AS n, unnest(range(0, len(a))) AS i, unnest(a) AS t FROM l),
b AS (SELECT document_id, i + 1 AS sequence_no, i // 20 AS page_no, (n - 1) // 20 + 1 AS page_total, CASE WHEN i % 9 = 1 THEN i || ' ' || t WHEN i % 9 = 4 THEN i || '.' || (i % 5) || ' ' || t ELSE t END AS text FROM raw)"""
_PLAIN = r"array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '\n\s*\n+'), lambda p: array_to_string(list_filter(list_transform(string_split(p, chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'))), lambda x: x <> ''), ' ')), lambda x: x <> ''), chr(10) || chr(10))"
_NO_ASSETS = r"regexp_replace(regexp_replace(d, '(?i)!\[[^\]]*\]\(data:image/[^)]*\)|data:image/[^\s)]+', '', 'g'), '(?i)\bbase64\b', '', 'g')"
_CLAUSE = r"(?s)^\s*(\d{1,3}(?:\.\d{1,3})*)[.)]?\s+(\S[^\n]+?)\s*$"


def _clause_cte(source: str, text: str) -> str:
    no = "".join(f" AND NOT regexp_matches({text}, '{p}')" for p in (r"^\s*\d{1,2}/\d{1,2}/\d{2,4}\b", r"(?i)^\s*\d{1,2}h\d{0,2}\b", r"^\s*\d+(?:[\s-]\d+){2,}\b", r"^\s*\d+\s*%", r"(?i)^\s*https?://", r"^\s*\S+@\S+"))
    num, body = f"regexp_extract({text}, '{_CLAUSE}', 1)", f"regexp_extract({text}, '{_CLAUSE}', 2)"
    named = rf"(regexp_matches({text}, '(?i)^\s*(Art\.?|Artigo|CL[ÁA]USULA|CAP[ÍI]TULO|SE[ÇC][ÃA]O|T[ÍI]TULO|LIVRO|PARTE|ANEXO|AP[ÊE]NDICE)(?:[^\p{{L}}\p{{N}}_]|$)') OR regexp_matches({text}, '(?i)^\s*(ANEXO|ANNEX)\s+[IVXLCDM\d]+\b'))"
    return rf"""cl AS (SELECT *, CASE WHEN {num} <> '' AND len(string_split({num}, '.')) <= 8 AND length({num}) <= 24 AND regexp_matches({body}, '\p{{L}}'){no} THEN {num} END AS num, {body} AS body, {named} AS named FROM {source}),
k AS (SELECT *, CASE WHEN named OR len(string_split(num, '.')) = 1 THEN 'section' WHEN len(string_split(num, '.')) <= 3 THEN 'subsection' END AS kind,
  CASE WHEN num IS NOT NULL THEN array_to_string(list_transform(range(1, len(string_split(num, '.')) + 1), lambda j: array_to_string(string_split(num, '.')[1:j], '.')), '>') END AS path FROM cl)"""


_UPPER = r"(length(regexp_replace({0}, '[^\p{{L}}]', '', 'g')) >= 4 AND 5 * length(regexp_replace({0}, '[^\p{{Lu}}]', '', 'g')) >= 4 * length(regexp_replace({0}, '[^\p{{L}}]', '', 'g')) AND length({0}) <= 180 AND right(rtrim({0}), 1) <> '.')"
_NORMAL = f"n0 AS (SELECT * REPLACE ({_PLAIN.format('text')} AS text) FROM b), nb AS (SELECT * FROM n0 WHERE text <> '')"
_ADMIN = hd.ADMIN.removeprefix(r"(?iU)\b").removesuffix(r"\b")
_INSTITUTION = hd.INSTITUTION.removeprefix(r"(?iU)\b").removesuffix(r"\b")
_EDGE = r"(?:^|[^\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)"
_FRONT = rf"""(regexp_matches(line, '{hd.CONTACT.replace('(?iU)', '(?i)')}') OR regexp_matches(line, '{hd.DATE_OR_TIME.replace('(?iU)', '(?i)')}') OR regexp_matches(line, '{hd.SUMMARY_ENTRY.replace('(?U)', '')}')
  OR len(regexp_extract_all(line, '(?i){_EDGE[0]}{_ADMIN}{_EDGE[1]}')) + len(regexp_extract_all(line, '(?i){_EDGE[0]}{_INSTITUTION}{_EDGE[1]}')) >= 2)"""

ORACLE = {
    "normalize_text": f"SELECT doc_id, {_PLAIN.format('text')} AS normalized FROM documents",
    "base64_marker_count": f"""SELECT doc_id, CAST(4 AS INTEGER) AS markers, length({_PLAIN.format(_NO_ASSETS)}) AS clean_chars
  FROM (SELECT doc_id, text || ' ![x](data:image/png;base64,aGk=) base64 and data:image/gif;base64,AA== Base64' AS d FROM documents)""",
    "table_stats": r"""WITH a AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g')) <> '') AS l FROM documents),
r AS (SELECT doc_id, l, list_filter(l, lambda x: contains(x, '|')) AS rows FROM a), w AS (SELECT *, list_transform(rows, lambda x: len(string_split(trim(x, '|'), '|'))) AS widths FROM r),
s AS (SELECT doc_id, CASE WHEN len(rows) > 0 THEN len(rows) ELSE len(l) END AS n_rows, coalesce(list_max(widths), 0) AS n_columns, list_filter([CASE WHEN len(list_distinct(widths)) > 1 THEN 'inconsistent_column_count' END,
  CASE WHEN len(list_filter(rows, lambda x: length(x) > 600)) > 0 THEN 'very_long_rows' END, CASE WHEN len(rows) = 0 THEN 'no_markdown_table_rows' END], lambda x: x IS NOT NULL) AS reasons FROM w)
SELECT doc_id, n_rows, n_columns, CASE len(reasons) WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS quality, array_to_string(reasons, ',') AS reasons FROM s""",
    "clause_parse": f"WITH {_LINES}, {_clause_cte('b', 'text')} SELECT document_id, sequence_no, num AS clause_number, CASE WHEN num IS NULL THEN '' ELSE body END AS clause_body, path AS clause_path, kind FROM k",
    "content_type_counts": f"WITH {_LINES}, {_NORMAL}, {_clause_cte('nb', 'text')} SELECT CASE WHEN kind IS NOT NULL OR {_UPPER.format('text')} THEN 'title' WHEN num IS NOT NULL THEN 'list_item' ELSE 'paragraph' END AS content_type, count(*) AS blocks FROM k GROUP BY 1",
    "repeated_header_footer": rf"""WITH {_LINES}, h AS (SELECT document_id, text AS h FROM b WHERE sequence_no = 1), p AS (SELECT DISTINCT document_id, page_no, page_total FROM b),
u AS (SELECT document_id, page_no, page_total, h AS text FROM p JOIN h USING (document_id) UNION ALL SELECT document_id, page_no, page_total, text FROM b WHERE sequence_no > 1),
f AS (SELECT *, replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), 'ß', 'ss') AS key FROM u),
o AS (SELECT document_id, key, count(DISTINCT page_no) / max(page_total) AS ratio, count(*) AS n FROM f WHERE key <> '' AND length(key) <= 120 GROUP BY ALL HAVING max(page_total) >= 3 AND count(DISTINCT page_no) >= 2)
SELECT document_id, sum(n)::BIGINT AS blocks, round(max(ratio), 9) AS ratio FROM o WHERE ratio >= 0.7 GROUP BY document_id""",
    "section_propagation": rf"""WITH {_LINES}, {_NORMAL}, li AS (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS line FROM nb), {_clause_cte('li', 'line')},
s AS (SELECT *, kind IS NOT NULL AND length(line) <= 220 AND len(regexp_extract_all(line, '[\p{{L}}\p{{N}}_\p{{M}}]+')) <= 28 AND regexp_matches(line, '\p{{L}}') AND NOT {_FRONT} AS st FROM k),
f AS (SELECT *, min(CASE WHEN st THEN sequence_no END) OVER w AS first_ FROM s WINDOW w AS (PARTITION BY document_id ORDER BY sequence_no ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, first_ IS NOT NULL AND (kind IS NOT DISTINCT FROM 'section' OR sequence_no = first_) AS opens FROM f),
e AS (SELECT *, last_value(CASE WHEN opens THEN line END IGNORE NULLS) OVER w AS sec, last_value(CASE WHEN opens THEN '-' WHEN first_ IS NOT NULL AND kind = 'subsection' THEN '+' || line END IGNORE NULLS) OVER w AS sub, last_value(path IGNORE NULLS) OVER w AS cp
  FROM g WINDOW w AS (PARTITION BY document_id ORDER BY sequence_no ROWS UNBOUNDED PRECEDING))
SELECT document_id, sequence_no, CASE WHEN first_ IS NULL THEN 'front_matter' ELSE sec END AS section_title, CASE WHEN sub[1] = '+' THEN sub[2:] END AS subsection_title, cp AS clause_path, first_ IS NULL AS is_front_matter FROM e""",
    "span_rebuild": r"WITH " + _LINES + r" SELECT document_id, true AS rebuildable, sum(length(regexp_replace(text, '\s+', '', 'g')))::BIGINT AS chars FROM b GROUP BY document_id HAVING sum(length(regexp_replace(text, '\s+', '', 'g'))) > 0",
}
QUERIES = {f.__name__: f for f in (normalize_text, base64_marker_count, table_stats, clause_parse, content_type_counts, repeated_header_footer, section_propagation, chunk_build, span_rebuild)}
