"""Named queries of retrieval records, answers, assets, reports and sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import work
from ..operators import answers as an
from ..operators import assets as at
from ..operators import blocks as bl
from ..operators import chunks as ch
from ..operators import hierarchy as hi
from ..operators import report as rp
from ..sources import readers as rd
from . import document_queries as dq
from . import retrieval_queries as rq

LINES_A_SECTION = 10


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as stage-one chunks, ten a section, with a clause number on every fourth."""
    lines = dq.documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), F.posexplode(F.split("text", "\n")).alias("i", "text"))
    i = F.col("i")
    name = F.concat(F.lit("S"), F.floor(i / LINES_A_SECTION))
    span = F.struct(F.concat(F.lit("b"), i).alias("block_id"), F.lit(0).alias("block_start_char"), F.length("text").alias("block_end_char"), F.lit(0).alias("chunk_start_char"), F.length("text").alias("chunk_end_char"))
    return lines.select("document_id", ch.chunk_key(F.col("document_id").cast("string"), i + 1).alias("chunk_id"), (i + 1).alias("chunk_no"), "text", F.when(i % 7 == 3, "table").otherwise("paragraph").alias("content_type"), F.array(name).alias("section_path"), name.alias("section_title"), F.when(i % 4 == 0, F.concat(F.lit("Sub "), F.floor(i / 4))).alias("subsection_title"), F.when(i % 4 == 0, (i + 1).cast("string")).alias("clause_number"), (F.floor(i / 20) + 1).cast("int").alias("page_start"), (F.floor(i / 20) + 1).cast("int").alias("page_end"), F.array(F.concat(F.lit("b"), i)).alias("source_block_ids"), F.array(span).alias("source_spans"))


def hierarchy_parents(spark, sf_dir):
    out = hi.hierarchical(line_chunks(spark, sf_dir), hi.HierarchyConfig(siblings=False))
    return out.where("chunk_type = 'parent'").select("document_id", "chunk_id", "section_title", "content", "page_start", "page_end", "previous_chunk_id", "next_chunk_id")


def section_context(spark, sf_dir):
    out = hi.hierarchical(line_chunks(spark, sf_dir), hi.HierarchyConfig(siblings=False))
    return out.where("chunk_type = 'section_context'").select("document_id", "chunk_id", "parent_chunk_id", "content")


def hierarchy_children(spark, sf_dir):
    out = hi.hierarchical(line_chunks(spark, sf_dir), hi.HierarchyConfig(siblings=False))
    return out.where("chunk_type = 'child'").select("document_id", "chunk_id", "parent_chunk_id", "source_chunk_id", F.length("content").alias("chars"), "has_fragments")


def fragment_semantic(spark, sf_dir):
    out = hi.hierarchical(line_chunks(spark, sf_dir), hi.HierarchyConfig(siblings=False))
    return out.where("chunk_type IN ('fragment', 'table')").select("document_id", "chunk_id", "chunk_type", "fragment_index", "fragment_total", "content", F.array_join("source_block_ids", ",").alias("blocks"))


def sibling_links(spark, sf_dir):
    out = hi.hierarchical(line_chunks(spark, sf_dir))
    return out.where("chunk_type <> 'parent'").select("document_id", "chunk_id", F.coalesce("previous_chunk_id", F.lit("")).alias("previous"), F.coalesce("next_chunk_id", F.lit("")).alias("next"), F.size("sibling_chunk_ids").alias("siblings"))


def index_filter(spark, sf_dir):
    out = hi.indexable(hi.hierarchical(line_chunks(spark, sf_dir), hi.HierarchyConfig(siblings=False)))
    return out.groupBy("document_id", "chunk_type").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("chars"))


def _results(spark, sf_dir):
    """BM25 results with pages and sections by position."""
    q, c = rq.questions(spark, sf_dir), rq.chunks(spark, sf_dir)
    found = rq.rounded(rq.rt.bm25(q, c)).join(c, "chunk_id")
    i = F.col("chunk_id")
    return q, found.select("query_id", "rank", "score", i.cast("string").alias("chunk_id"), F.concat(F.lit("p"), i).alias("source_chunk_id"), (i % 9).cast("int").alias("page_start"), F.when(i % 5 > 0, i % 9 + i % 3 - 1).cast("int").alias("page_end"), F.array(F.concat(F.lit("S"), i % 4)).alias("section_path"), "content")


def citations_pages(spark, sf_dir):
    _, r = _results(spark, sf_dir)
    return an.citations(r).select("query_id", "rank", "chunk_id", "source_chunk_id", F.array_join("pages", ",").alias("pages"), F.array_join("section_path", ">").alias("section_path"))


def answer_prompt(spark, sf_dir):
    return an.prompts(*_results(spark, sf_dir)).select("query_id", F.regexp_replace("prompt", r"score: [^\n]*", "score").alias("prompt"), F.array_join("context_ids", ",").alias("context_ids"))


def answer_refusal(spark, sf_dir):
    q, r = _results(spark, sf_dir)
    return an.answered(q, r, threshold=60.0).select("query_id", "answer", "insufficient_evidence", "context_count")


def answer_sanitize(spark, sf_dir):
    text = F.concat(F.lit("According to [a1] and  [b"), F.col("item_id"), F.lit("] [chunk_id: a1] (chunk_id: zz) [1] end"))
    return rq.questions(spark, sf_dir).select(F.col("query_id").alias("item_id")).select("item_id", an.without_unknown(text, F.array(F.lit("a1"), F.lit("b7"))).alias("answer"))


def unknown_refs(spark, sf_dir):
    text = F.concat(F.lit("see c1, (chunk_"), F.col("query_id"), F.lit(") and c1x but not abc2 [chunk-7]"))
    return rq.questions(spark, sf_dir).select("query_id", F.array_join(an.unknown_references(text, F.array(F.lit("c1"), F.lit("chunk_3"))), ",").alias("unknown"))


def groundedness_checks(spark, sf_dir):
    q, r = _results(spark, sf_dir)
    a = an.answered(q, r, threshold=60.0)
    out = an.validated(a.withColumn("citation_ids", F.col("context_ids")))
    return out.select("query_id", "valid", "checks.has_answer", "checks.insufficient_evidence_consistent", "checks.prompt_contains_grounding", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


def _figures(spark, sf_dir):
    """Every fifth line is a figure with a box by its position; the lines between two figures are a group."""
    b = bl.with_sections(bl.normalized(dq.line_blocks(spark, sf_dir)))
    i = F.col("sequence_no")
    figure = i % 5 == 0
    side = lambda n, m: ((i % n) * m).cast("double")
    b = b.withColumn("content_type", F.when(figure, "figure").when(i % 10 == 1, "caption").otherwise("paragraph")).withColumn("bbox", F.struct(F.lit(0.0).alias("x0"), side(7, 120).alias("y0"), side(3, 100).alias("x1"), (side(7, 120) + side(4, 20)).alias("y1")))
    for c, v in (("asset_id", F.concat(F.lit("fig_"), i % 15)), ("asset_uri", F.concat(F.lit("images/"), i)), ("asset_type", F.when(i % 2 == 0, "image").otherwise("unknown"))):
        b = b.withColumn(c, F.when(figure, v))
    return work.written(b.withColumn("group_no", F.when(~figure, F.floor(i / 5))), "figures")  # read again and again


def decorative_figures(spark, sf_dir):
    return at.decorative(_figures(spark, sf_dir)).groupBy("document_id", F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("figures"))


def _links(b):
    return at.linked(b, at.decorative(b))


def asset_report(spark, sf_dir):
    """The totals of asset inventories by document."""
    b = _figures(spark, sf_dir)
    out = at.asset_counts(at.inventories(b, _links(b)))
    kinds = F.array_join(F.transform(F.map_entries("assets_by_type"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return out.withColumn("assets_by_type", kinds)


def document_assets(spark, sf_dir):
    return at.document_assets(_figures(spark, sf_dir)).select("document_id", "asset_id", "asset_uri", "asset_type", "page_no")


def asset_links(spark, sf_dir):
    """Every figure's decision, its reason in words and its target."""
    target = F.col("block_distance")
    return _links(_figures(spark, sf_dir)).select("document_id", "sequence_no", "decision", "link_reason", F.coalesce(target, F.lit(-1)).alias("distance"))


def assets_for_blocks(spark, sf_dir):
    """Of a document's links those whose target is a block of an even page."""
    b = _figures(spark, sf_dir)
    links = _links(b).groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("sequence_no", "asset_id", "asset_uri", "asset_type", "link_strategy", "decision", "target_block_id"))).alias("assets"))
    even = b.where("content_type <> 'figure' AND page_no % 2 = 0").groupBy("document_id").agg(F.collect_set("block_id").alias("ids"))
    joined = links.join(even, "document_id", "left").withColumn("found", at.for_blocks(F.col("assets"), F.coalesce("ids", F.array().cast("array<string>")), True))
    return joined.select("document_id", F.array_join(F.transform("found.assets", lambda a: a["asset_id"]), ",").alias("assets"), "found.skipped")


def span_page_ranges(spark, sf_dir):
    """Sections of ten lines as chunks; every third line's span knows its page."""
    lines = line_chunks(spark, sf_dir)
    i = F.col("chunk_no") - 1
    span = F.struct(F.lit(None).cast("int").alias("page_start"), F.lit(0).alias("page_end"), F.when(i % 3 == 2, F.col("page_start")).alias("page_no"))
    groups = lines.groupBy("document_id", "section_title").agg(F.collect_list(span).alias("spans"), F.min("page_start").alias("page_start"))
    return groups.select("document_id", "section_title", hi.span_pages(F.col("spans"), F.col("page_start"), F.lit(0), F.lit(7)).alias("p")).select("document_id", "section_title", "p.*")


def audit_metadata(spark, sf_dir):
    """The metadata of index items, of a record's own fields and of the fields that it overlays."""
    out = hi.indexable(hi.hierarchical(line_chunks(spark, sf_dir), hi.HierarchyConfig(siblings=False))).where("chunk_type = 'child'")
    out = out.withColumns({"metadata": F.struct(F.lit("old").alias("chunk_type"), F.lit("kept").alias("origin"), F.array(F.lit("c1")).alias("clause_path")), "page_no": F.lit(9)})
    return out.select("document_id", "chunk_id", hi.audit_metadata(out).alias("m")).select("document_id", "chunk_id", "m.chunk_type", "m.origin", "m.source_chunk_id", "m.parent_chunk_id", "m.page_start", F.array_join("m.section_path", ">").alias("section_path"), F.array_join("m.clause_path", ">").alias("clause_path"), "m.clause_number", F.array_join("m.source_block_ids", ",").alias("blocks"), F.size("m.source_spans").alias("n_spans"), F.size("m.related_assets").alias("n_assets"))


def source_metadata(spark, sf_dir):
    """Lines as sources; every other one is narrowed to no block, and the first section is front matter."""
    lines = line_chunks(spark, sf_dir)
    i = F.col("chunk_no") - 1
    ids = F.when(i % 2 == 0, F.col("source_block_ids")).otherwise(F.array().cast("array<string>"))
    path = F.when(i < LINES_A_SECTION, F.array(F.lit("front_matter"))).otherwise(F.col("section_path"))
    region = hi.document_region(F.when(i % 5 == 4, "annex"), path, F.lit(False))
    return lines.select("document_id", "chunk_no", hi.source_metadata(region, ids, F.col("source_block_ids")).alias("m")).select("document_id", "chunk_no", F.size("m.source_block_ids").alias("n_blocks"), F.array_join("m.parent_source_block_ids", ",").alias("parents"), "m.document_region", "m.is_front_matter")


def native_items(spark, sf_dir):
    """Lines as a parser's items, with labels, boxes and Markdown by position."""
    lines = dq.documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    i = F.col("ord")
    label = F.element_at(F.array(*map(F.lit, ("Text", "section_header", "picture", "page_header", "table", "list_item"))), (i % 6 + 1).cast("int"))
    box = F.struct(F.when(i % 3 == 0, i).alias("l"), F.when(i % 3 == 1, i).alias("left"), (i + 1).alias("t"), F.lit(None).cast("int").alias("right"), (i * 2).alias("y1"), F.lit("TOPLEFT").alias("coord_origin"))
    items = lines.select("document_id", "ord", label.alias("label"), F.lit(0).alias("level"), F.when(i % 4 != 3, F.col("text")).alias("text"), F.concat(F.lit(" md "), i, F.lit(" ")).alias("markdown"), F.floor(i / 20).cast("int").alias("page_no"), box.alias("bbox"))
    return rd.native_blocks(items).select("document_id", "sequence_no", "label", "text", "markdown", "page_no", "bbox.x0", "bbox.y0", "bbox.x1", "bbox.y1")


def stored_figures(spark, sf_dir):
    """Documents as pages of figures, three a document, one without an image."""
    docs = dq.documents(spark, sf_dir)
    kinds = F.array(F.lit("image/png"), F.lit("image/JPEG"), F.lit("text"))
    pages = docs.select(F.col("doc_id").alias("document_id"), F.posexplode(kinds).alias("i", "kind"), F.base64(F.encode(F.substring("text", 1, 30), "utf-8")).alias("b"))
    uri = F.when(F.col("kind") != "text", F.concat(F.lit("data:"), "kind", F.lit(";base64,"), F.regexp_replace("b", r"\s", ""))).otherwise("no image")
    out = rd.stored_figures(pages.select("document_id", (F.col("i") + 1).alias("sequence_no"), F.when(F.col("i") > 0, F.col("i")).alias("page_no"), uri.alias("uri")))
    return out.select("document_id", "asset_id", "asset_uri", "mime_type", F.sha2("content", 256).alias("sha256"))


def asset_nearest_link(spark, sf_dir):
    b = _figures(spark, sf_dir)
    return at.linked(b, at.decorative(b)).groupBy("decision", "reason_code", "link_strategy").agg(F.count("*").alias("figures"), F.round(F.avg("link_score"), 9).alias("score"))


def asset_inventory(spark, sf_dir):
    return at.inventory(_figures(spark, sf_dir), "sequence_no").groupBy("document_id", "asset_type").agg(F.count("*").alias("assets"))


def _report(spark, sf_dir):
    blocks, chunks = dq._built(spark, sf_dir)
    return rp.report(blocks, chunks, ch.rebuilt(chunks, blocks), source_name=F.concat(F.lit("doc "), "document_id"))


#: Fields of the report that depend on how blocks are folded to chunks; they are in report_warnings.
_FOLDED = ("total_chunks", "avg_chunk_chars", "max_chunk_chars", "source_spans_total", "chunks_with_source_spans", "chunks_rebuildable_from_spans", "front_matter_chunks", "chunks_split", "chunks_mid_sentence", "chunks_hard_split", "warnings")


def _shown(report, names):
    shown = {"content_types_count": F.map_entries, "assets_by_type": F.map_entries}
    kinds = lambda n: F.array_join(F.transform(F.map_entries(n), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    lists = {"pages_detected": ",", "pages_without_text": ",", "warnings": "|"}
    return report.select(*(kinds(n).alias(n) if n in shown else F.array_join(n, lists[n]).alias(n) if n in lists else F.col(n) for n in names))


def parser_report(spark, sf_dir):
    return _shown(_report(spark, sf_dir), [f for f in rp.FIELDS if f not in _FOLDED])


def report_warnings(spark, sf_dir):
    """No SQL: counts of chunks of a fold; tests hold the texts."""
    return _shown(_report(spark, sf_dir), ["document_id", *_FOLDED])


def html_blocks(spark, sf_dir):
    """No SQL: a parser; tests hold small pages."""
    return rd.html_blocks(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def markdown_blocks(spark, sf_dir):
    md = F.concat(F.lit("# Title "), "doc_id", F.lit("\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n")), F.lit("\n\n![x](data:image/png;base64,aGk=)"))
    out = rd.exploded(dq.documents(spark, sf_dir).select(F.col("doc_id").alias("document_id"), rd.markdown_blocks(md).alias("blocks")))
    return out.select("document_id", "sequence_no", "label", "level", "text")


def json_node_walk(spark, sf_dir):
    source = F.to_json(F.struct(F.array(F.struct("text", F.lit("p").alias("label"), F.lit(2).alias("page_no")), F.struct("text", F.lit("p").alias("label"), F.lit(2).alias("page_no")), F.struct(F.lit("tail").alias("text"), F.lit("q").alias("label"), F.lit(3).alias("page_no"))).alias("texts")))
    return rd.json_nodes(dq.documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("document_id"), source.alias("json")))


_SC = """raw AS (SELECT doc_id AS document_id, unnest(range(0, len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS text FROM documents),
sc AS (SELECT *, 'S' || (i // 10) AS sec, i // 10 AS so, sha256(document_id || ':' || (i + 1)) AS chunk_id, sha256('rag:' || document_id || ':parent:S' || (i // 10)) AS pid, i % 7 = 3 AS is_table, CASE WHEN i % 4 = 0 THEN i + 1 END AS clause FROM raw)"""
#: Ranges of long lines: sentences, longer ones by words as many as fit, then as many of these as fit, closed once they
#: are long enough.  Two folds, each a recursion over the places of its units.
_RANGES = r"""lg AS (SELECT document_id, i, chunk_id, text FROM sc WHERE NOT is_table AND length(text) > 1800),
st0 AS (SELECT document_id, i, unnest(string_split(regexp_replace(text, '([.!?;:])(\s+)', '\1' || chr(1) || '\2', 'g'), chr(1))) AS p, unnest(range(0, len(string_split(regexp_replace(text, '([.!?;:])(\s+)', '\1' || chr(1) || '\2', 'g'), chr(1))))) AS k FROM lg),
st1 AS (SELECT *, sum(length(p)) OVER (PARTITION BY document_id, i ORDER BY k) - length(p) AS pos FROM st0),
st AS (SELECT document_id, i, k, CAST(pos + length(regexp_extract(p, '^\s*')) AS BIGINT) AS a, CAST(pos + length(regexp_replace(p, '\s+$', '')) AS BIGINT) AS b, p, pos FROM st1 WHERE regexp_matches(p, '\S')),
wd0 AS (SELECT document_id, i, k, pos, unnest(string_split(regexp_replace(p, '(\s+)', chr(1) || '\1', 'g'), chr(1))) AS w, unnest(range(0, len(string_split(regexp_replace(p, '(\s+)', chr(1) || '\1', 'g'), chr(1))))) AS j FROM st WHERE b - a > 1800),
wd1 AS (SELECT *, pos + sum(length(w)) OVER (PARTITION BY document_id, i, k ORDER BY j) - length(w) AS s FROM wd0),
wd AS (SELECT document_id, i, k, row_number() OVER (PARTITION BY document_id, i, k ORDER BY j) AS j, CAST(s + length(regexp_extract(w, '^\s*')) AS BIGINT) AS a, CAST(s + length(w) AS BIGINT) AS b FROM wd1 WHERE regexp_matches(w, '\S')),
wf AS (SELECT document_id, i, k, j, a AS start_, b AS end_, 1 AS g, b - a < 1800 AS open_ FROM wd WHERE j = 1 UNION ALL
  SELECT n.document_id, n.i, n.k, n.j, CASE WHEN f.open_ AND n.b - f.start_ <= 1800 THEN f.start_ ELSE n.a END, n.b, CASE WHEN f.open_ AND n.b - f.start_ <= 1800 THEN f.g ELSE f.g + 1 END, CASE WHEN f.open_ AND n.b - f.start_ <= 1800 THEN n.b - f.start_ < 1800 ELSE n.b - n.a < 1800 END
  FROM wf f JOIN wd n ON n.document_id = f.document_id AND n.i = f.i AND n.k = f.k AND n.j = f.j + 1),
un0 AS (SELECT document_id, i, a, b FROM st WHERE b - a <= 1800 UNION ALL SELECT document_id, i, min(start_), max(end_) FROM wf GROUP BY document_id, i, k, g),
un AS (SELECT *, row_number() OVER (PARTITION BY document_id, i ORDER BY a) AS j FROM un0),
uf AS (SELECT document_id, i, j, a AS start_, b AS end_, 1 AS g, b - a < 1200 AS open_ FROM un WHERE j = 1 UNION ALL
  SELECT n.document_id, n.i, n.j, CASE WHEN f.open_ AND n.b - f.start_ <= 1800 THEN f.start_ ELSE n.a END, n.b, CASE WHEN f.open_ AND n.b - f.start_ <= 1800 THEN f.g ELSE f.g + 1 END, CASE WHEN f.open_ AND n.b - f.start_ <= 1800 THEN n.b - f.start_ < 1200 ELSE n.b - n.a < 1200 END
  FROM uf f JOIN un n ON n.document_id = f.document_id AND n.i = f.i AND n.j = f.j + 1),
rg AS (SELECT document_id, i, g, min(start_) AS a, max(end_) AS b, count(*) OVER (PARTITION BY document_id, i) AS total FROM uf GROUP BY document_id, i, g),
fr AS (SELECT rg.document_id, i, sc.pid, g, total, text[a + 1 : b] AS content, sha256('rag:' || rg.document_id || ':fragment:' || sha256('rag:' || rg.document_id || ':child:' || sc.chunk_id) || ':' || g || ':' || left(text[a + 1 : b], 80)) AS id FROM rg JOIN sc USING (document_id, i) WHERE total > 1)"""
_CLAUSES = dq._clause_cte("nb", "text")
_ZEROS = ", ".join(f"0::BIGINT AS {f}" for f in rp.FIELDS if f not in _FOLDED and (f.startswith(("assets_", "figures_", "asset_links_", "blocks_without", "chunks_")) or f in ("tables_detected", "charts_detected", "diagrams_detected", "unknown_assets_detected", "base64_removed")) and f != "assets_by_type")
_TABLE_ID = "sha256('rag:' || document_id || ':table:' || chunk_id || ':1:' || left(text, 80))"
_FIG = f"""{dq._LINES}, {dq._NORMAL}, s AS ({dq.ORACLE['section_propagation']}),
fb AS (SELECT document_id, sequence_no AS i, page_no, section_title AS sec, sequence_no % 5 = 0 AS fig, sequence_no % 10 = 1 AS cap, sequence_no // 5 AS grp, (sequence_no % 7) * 120.0 AS y0, (sequence_no % 3) * 100.0 AS x1, (sequence_no % 7) * 120.0 + (sequence_no % 4) * 20.0 AS y1, 'fig_' || (sequence_no % 15) AS asset_id, CASE WHEN sequence_no % 2 = 0 THEN 'image' ELSE 'unknown' END AS kind FROM nb JOIN s USING (document_id, sequence_no)),
nx AS (SELECT *, min(CASE WHEN NOT fig THEN i END) OVER (PARTITION BY document_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ni FROM fb),
ps AS (SELECT document_id, y0, x1, y1, count(DISTINCT page_no) AS pages FROM fb WHERE fig GROUP BY ALL),
dc AS (SELECT f.*, t.grp AS ngrp, CASE WHEN coalesce(t.cap, false) THEN NULL WHEN f.sec = 'front_matter' THEN 'decorative_front_matter_logo' WHEN pages >= 2 AND (f.y0 + f.y1) / 2 >= 700 THEN 'decorative_repeated_header' WHEN pages >= 2 AND (f.y0 + f.y1) / 2 <= 100 THEN 'decorative_repeated_footer'
  WHEN pages >= 2 AND f.x1 <= 120 AND f.y1 - f.y0 <= 40 THEN 'decorative_repeated_position' WHEN f.x1 <= 120 AND f.y1 - f.y0 <= 40 AND ((f.y0 + f.y1) / 2 >= 700 OR (f.y0 + f.y1) / 2 <= 100) THEN 'decorative_small_logo' END AS reason
  FROM nx f LEFT JOIN fb t ON t.document_id = f.document_id AND t.i = f.ni JOIN ps ON ps.document_id = f.document_id AND ps.y0 = f.y0 AND ps.x1 = f.x1 AND ps.y1 = f.y1 WHERE f.fig),
cd AS (SELECT d.document_id, d.i, bool_or(t.i > d.i) AS later, bool_or(t.i > d.i AND t.page_no = d.page_no) AS page, min(CASE WHEN t.i > d.i AND t.page_no = d.page_no AND t.sec = d.sec THEN t.i END) AS ti FROM dc d LEFT JOIN fb t ON t.document_id = d.document_id AND t.grp = d.ngrp AND NOT t.fig GROUP BY ALL),
w0 AS (SELECT d.*, ti, ti - d.i AS dist, CASE WHEN reason IS NOT NULL THEN reason WHEN NOT coalesce(later, false) THEN 'no_posterior_text_candidate' WHEN NOT coalesce(c.page, false) THEN 'different_page' WHEN ti IS NULL THEN 'different_section' WHEN ti - d.i > 3 THEN 'distance_too_large' WHEN d.sec = 'front_matter' THEN 'front_matter_target' WHEN ti % 10 = 1 THEN 'caption_detected' ELSE 'same_page_nearest_text' END AS why FROM dc d JOIN cd c USING (document_id, i)),
lk AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'decorative' WHEN why IN ('caption_detected', 'same_page_nearest_text') THEN 'linked' ELSE 'not_linked' END AS decision FROM w0)"""
_RESULTS = rq._BM25 + """,
r AS (SELECT s.query_id, s.rank, s.score, CAST(s.chunk_id AS VARCHAR) AS chunk_id, 'p' || s.chunk_id AS source_chunk_id, s.chunk_id % 9 AS ps, CASE WHEN s.chunk_id % 5 > 0 THEN s.chunk_id % 9 + s.chunk_id % 3 - 1 END AS pe, 'S' || (s.chunk_id % 4) AS sec, c.content FROM sparse s JOIN c USING (chunk_id))"""
_PROMPT = an.PROMPT_HEAD.format(an.REFUSAL)
_ANSWERS = _RESULTS + f""",
best AS (SELECT query_id, max(score) AS best FROM r GROUP BY query_id), one AS (SELECT query_id, chunk_id AS first_id FROM r WHERE rank = 1), n AS (SELECT query_id, count(*) AS n FROM r GROUP BY query_id),
a AS (SELECT q.query_id, coalesce(best >= 60, false) AS ok, first_id, n FROM q LEFT JOIN best USING (query_id) LEFT JOIN one USING (query_id) LEFT JOIN n USING (query_id))"""

ORACLE = {
    "hierarchy_parents": f"""WITH {_SC}, d AS (SELECT document_id, pid, sec, so, text, min(i) AS i FROM sc WHERE text <> '' AND text <> 'Seção: ' || sec GROUP BY ALL),
p AS (SELECT document_id, pid, any_value(sec) AS sec, any_value(so) AS so, min(i // 20 + 1) AS page_start, max(i // 20 + 1) AS page_end FROM sc GROUP BY document_id, pid),
t AS (SELECT pid, string_agg(text, chr(10) || chr(10) ORDER BY i) AS body FROM d GROUP BY pid)
SELECT document_id, pid AS chunk_id, sec AS section_title, 'Seção: ' || sec || coalesce(chr(10) || chr(10) || body, '') AS content, page_start, page_end, lag(pid) OVER w AS previous_chunk_id, lead(pid) OVER w AS next_chunk_id FROM p LEFT JOIN t USING (pid) WINDOW w AS (PARTITION BY document_id ORDER BY so)""",
    "section_context": f"""WITH {_SC}, x AS (SELECT document_id, pid, any_value(sec) AS sec, string_agg(CASE WHEN NOT is_table AND clause IS NOT NULL THEN '- Sub ' || (i // 4) END, chr(10) ORDER BY i) AS subs,
  string_agg(CASE WHEN NOT is_table AND clause IS NOT NULL THEN '- ' || clause END, chr(10) ORDER BY i) AS cls, count(CASE WHEN is_table THEN 1 END) AS tables FROM sc GROUP BY document_id, pid)
SELECT document_id, sha256('rag:' || document_id || ':section_context:' || pid) AS chunk_id, pid AS parent_chunk_id, 'Seção: ' || sec || coalesce(chr(10) || chr(10) || 'Subseções:' || chr(10) || subs, '') || coalesce(chr(10) || chr(10) || 'Cláusulas:' || chr(10) || cls, '') || CASE WHEN tables > 0 THEN chr(10) || chr(10) || 'Tabelas: ' || tables ELSE '' END AS content FROM x""",
    "hierarchy_children": f"WITH {_SC} SELECT document_id, sha256('rag:' || document_id || ':child:' || chunk_id) AS chunk_id, pid AS parent_chunk_id, chunk_id AS source_chunk_id, length(text) AS chars, length(text) > 1800 AS has_fragments FROM sc WHERE NOT is_table",
    "sibling_links": f"""WITH RECURSIVE {_SC}, {_RANGES}, u AS (SELECT document_id, pid, i, 0 AS g, CASE WHEN is_table THEN {_TABLE_ID} ELSE sha256('rag:' || document_id || ':child:' || chunk_id) END AS id FROM sc
  UNION ALL SELECT document_id, pid, i, g, id FROM fr UNION ALL SELECT DISTINCT document_id, pid, -1, 0, sha256('rag:' || document_id || ':section_context:' || pid) FROM sc)
SELECT document_id, id AS chunk_id, coalesce(lag(id) OVER w, '') AS previous, coalesce(lead(id) OVER w, '') AS next, count(*) OVER (PARTITION BY document_id, pid) - 1 AS siblings FROM u WINDOW w AS (PARTITION BY document_id, pid ORDER BY i, g)""",
    "fragment_semantic": f"""WITH RECURSIVE {_SC}, {_RANGES} SELECT document_id, id AS chunk_id, 'fragment' AS chunk_type, g AS fragment_index, total AS fragment_total, content, 'b' || i AS blocks FROM fr
UNION ALL SELECT document_id, {_TABLE_ID}, 'table', NULL, NULL, text, 'b' || i FROM sc WHERE is_table""",
    "index_filter": f"""WITH RECURSIVE {_SC}, {_RANGES} SELECT document_id, chunk_type, count(*) AS n, sum(length(content))::BIGINT AS chars FROM (SELECT document_id, CASE WHEN is_table THEN 'table' ELSE 'child' END AS chunk_type, text AS content FROM sc
UNION ALL SELECT document_id, 'fragment', content FROM fr) WHERE trim(content) <> '' GROUP BY ALL""",
    "citations_pages": f"WITH {_RESULTS} SELECT query_id, rank, chunk_id, source_chunk_id, CASE WHEN pe IS NULL OR pe < ps THEN CAST(ps AS VARCHAR) ELSE array_to_string(range(ps, pe + 1), ',') END AS pages, sec AS section_path FROM r",
    "answer_prompt": f"""WITH {_RESULTS}, bl AS (SELECT query_id, rank, chunk_id, '[rank ' || rank || ']' || chr(10) || 'score' || chr(10) || 'chunk_id: ' || chunk_id || chr(10) || 'source_chunk_id: ' || source_chunk_id || chr(10) || 'pages: ' || ps || '-' || coalesce(CAST(pe AS VARCHAR), 'None') || chr(10) ||
  'section_path: ["' || sec || '"]' || chr(10) || 'content:' || chr(10) || CASE WHEN length(content) <= 2400 THEN content ELSE regexp_replace(left(content, 2400), '\\s+$', '') || chr(10) || '[trecho truncado]' END AS b FROM r)
SELECT query_id, '{_PROMPT.replace("'", "''")}' || 'Pergunta do usuário:' || chr(10) || any_value(b.text) || chr(10) || chr(10) || 'Contexto recuperado:' || chr(10) || string_agg(b, chr(10) || chr(10) ORDER BY rank) || chr(10) || chr(10) || 'Resposta final:' AS prompt, string_agg(chunk_id, ',' ORDER BY rank) AS context_ids
FROM bl JOIN (SELECT CAST(item_id AS VARCHAR) AS query_id, text FROM benchmark) b USING (query_id) GROUP BY query_id""",
    "answer_refusal": f"WITH {_ANSWERS} SELECT query_id, CASE WHEN ok THEN 'Resposta baseada nos trechos recuperados. [' || first_id || ']' ELSE '{an.REFUSAL}' END AS answer, NOT ok AS insufficient_evidence, CASE WHEN ok THEN n ELSE 0 END AS context_count FROM a",
    "answer_sanitize": "SELECT CAST(item_id AS VARCHAR) AS item_id, 'According to [a1] and ' || CASE WHEN item_id = 7 THEN '[b7] ' ELSE '' END || '[chunk_id: a1] end' AS answer FROM benchmark",
    "unknown_refs": "SELECT CAST(item_id AS VARCHAR) AS query_id, array_to_string(list_sort(list_filter(['c1x', 'chunk_' || item_id, 'chunk-7'], lambda x: x <> 'chunk_3')), ',') AS unknown FROM benchmark",
    "groundedness_checks": f"WITH {_ANSWERS} SELECT query_id, true AS valid, true AS has_answer, true AS insufficient_evidence_consistent, ok AS prompt_contains_grounding, '' AS errors, CASE WHEN ok THEN '' ELSE 'prompt_not_available_for_validation' END AS warnings FROM a",
    "markdown_blocks": r"""WITH p AS (SELECT doc_id AS document_id, list_filter(list_transform(string_split('# Title ' || doc_id || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) || chr(10) || chr(10) || '![x](data:image/png;base64,aGk=)', chr(10) || chr(10)), lambda x: trim(x)), lambda x: x <> '') AS a FROM documents),
u AS (SELECT document_id, unnest(range(1, len(a) + 1)) AS sequence_no, unnest(a) AS x FROM p)
SELECT document_id, sequence_no, CASE WHEN contains(x, 'data:image/') THEN 'figure' WHEN x[1] = '#' THEN 'section_header' ELSE 'text' END AS label, CASE WHEN x[1] = '#' THEN length(regexp_extract(x, '^(#+)', 1)) END AS level, CASE WHEN contains(x, 'data:image/') THEN '' WHEN x[1] = '#' THEN trim(regexp_replace(x, '^#+', '')) ELSE x END AS text FROM u""",
    "json_node_walk": r"SELECT CAST(doc_id AS VARCHAR) AS document_id, 1 AS sequence_no, 'p' AS label, 2 AS page_no, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM documents WHERE regexp_matches(text, '\S') UNION ALL SELECT CAST(doc_id AS VARCHAR), CASE WHEN regexp_matches(text, '\S') THEN 2 ELSE 1 END, 'q', 3, 'tail' FROM documents",
    "decorative_figures": f"WITH {_FIG} SELECT document_id, coalesce(reason, 'none') AS reason, count(*) AS figures FROM dc GROUP BY ALL",
    "asset_nearest_link": f"WITH {_FIG} SELECT decision, why AS reason_code, CASE decision WHEN 'linked' THEN why WHEN 'decorative' THEN 'not_linked_decorative' ELSE 'not_linked' END AS link_strategy, count(*) AS figures, round(avg(CASE WHEN decision = 'linked' THEN CASE WHEN why = 'caption_detected' THEN 1.0 ELSE 0.75 END END), 9)::DOUBLE AS score FROM lk GROUP BY ALL",
    "asset_links": f"""WITH {_FIG} SELECT document_id, i AS sequence_no, decision, CASE WHEN decision = 'decorative' THEN 'figure was marked decorative: ' || why WHEN decision = 'not_linked' THEN 'figure could not be safely linked: ' || why WHEN why = 'caption_detected' THEN 'figure has caption immediately after image'
  ELSE 'figure is within ' || dist || ' block(s) before nearest text candidate on same page and same section' END AS link_reason, CASE WHEN decision = 'linked' THEN dist ELSE -1 END AS distance FROM lk""",
    "document_assets": f"WITH {_FIG} SELECT document_id, asset_id, 'images/' || min(i) AS asset_uri, arg_min(kind, i) AS asset_type, arg_min(page_no, i) AS page_no FROM fb WHERE fig GROUP BY document_id, asset_id",
    "assets_for_blocks": f"""WITH {_FIG}, f AS (SELECT document_id, asset_id, min(i) AS i, arg_min(ti, i) AS ti FROM lk WHERE decision = 'linked' GROUP BY document_id, asset_id), e AS (SELECT f.* FROM f JOIN fb t ON t.document_id = f.document_id AND t.i = f.ti WHERE t.page_no % 2 = 0)
SELECT document_id, coalesce(string_agg(e.asset_id, ',' ORDER BY e.i), '') AS assets, false AS skipped FROM (SELECT DISTINCT document_id FROM lk) LEFT JOIN e USING (document_id) GROUP BY document_id""",
    "asset_report": f"""WITH {_FIG}, k AS (SELECT document_id, asset_id, bool_or(kind = 'image') AS saved, bool_or(decision = 'linked') AS is_linked, coalesce(bool_or(kind = 'image') FILTER (decision = 'linked'), false) AS linked, bool_or(decision = 'decorative') AS is_decorative, coalesce(bool_or(kind = 'image') FILTER (decision = 'decorative'), false) AS decorative,
  bool_or(decision = 'not_linked') AS is_explicit, coalesce(bool_or(kind = 'image') FILTER (decision = 'not_linked'), false) AS explicit FROM lk GROUP BY document_id, asset_id),
u AS (SELECT *, is_explicit OR NOT (is_linked OR is_decorative) AS is_unlinked FROM k)
SELECT document_id, count(*) AS assets_detected_total, count(*) AS assets_saved_total, count_if(is_linked)::BIGINT AS assets_linked_total, count_if(is_unlinked)::BIGINT AS assets_unlinked_total, count_if(is_decorative)::BIGINT AS assets_decorative_total, count_if(saved)::BIGINT AS figures_detected, count_if(saved)::BIGINT AS figures_saved, count_if(linked)::BIGINT AS figures_linked_to_chunks,
  count_if(is_unlinked AND CASE WHEN is_explicit THEN explicit ELSE saved END)::BIGINT AS figures_unlinked, count_if(decorative)::BIGINT AS figures_marked_decorative, array_to_string(list_filter([CASE WHEN count_if(saved) > 0 THEN 'image=' || count_if(saved) END, CASE WHEN count_if(NOT saved) > 0 THEN 'unknown=' || count_if(NOT saved) END], lambda x: x IS NOT NULL), ',') AS assets_by_type,
  0::BIGINT AS tables_detected, 0::BIGINT AS charts_detected, 0::BIGINT AS diagrams_detected, count_if(NOT saved)::BIGINT AS unknown_assets_detected FROM u GROUP BY document_id""",
    "span_page_ranges": f"""WITH {_SC}, p AS (SELECT document_id, sec, min(CASE WHEN i % 3 = 2 THEN i // 20 + 1 END) AS a, max(CASE WHEN i % 3 = 2 THEN i // 20 + 1 END) AS b, min(i // 20 + 1) AS own FROM sc GROUP BY document_id, sec)
SELECT document_id, sec AS section_title, coalesce(a, own)::INTEGER AS page_start, coalesce(b, 7)::INTEGER AS page_end, CASE WHEN a IS NULL THEN 'inherited_from_source_chunk' ELSE 'derived_from_source_spans' END AS page_range_strategy FROM p""",
    "audit_metadata": f"WITH {_SC} SELECT document_id, sha256('rag:' || document_id || ':child:' || chunk_id) AS chunk_id, 'child' AS chunk_type, 'kept' AS origin, chunk_id AS source_chunk_id, pid AS parent_chunk_id, i // 20 + 1 AS page_start, sec AS section_path, 'c1' AS clause_path, CAST(clause AS VARCHAR) AS clause_number, 'b' || i AS blocks, 1 AS n_spans, 0 AS n_assets FROM sc WHERE NOT is_table AND trim(text) <> ''",
    "source_metadata": f"""WITH {_SC}, r AS (SELECT *, CASE WHEN i % 5 = 4 THEN 'annex' WHEN i < 10 THEN 'front_matter' END AS region FROM sc)
SELECT document_id, i + 1 AS chunk_no, CASE WHEN i % 2 = 0 THEN 1 ELSE 0 END AS n_blocks, CASE WHEN i % 2 = 1 THEN 'b' || i END AS parents, region AS document_region, CASE WHEN region = 'front_matter' THEN true END AS is_front_matter FROM r""",
    "native_items": f"""WITH raw AS (SELECT doc_id AS document_id, unnest(range(0, len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS text FROM documents), p AS (SELECT *, ['text', 'section_header', 'picture', 'page_header', 'table', 'list_item'][i % 6 + 1] AS label, CASE WHEN i % 4 <> 3 THEN {dq._PLAIN.format('text')} ELSE '' END AS t FROM raw),
b AS (SELECT *, CASE WHEN label = 'picture' THEN '' WHEN t <> '' THEN t ELSE 'md ' || i END AS own FROM p WHERE label <> 'page_header')
SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY i) AS sequence_no, label, own AS text, CASE WHEN label = 'table' THEN 'md ' || i END AS markdown, i // 20 AS page_no, CASE WHEN i % 3 < 2 THEN i END::DOUBLE AS x0, (i + 1)::DOUBLE AS y0, NULL::DOUBLE AS x1, (i * 2)::DOUBLE AS y1 FROM b""",
    "stored_figures": "SELECT doc_id AS document_id, 'fig_00' || n AS asset_id, CASE n WHEN 1 THEN 'images/page_000_figure_001.png' ELSE 'images/page_001_figure_002.jpg' END AS asset_uri, CASE n WHEN 1 THEN 'image/png' ELSE 'image/jpeg' END AS mime_type, sha256(left(text, 30)) AS sha256 FROM documents, (SELECT unnest([1, 2]) AS n) WHERE text <> ''",
    "asset_inventory": f"""WITH {dq._LINES}, {dq._NORMAL}, f AS (SELECT document_id, sequence_no, 'fig_' || (sequence_no % 15) AS key, CASE WHEN sequence_no % 2 = 0 THEN 'image' END AS t FROM nb WHERE sequence_no % 5 = 0)
SELECT document_id, asset_type, count(*) AS assets FROM (SELECT document_id, key, coalesce(min(t), 'unknown') AS asset_type FROM f GROUP BY ALL) GROUP BY ALL""",
    "parser_report": f"""WITH {dq._LINES}, {dq._NORMAL}, s AS ({{section}}),
{_CLAUSES}, ct AS (SELECT document_id, string_agg(t || '=' || n, ',' ORDER BY t) AS types FROM (SELECT document_id, CASE WHEN kind IS NOT NULL OR {dq._UPPER.format('text')} THEN 'title' WHEN num IS NOT NULL THEN 'list_item' ELSE 'paragraph' END AS t, count(*) AS n FROM k GROUP BY ALL) GROUP BY document_id),
g AS (SELECT document_id, max(page_total) AS pt, count(*) AS n, list_sort(list(DISTINCT page_no)) AS pages, round(avg(length(text)), 6) AS chars, count(CASE WHEN is_front_matter THEN 1 END) AS front FROM nb JOIN s USING (document_id, sequence_no) GROUP BY document_id)
SELECT document_id, 'stratadoc' AS parser_name, 'doc ' || document_id AS source_name, pt AS page_total, n AS total_blocks, types AS content_types_count, array_to_string(pages, ',') AS pages_detected, array_to_string(list_filter(range(1, pt + 1), lambda x: NOT list_contains(pages, x)), ',') AS pages_without_text, chars AS avg_block_chars, front AS front_matter_blocks, '' AS assets_by_type, {_ZEROS} FROM g JOIN ct USING (document_id)""".replace("{section}", dq.ORACLE["section_propagation"]),
}
QUERIES = {f.__name__: f for f in (asset_report, document_assets, asset_links, assets_for_blocks, span_page_ranges, audit_metadata, source_metadata, native_items, stored_figures, hierarchy_parents, section_context, hierarchy_children, fragment_semantic, sibling_links, index_filter, citations_pages, answer_prompt, answer_refusal, answer_sanitize, unknown_refs, groundedness_checks, decorative_figures, asset_nearest_link, asset_inventory, parser_report, report_warnings, html_blocks, markdown_blocks, json_node_walk)}
