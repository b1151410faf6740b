"""Chunks to a hierarchy of retrieval records: parent, section context, child, fragment, table.

One projection a record type, united by name; order is carried by columns (section_ord, at, piece).  Only the split of
long texts into ranges needs Python, over Arrow batches of whole chunks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import headings as hd

#: Fixed boundaries of list items and sentences.
LIST_ITEM = re.compile(r"(?m)(?=^\s*(?:[-*\u2022]|\d+(?:\.\d+)*[.)]?)\s+)")
SENTENCE = re.compile(r"(?<=[.!?;:])\s+")
PARAGRAPH = re.compile(r"\S(?:.*?\S)?(?=\n\s*\n+|\Z)", re.S)
INDEXED, SKIPPED = ("child", "fragment", "table"), ("parent", "section_context")


@dataclass(frozen=True)
class HierarchyConfig:
    target_chars: int = 1200
    max_chars: int = 1800
    section_context: bool = True
    siblings: bool = True  # arrays of n - 1 ids for each of n records: quadratic in a section, by contract


def record_key(document_id: Column, kind: str, basis: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit("rag"), document_id, F.lit(kind), basis), 256)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    own = text[start:end]
    return start + len(own) - len(own.lstrip()), start + len(own.rstrip())


def _words(text: str, start: int, end: int, most: int) -> list[tuple[int, int]]:
    """Ranges of as many words as fit; a longer word stays whole."""
    out: list[tuple[int, int]] = []
    open_ = False
    for m in re.finditer(r"\S+", text[start:end]):
        a, b = start + m.start(), start + m.end()
        if open_ and b - out[-1][0] <= most:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
        open_ = out[-1][1] - out[-1][0] < most
    return out


def _units(text: str, most: int) -> list[tuple[int, int]]:
    """Paragraphs; a longer one by its list items, else by its sentences, else by words."""
    out = []
    for m in PARAGRAPH.finditer(text):
        start, end = m.span()
        if end - start <= most:
            out.append((start, end))
            continue
        items = sorted({start, *(x.start() for x in LIST_ITEM.finditer(text, start, end))})
        parts = [_trimmed(text, a, b) for a, b in zip(items, [*items[1:], end], strict=True)]
        if len([p for p in parts if p[0] < p[1]]) < 2:
            marks = [(x.start(), x.end()) for x in SENTENCE.finditer(text, start, end)]
            parts = [_trimmed(text, a, b) for a, b in zip([start, *(x[1] for x in marks)], [*(x[0] for x in marks), end], strict=True)]
        for a, b in (p for p in parts if p[0] < p[1]):
            out += [(a, b)] if b - a <= most else _words(text, a, b, most)
    return out


def semantic_ranges(text: str, target: int, most: int) -> list[tuple[int, int]]:
    """Ranges of whole units, at least ``target`` long where they can be, never over ``most`` but for a single word."""
    if len(text) <= most:
        return [(0, len(text))]
    out: list[list[int]] = []
    open_ = False
    for a, b in _units(text, most):
        if open_ and b - out[-1][0] <= most:
            out[-1][1] = b
        else:
            out.append([a, b])
        open_ = out[-1][1] - out[-1][0] < target
    return [(a, b) for a, b in out if text[a:b].strip()]


def table_groups(text: str, most: int) -> list[list[tuple[int, int]]]:
    """Row groups of a long Markdown table, each with the two header lines; anything else is one group."""
    rows = [m.span() for m in re.finditer(r"[^\n]+", text) if m[0].strip()]
    if len(text) <= most or len(rows) <= 3 or any("|" not in text[a:b] for a, b in rows[:2]):
        return [[(0, len(text))]]
    head = (rows[0][0], rows[1][1])
    out: list[list[tuple[int, int]]] = []
    held = last = head[1]
    for a, b in rows[2:]:
        if not out or held + b - last > most:
            held = head[1] - head[0] + (b - a + 1 if out else b - last)
            out.append([head, (a, b)])
        else:
            held += b - last
            out[-1][1] = out[-1][1][0], b
        last = b
    return out


def group_text(text: str, group: list[tuple[int, int]]) -> str:
    parts = [text[a:b] for a, b in group]
    if len(group) < 2:
        return parts[0]
    gap = text[group[0][1] : group[1][0]]
    return parts[0] + (gap if gap and not gap.strip() else "\n") + parts[1]


def _cut(config: HierarchyConfig):
    piece = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))

    def run(batches):
        for batch in batches:
            out = []
            for text, table in zip(batch.column("text").to_pylist(), batch.column("is_table").to_pylist(), strict=True):
                if table:
                    out.append([{"start": g[-1][0], "end": g[-1][1], "text": group_text(text, g)} for g in table_groups(text, config.max_chars)])
                else:
                    out.append([{"start": a, "end": b, "text": text[a:b]} for a, b in semantic_ranges(text, config.target_chars, config.max_chars)])
            yield batch.append_column("pieces", pa.array(out, piece))

    return run


def sliced_spans(spans: Column, start: Column, end: Column) -> Column:
    """The spans that overlap a range, their offsets relative to it."""
    low, high = lambda s: F.greatest(start, s["chunk_start_char"]), lambda s: F.least(end, s["chunk_end_char"])

    def part(s):
        first = s["block_start_char"] + low(s) - s["chunk_start_char"]
        return F.struct(s["block_id"].alias("block_id"), first.alias("block_start_char"), (first + high(s) - low(s)).alias("block_end_char"), (low(s) - start).alias("chunk_start_char"), (high(s) - start).alias("chunk_end_char"))

    return F.transform(F.filter(spans, lambda s: low(s) < high(s)), part)


def page_range(start: Column, end: Column, no: Column) -> tuple[Column, Column]:
    """Least and greatest page of a group of rows; a page of 0 is unknown."""
    known = lambda c: F.when(c != 0, c)
    first, last = F.coalesce(known(start), known(no)), F.coalesce(known(end), known(no))
    return F.min(first), F.max(last)


def hierarchical(chunks: DataFrame, config: HierarchyConfig = HierarchyConfig()) -> DataFrame:
    """chunks: document_id, chunk_id, chunk_no, text, content_type, section_path, section_title, subsection_title,
    clause_number, page_start, page_end, source_block_ids, source_spans."""
    document = F.col("document_id").cast("string")
    path = F.when(F.size("section_path") > 0, F.col("section_path")).otherwise(F.array(F.lit("__unsectioned__"), document))
    spans = F.transform("source_spans", lambda s: F.struct(*(s[c].alias(c) for c in ("block_id", "block_start_char", "block_end_char", "chunk_start_char", "chunk_end_char"))))
    base = chunks.withColumns({"key": F.array_join(path, ">"), "is_table": F.coalesce(F.col("content_type") == "table", F.lit(False)), "text": F.coalesce("text", F.lit("")), "source_spans": spans})
    base = base.withColumn("parent_id", record_key(document, "parent", F.col("key")))
    row = F.struct("chunk_no", "text", F.col("chunk_id"), "clause_number", "subsection_title", "is_table")
    first, last = page_range(F.col("page_start"), F.col("page_end"), F.col("page_start"))
    sections = base.groupBy("document_id", "key", "parent_id").agg(F.min("chunk_no").alias("section_ord"), F.min_by("section_path", "chunk_no").alias("section_path"), F.min_by("section_title", "chunk_no").alias("section_title"), first.alias("page_start"), last.alias("page_end"), F.array_sort(F.collect_list(row)).alias("rows"))
    sections = sections.withColumn("section_title", F.coalesce("section_title", F.element_at(F.split("key", ">"), -1)))
    title = F.concat(F.lit("Seção: "), "section_title")
    texts = F.array_distinct(F.concat(F.array(title), F.filter(F.transform("rows", lambda x: x["text"]), lambda t: t != "")))
    common = ["document_id", "section_ord", F.col("parent_id").alias("section_root_chunk_id"), "section_title", "section_path"]
    parent = sections.select(*common, F.lit("parent").alias("chunk_type"), F.col("parent_id").alias("chunk_id"), F.array_join(texts, "\n\n").alias("content"), "page_start", "page_end", F.lit(-2).alias("at"), F.lit(0).alias("piece"))
    plain = F.filter("rows", lambda x: ~x["is_table"] & (F.coalesce(x["clause_number"], F.lit("")) != ""))
    names = lambda f: F.array_distinct(F.filter(F.transform(plain, lambda x: x[f]), lambda v: v.isNotNull() & (v != "")))
    listed = lambda head, items: F.when(F.size(items) > 0, F.concat(F.array(F.lit(""), F.lit(head)), F.transform(items, lambda v: F.concat(F.lit("- "), v)))).otherwise(F.array().cast("array<string>"))
    tables = F.size(F.filter("rows", lambda x: x["is_table"]))
    counted = F.when(tables > 0, F.array(F.lit(""), F.concat(F.lit("Tabelas: "), tables))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(F.array(F.rtrim(title)), listed("Subseções:", names("subsection_title")), listed("Cláusulas:", names("clause_number")), counted)
    out = parent
    if config.section_context:
        out = out.unionByName(sections.select(*common, F.lit("section_context").alias("chunk_type"), record_key(document, "section_context", F.col("parent_id")).alias("chunk_id"), F.col("parent_id").alias("parent_chunk_id"), F.array_join(lines, "\n").alias("content"), "page_start", "page_end", F.lit(-1).alias("at"), F.lit(0).alias("piece")), allowMissingColumns=True)
    heads = sections.select("parent_id", "section_ord", F.col("section_title").alias("__title"))
    redundant = (F.col("content_type") == "title") & F.col("clause_number").isNotNull() & (F.col("text") == F.col("__title"))
    rows = base.join(heads, "parent_id").where(~F.coalesce(redundant, F.lit(False)))
    cut = rows.mapInArrow(_cut(config), T.StructType([*rows.schema.fields, *T._parse_datatype_string("pieces array<struct<start:int,end:int,text:string>>").fields]))
    child_id = record_key(document, "child", F.coalesce("chunk_id", F.substring("text", 1, 160)))
    shared = ["document_id", "section_ord", F.col("parent_id").alias("section_root_chunk_id"), F.col("parent_id").alias("parent_chunk_id"), F.col("chunk_id").alias("source_chunk_id"), "section_title", "subsection_title", "section_path", "clause_number", F.col("chunk_no").alias("at"), "page_start", "page_end"]
    child = cut.where("NOT is_table").select(*shared, F.lit("child").alias("chunk_type"), child_id.alias("chunk_id"), F.col("text").alias("content"), "source_block_ids", "source_spans", F.lit(0).alias("piece"), (F.size("pieces") > 1).alias("has_fragments"))
    many = cut.where("is_table OR size(pieces) > 1").withColumn("total", F.size("pieces")).select("*", F.posexplode("pieces").alias("i", "p"))
    i, whole = F.col("i") + 1, F.col("total") == 1
    own = F.when(whole, F.col("source_spans")).otherwise(sliced_spans(F.col("source_spans"), F.col("p.start"), F.col("p.end")))
    cuts = many.withColumn("own", own).withColumn("blocks", F.when(whole, F.col("source_block_ids")).otherwise(F.array_distinct(F.transform("own", lambda s: s["block_id"]))))
    fragment = cuts.where("NOT is_table").select(*shared, F.lit("fragment").alias("chunk_type"), record_key(document, "fragment", F.concat_ws(":", child_id, i, F.substring("p.text", 1, 80))).alias("chunk_id"), child_id.alias("source_child_chunk_id"), F.col("p.text").alias("content"), F.col("blocks").alias("source_block_ids"), F.col("own").alias("source_spans"), i.alias("piece"), i.alias("fragment_index"), F.col("total").alias("fragment_total"))
    table = cuts.where("is_table").select(*shared, F.lit("table").alias("chunk_type"), record_key(document, "table", F.concat_ws(":", "chunk_id", i, F.substring("p.text", 1, 80))).alias("chunk_id"), F.col("p.text").alias("content"), F.col("blocks").alias("source_block_ids"), F.col("own").alias("source_spans"), i.alias("piece"), F.when(~whole, F.col("chunk_id")).alias("source_table_chunk_id"), F.when(~whole, i).alias("table_fragment_index"), F.when(~whole, F.col("total")).alias("table_fragment_total"))
    for part in (child, fragment, table):
        out = out.unionByName(part, allowMissingColumns=True)
    return linked(out, config.siblings)


def linked(records: DataFrame, siblings: bool = True) -> DataFrame:
    """previous, next and sibling ids among a section's records, and among the parents of a document."""
    group = ["document_id", F.when(F.col("chunk_type") == "parent", "").otherwise(F.col("section_root_chunk_id"))]
    order = Window.partitionBy(*group).orderBy("section_ord", "at", "piece", "chunk_id")
    out = records.withColumns({"previous_chunk_id": F.lag("chunk_id").over(order), "next_chunk_id": F.lead("chunk_id").over(order)})
    if siblings:
        every = F.collect_list("chunk_id").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        out = out.withColumn("sibling_chunk_ids", F.filter(every, lambda x: x != F.col("chunk_id")))
    return out


# ---- what goes into the index

def content_of(columns: list[str]) -> Column:
    """content, else text, else page_content; an empty one counts as missing."""
    have = [F.nullif(F.col(c), F.lit("")) for c in ("content", "text", "page_content") if c in columns]
    return F.coalesce(*have, F.lit(""))


def indexable(records: DataFrame) -> DataFrame:
    kind = F.coalesce("chunk_type", F.lit(""))
    traced = (F.coalesce("source_chunk_id", F.lit("")) != "") | (F.size("source_block_ids") > 0)
    return records.where((F.trim(content_of(records.columns)) != "") & ~kind.isin(*SKIPPED) & (kind.isin(*INDEXED) | traced))


def document_region(explicit: Column, section_path: Column, front: Column) -> Column:
    is_front = (section_path == F.array(F.lit(hd.FRONT))) | F.coalesce(front, F.lit(False))
    return F.coalesce(F.nullif(explicit, F.lit("")), F.when(is_front, hd.FRONT))


#: Fields of a record that an index item's metadata takes over, in order; fixed values.
AUDITED = (
    "chunk_type", "source_chunk_id", "source_child_chunk_id", "source_table_chunk_id", "parent_chunk_id", "section_root_chunk_id", "page_start", "page_end", "page_total", "section_path", "section_title", "subsection_title", "clause_number", "clause_path",
    "source_block_ids", "source_spans", "related_assets", "content_types", "previous_chunk_id", "next_chunk_id", "sibling_chunk_ids", "fragment_index", "fragment_total", "table_fragment_index", "table_fragment_total", "table_quality", "table_structure",
)
_LISTS = ("section_path", "source_block_ids", "source_spans", "related_assets", "content_types", "clause_path")


def audit_metadata(records: DataFrame) -> Column:
    """The metadata of an index item: the record's own metadata, overlaid by what audited fields it has; pages fall back on
    page_no, lists on empty ones.  A field that is there but null counts as missing, as columns are typed."""
    have = set(records.columns)
    inner = {f.name for f in records.schema["metadata"].dataType} if "metadata" in have else set()
    out = {f: F.col("metadata")[f] for f in inner}
    for field in AUDITED:
        found = [F.col(field)] if field in have else []
        found += [out[field]] if field in out else []
        found += [F.col("page_no")] if field in ("page_start", "page_end") and "page_no" in have else []
        if found and field in _LISTS:
            found.append(F.slice(found[0], 1, 0))
        value = F.coalesce(*found) if found else F.array().cast("array<string>") if field in _LISTS else F.lit(None).cast("string")
        if field in _LISTS and found:
            value = F.coalesce(value, F.array())
        out[field] = value
    return F.struct(*(v.alias(k) for k, v in out.items()))


def source_metadata(region: Column, block_ids: Column, parent_block_ids: Column) -> Column:
    """What a record tells of its source: the blocks, those of the whole source where they are more, the region, and
    whether it is front matter."""
    narrowed = F.when(block_ids != parent_block_ids, parent_block_ids)
    return F.struct(block_ids.alias("source_block_ids"), narrowed.alias("parent_source_block_ids"), region.alias("document_region"), F.when(region == hd.FRONT, True).alias("is_front_matter"))


def span_pages(spans: Column, page_start: Column, page_end: Column, page_no: Column) -> Column:
    """Page range of spans (page_start, page_end, page_no), else that of the source; and where it comes from."""
    known = lambda c: F.nullif(c, F.lit(0))
    ends = F.filter(F.flatten(F.transform(spans, lambda s: F.array(F.coalesce(known(s["page_start"]), s["page_no"]), F.coalesce(known(s["page_end"]), s["page_no"])))), lambda p: p.isNotNull())
    some = F.size(ends) > 0
    return F.struct(
        F.when(some, F.array_min(ends)).otherwise(F.coalesce(known(page_start), page_no)).alias("page_start"),
        F.when(some, F.array_max(ends)).otherwise(F.coalesce(known(page_end), page_no)).alias("page_end"),
        F.when(some, "derived_from_source_spans").otherwise("inherited_from_source_chunk").alias("page_range_strategy"),
    )


def embedded(records: DataFrame, load, dimension_type: str = "double") -> DataFrame:
    """Adds an embedding by a model that ``load`` gives once for each Python worker; one vector a text or ValueError."""

    def run(batches):
        model = load()
        for batch in batches:
            vectors = [list(map(float, v)) for v in model(batch.column("content").to_pylist())]
            if len(vectors) != batch.num_rows:
                raise ValueError("the model must return one vector a text")
            yield batch.append_column("embedding", pa.array(vectors, pa.list_(pa.float64())))

    return records.mapInArrow(run, T.StructType([*records.schema.fields, T.StructField("embedding", T.ArrayType(T.DoubleType()))]))
