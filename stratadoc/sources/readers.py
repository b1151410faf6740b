"""Sources: JSON Lines, indexes, evaluation sets, and adapters of parsed pages to blocks.

Adapters are columns (Markdown, JSON nodes) or one Arrow pass (HTML); a registry holds parsers by name.
"""

from __future__ import annotations

import dataclasses
import enum
import html
import json
import re
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import headings as hd
from ..functions import text as tx
from ..operators import blocks as bl

BLOCK_FIELDS = "array<struct<label:string,level:int,text:string,markdown:string>>"
ENGINES = ("auto", "cpu", "cuda", "mps", "xpu")


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records of a JSON Lines file; blank lines are skipped by the reader.  Give a schema in production."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores where a source has fewer splits than there are cores (a small file of one row group).

    Large sources have more splits than that and are left as they are: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def is_hierarchical(records: DataFrame) -> bool:
    """Whether one of the first five records has a chunk_type."""
    return "chunk_type" in records.columns and bool([r for r in records.select("chunk_type").limit(5).collect() if r[0]])


def load_records(spark: SparkSession, path: str, build: Callable[[DataFrame], DataFrame], kind: str = "auto") -> DataFrame:
    """Retrieval records of a file: as they are, or built from stage-one chunks."""
    if kind not in ("auto", "rag_chunks", "parsed_sections"):
        raise ValueError(f"unsupported input type: {kind}")
    records = json_lines(spark, path)
    return records if kind == "rag_chunks" or kind == "auto" and is_hierarchical(records) else build(records)


def vector_index(spark: SparkSession, path: str) -> DataFrame:
    """Items of an index: a Parquet folder, or one JSON document with ``items``."""
    if not path.endswith(".json"):
        return spark.read.parquet(path)
    doc = spark.read.option("multiLine", True).schema("schema_version string, embedding_model string, source_path string, items array<struct<chunk_id:string,content:string,embedding:array<double>,metadata:string>>").json(path)
    return doc.select(F.coalesce("schema_version", F.lit("1.0")).alias("schema_version"), "embedding_model", "source_path", F.posexplode("items").alias("ord", "i")).select("schema_version", "embedding_model", "source_path", "ord", "i.chunk_id", F.coalesce("i.content", F.lit("")).alias("content"), "i.embedding", "i.metadata")


def evaluation_cases(spark: SparkSession, path: str) -> DataFrame:
    cases = "array<struct<id:string,question:string,expected:struct<source_chunk_ids:array<string>,chunk_ids:array<string>,section_paths:array<array<string>>,pages:array<int>>>>"
    doc = spark.read.option("multiLine", True).schema(f"schema_version string, name string, default_top_k int, cases {cases}").json(path)
    return doc.select("name", "default_top_k", F.explode("cases").alias("c")).select("name", "default_top_k", F.col("c.id").alias("case_id"), "c.question", F.col("c.expected.source_chunk_ids").alias("expected_source_ids"), F.col("c.expected.chunk_ids").alias("expected_chunk_ids"), F.col("c.expected.section_paths").alias("section_paths"), F.col("c.expected.pages").alias("pages"))


def default_input_path(spark: SparkSession, folder: str = ".") -> str:
    """rag_chunks.jsonl of a folder if it is there, else parsed_sections.jsonl."""
    path = f"{folder.rstrip('/')}/rag_chunks.jsonl"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else f"{folder.rstrip('/')}/parsed_sections.jsonl"


# ---- adapters

#: Fixed labels that carry content, and names of a box's sides.
CONTENT_LABELS = ("text", "list_item", "code", "formula", "caption", "footnote", "table", "picture", "image", "figure", "graphic", "section_header", "title")
SIDES = {"x0": ("l", "left", "x0"), "y0": ("t", "top", "y0"), "x1": ("r", "right", "x1"), "y1": ("b", "bottom", "y1")}


def bounding_box(box: Column, names: list[str]) -> Column:
    """x0, y0, x1, y1 and coord_origin of a struct whose sides have any of the usual names; null without a side."""
    side = lambda c: F.coalesce(*(box[n].cast("double") for n in SIDES[c] if n in names), F.lit(None).cast("double"))
    origin = box["coord_origin"].cast("string") if "coord_origin" in names else F.lit(None).cast("string")
    return F.when(F.coalesce(*(side(c) for c in SIDES)).isNotNull(), F.struct(*(side(c).alias(c) for c in SIDES), origin.alias("coord_origin")))


def native_blocks(items: DataFrame) -> DataFrame:
    """Blocks of a parser's items (document_id, ord, label, level, text, markdown, page_no, bbox): those of content labels in
    order, numbered anew.  Text falls back on Markdown; a visual item has none; others without text are dropped."""
    names = [f.name for f in items.schema["bbox"].dataType] if "bbox" in items.columns else []
    label = F.lower("label")
    text = F.coalesce(F.nullif(tx.plain(F.coalesce("text", F.lit(""))), F.lit("")), F.nullif(F.trim("markdown"), F.lit("")), F.lit(""))
    visual = label.isin(*hd.VISUAL_LABELS)
    out = items.where(label.isin(*CONTENT_LABELS)).withColumns({"label": label, "text": F.when(visual, "").otherwise(text), "markdown": F.when(label == "table", F.trim("markdown")), "bbox": bounding_box(F.col("bbox"), names) if names else F.lit(None).cast("struct<x0:double,y0:double,x1:double,y1:double,coord_origin:string>")})
    out = out.where(F.col("label").isin(*hd.VISUAL_LABELS) | (F.col("text") != ""))
    return out.withColumn("sequence_no", F.row_number().over(Window.partitionBy("document_id").orderBy("ord"))).select("document_id", "sequence_no", "label", "level", "text", "markdown", "page_no", "bbox")


def first_export(source: object, methods: list[str]) -> tuple[object, str | None, list[str]]:
    """The value of the first method of a parser's result that gives one, the method's name, and what went wrong before."""
    warnings = []
    for name in methods:
        method = getattr(source, name, None)
        if not callable(method):
            continue
        try:
            return method(), name, warnings
        except Exception as e:  # a foreign parser may raise anything; the next method is tried
            warnings.append(f"{name} failed: {e}")
    return None, None, warnings


def plain_value(value: object) -> object:
    """A value as JSON holds it: paths and other objects as text, sets and tuples as lists, keys as text."""
    if value is None or isinstance(value, str | int | float | bool):
        return value.value if isinstance(value, enum.Enum) else value
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return plain_value(dataclasses.asdict(value))
    if isinstance(value, dict):
        return {str(k): plain_value(v) for k, v in value.items()}
    if isinstance(value, list | tuple | set):
        return [plain_value(v) for v in value]
    return str(value.value if isinstance(value, enum.Enum) else value)

def markdown_blocks(markdown: Column) -> Column:
    """Blocks of Markdown: parts between blank lines; # makes a heading, an inline image a figure without text."""
    parts = F.filter(F.transform(F.split(markdown, "\n\n"), lambda p: F.trim(p)), lambda p: p != "")

    def block(p):
        figure, heading = p.rlike(tx.DATA_IMAGE), p.startswith("#")
        text = F.when(figure, "").when(heading, F.trim(F.regexp_replace(p, "^#+", ""))).otherwise(p)
        return F.struct(F.when(figure, "figure").when(heading, "section_header").otherwise("text").alias("label"), F.when(heading, F.length(F.regexp_extract(p, "^(#+)", 1))).alias("level"), text.alias("text"), p.alias("markdown"))

    return F.transform(parts, block)


class _Tree(HTMLParser):
    """Blocks of a page in reading order: headings, paragraphs, list items, table cells by row, captions, images."""

    KINDS = {**{f"h{i}": "section_header" for i in range(1, 7)}, "p": "text", "li": "list_item", "tr": "table", "figcaption": "caption", "caption": "caption", "blockquote": "text", "pre": "text", "title": "title"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.parts, self.off = [], None, [], 0

    def close_block(self):
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        if self.now and text:
            self.out.append({"label": self.KINDS[self.now], "level": int(self.now[1]) if re.fullmatch("h[1-6]", self.now) else None, "text": text, "markdown": text})
        self.now, self.parts = None, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript"):
            self.off += 1
        elif tag == "img":
            alt = dict(attrs).get("alt") or ""
            self.out.append({"label": "picture", "level": None, "text": "", "markdown": f"![{alt}]({dict(attrs).get('src') or ''})"})
        elif tag in self.KINDS:
            self.close_block()
            self.now = tag
        elif tag in ("td", "th") and self.parts:
            self.parts.append(" | ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript"):
            self.off = max(0, self.off - 1)
        elif tag == self.now:
            self.close_block()

    def handle_data(self, data):
        if self.now and not self.off:
            self.parts.append(data)


def page_blocks(source: str) -> list[dict]:
    tree = _Tree()
    tree.feed(source or "")
    tree.close()
    tree.close_block()
    return tree.out


def html_blocks(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """(document_id, sequence_no, label, level, text, markdown) of pages; one Arrow pass, then posexplode."""
    item = pa.list_(pa.struct([("label", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("markdown", pa.string())]))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("document_id"), pa.array([page_blocks(h) for h in batch.column("html").to_pylist()], item)], ["document_id", "blocks"])

    parsed = pages.select(F.col(key).cast("string").alias("document_id"), F.col(source).alias("html")).mapInArrow(run, f"document_id string, blocks {BLOCK_FIELDS}")
    return exploded(parsed)


def exploded(parsed: DataFrame) -> DataFrame:
    return parsed.select("document_id", F.posexplode("blocks").alias("i", "b")).select("document_id", (F.col("i") + 1).alias("sequence_no"), "b.label", "b.level", "b.text", "b.markdown")


def _nodes(value, out):
    """Every node with text, depth first, in order."""
    if isinstance(value, dict):
        text = next((value[k] for k in ("text", "content") if isinstance(value.get(k), str) and value[k].strip()), None)
        if text:
            page = next((value[k] for k in ("page_no", "page_number", "page") if isinstance(value.get(k), int)), None)
            prov = value.get("prov")
            if page is None and isinstance(prov, list) and prov and isinstance(prov[0], dict):
                page = prov[0].get("page_no")
            label = value.get("label")
            label = label.get("value") or label.get("name") if isinstance(label, dict) else label
            out.append({"label": str(label or "text"), "page_no": page if isinstance(page, int) else None, "text": text.strip()})
    for child in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        _nodes(child, out)


def json_nodes(exports: DataFrame) -> DataFrame:
    """(document_id, sequence_no, label, page_no, text) of JSON exports (document_id, json): every node with text, the
    first of equal (page, label, text); a document that is no JSON has none."""
    item = pa.list_(pa.struct([("label", pa.string()), ("page_no", pa.int32()), ("text", pa.string())]))

    def run(batches):
        for batch in batches:
            every = []
            for source in batch.column("json").to_pylist():
                found: list = []
                try:
                    _nodes(json.loads(source or "null"), found)
                except ValueError:
                    found = []
                every.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("document_id"), pa.array(every, item)], ["document_id", "nodes"])

    nodes = exports.select("document_id", "json").mapInArrow(run, "document_id string, nodes array<struct<label:string,page_no:int,text:string>>")
    flat = nodes.select("document_id", F.posexplode("nodes").alias("i", "n")).select("document_id", "i", "n.*")
    first = flat.groupBy("document_id", "page_no", "label", "text").agg(F.min("i").alias("i"))
    return first.withColumn("sequence_no", F.row_number().over(Window.partitionBy("document_id").orderBy("i"))).select("document_id", "sequence_no", "label", "page_no", "text")


def first_of(*strategies: tuple[str, Column]) -> tuple[Column, Column]:
    """The blocks of the first strategy that has any, and its name ("none" if none has)."""
    blocks, name = F.array().cast(BLOCK_FIELDS), F.lit("none")
    for label, column in reversed(strategies):
        some = F.coalesce(F.size(column) > 0, F.lit(False))
        blocks, name = F.when(some, column).otherwise(blocks), F.when(some, label).otherwise(name)
    return blocks, name


def data_uri_bytes(uri: Column) -> Column:
    """The bytes of a base64 data URI; null for anything else."""
    body = F.regexp_extract(uri, r"^data:[^;,]*;base64,(.*)$", 1)
    return F.when(body != "", F.unbase64(body))


#: Fixed extensions of image types.
EXTENSIONS = {"image/jpeg": ".jpg", "image/jpg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif"}


def stored_figures(figures: DataFrame, prefix: str = "images") -> DataFrame:
    """Figures (document_id, sequence_no, page_no, uri) with a data URI as assets: asset_id, asset_uri and the image's bytes,
    numbered in each document in reading order.  The bytes stay a column, to be written as any table is."""
    mime = F.lower(F.regexp_extract("uri", r"^data:([^;,]*)", 1))
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("sequence_no"))
    extension = F.coalesce(F.create_map(*(F.lit(x) for pair in EXTENSIONS.items() for x in pair))[mime], F.lit(".png"))
    held = figures.withColumn("content", data_uri_bytes(F.col("uri"))).where("content IS NOT NULL").withColumn("n", number)
    name = F.concat(F.format_string("page_%03d_figure_%03d", F.coalesce("page_no", F.lit(0)), F.col("n")), extension)
    place = F.concat(F.lit(prefix.strip("/") + "/"), name) if prefix.strip("/") else name
    return held.select("document_id", "sequence_no", "page_no", F.format_string("fig_%03d", "n").alias("asset_id"), place.alias("asset_uri"), F.lit("image").alias("asset_type"), mime.alias("mime_type"), "content")


def unescaped(text: str) -> str:
    return html.unescape(text)


class Registry:
    """Parsers by name: functions of a DataFrame of sources to a DataFrame of blocks."""

    def __init__(self):
        self._parsers: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str, parser: Callable[[DataFrame], DataFrame]) -> None:
        if not name or not name.strip():
            raise ValueError("a parser needs a name")
        self._parsers[name.strip()] = parser

    def get(self, name: str) -> Callable[[DataFrame], DataFrame]:
        if name not in self._parsers:
            raise KeyError(f"unknown parser {name!r}; available: {', '.join(self.list()) or 'none'}")
        return self._parsers[name]

    def list(self) -> list[str]:
        return sorted(self._parsers)


def engine(name: str | None) -> str:
    chosen = (name or "auto").strip().lower()
    if chosen not in ENGINES:
        raise ValueError(f"engine must be one of {', '.join(ENGINES)}")
    return chosen


def default_registry() -> Registry:
    out = Registry()
    out.register("html", lambda df: bl.complete(html_blocks(df)))
    out.register("json", json_nodes)
    out.register("markdown", lambda df: exploded(df.select("document_id", markdown_blocks(F.col("markdown")).alias("blocks"))))
    return out
