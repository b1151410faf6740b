"""From parsed blocks to blocks with sections, chunks with related assets, and the report: the whole of document processing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import work
from . import assets, blocks, chunks, report


@dataclass(frozen=True)
class Parsed:
    blocks: DataFrame
    chunks: DataFrame
    links: DataFrame
    report: DataFrame


def process(source: DataFrame, config: chunks.ChunkConfig = chunks.ChunkConfig(), parser_name: str = "stratadoc", source_name: Column | None = None) -> Parsed:
    """Blocks of a parser (a row each) through normalisation, sections, chunks and figure links to the report.

    Blocks and chunks, which all that follows reads, are written to the shared folder.
    """
    known = blocks.with_sections(blocks.normalized(source))
    for name, kind in {"bbox": "struct<x0:double,y0:double,x1:double,y1:double>", "asset_id": "string", "asset_uri": "string"}.items():
        if name not in known.columns:
            known = known.withColumn(name, F.lit(None).cast(kind))
    known = work.written(known, "blocks")
    built = work.written(chunks.built(known, config), "chunks")
    groups = chunks.grouped(known, config).select("document_id", "block_id", "group_no")
    placed = known.join(groups, ["document_id", "block_id"], "left")
    links = assets.linked(placed, assets.decorative(placed), config.max_asset_distance)
    return Parsed(known, assets.attached(built, links), links, report.report(known, built, chunks.rebuilt(built, known), links, parser_name, source_name))
