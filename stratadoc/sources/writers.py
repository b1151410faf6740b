"""Sinks: JSON Lines, Markdown, Parquet indexes, formatted results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", False).mode("overwrite").json(path)


def markdown(blocks: DataFrame, path: str) -> None:
    """Each block after a comment with its page, id and section; files in reading order by range partitions."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    note = F.concat(F.lit("<!-- page_no="), text("page_no"), F.lit(" block_id="), text("block_id"), F.lit(" section_path="), F.array_join("section_path", " > "), F.lit(" -->"))
    blocks.repartitionByRange("document_id", "sequence_no").sortWithinPartitions("document_id", "sequence_no").select(F.concat(note, F.lit("\n"), "text", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def index(items: DataFrame, path: str) -> None:
    """Items with ``ord``, the order of insertion, by which ties are settled."""
    if "ord" not in items.columns:
        items = items.withColumn("ord", F.monotonically_increasing_id())
    items.write.mode("overwrite").parquet(path)


def legacy(chunks: DataFrame) -> DataFrame:
    """Stage-one chunks with the fields of older consumers."""
    one = F.when(F.size("content_types") == 1, F.col("content_types")[0]).otherwise("mixed")
    return chunks.withColumns({"page_content": F.col("text"), "content_type": one, "page_no": F.col("page_start")})


def preview(text: Column, most: int = 700) -> Column:
    """Squeezed text up to the last whole word within ``most`` characters, with an ellipsis if any is missing."""
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    cut = F.regexp_replace(F.substring(flat, 1, most - 3), r"\s+\S*$", "")
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(cut, F.lit("...")))


def formatted(results: DataFrame) -> DataFrame:
    """(query_id, rank, line): score, pages, section and preview of every result."""
    pages = F.when(F.col("page_start") == F.col("page_end"), F.col("page_start").cast("string")).otherwise(F.concat_ws("-", "page_start", "page_end"))
    line = F.format_string("%d. score=%.4f pages=%s section=%s\n%s", F.col("rank"), F.col("score"), pages, F.array_join("section_path", " > "), preview(F.col("content")))
    return results.select("query_id", "rank", line.alias("line"))
