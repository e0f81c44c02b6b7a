"""Queries over the structure of whole markdown files. SQL cannot follow levels that depend on each other; tests do."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators import structure
from graniteflow.sources.tables import table


def files(spark, sf):
    """(doc, market, text): markdown files put together from their pages."""
    p = table(spark, sf, "markdown_pages", "markdown_path", "page_no", "first_line", "page_text").where("page_text IS NOT NULL").distinct()
    pages = F.sort_array(F.collect_list(F.struct("first_line", "page_no", "page_text")))
    joined = F.array_join(F.transform("pages", lambda x: x["page_text"]), "\n")
    return p.groupBy("markdown_path").agg(pages.alias("pages")).select(F.col("markdown_path").alias("doc"), F.split("markdown_path", "/")[1].alias("market"), joined.alias("text"))


def structure_headings(spark, sf):
    """Headings with their levels and parents."""
    return structure.heading_rows(files(spark, sf))


def structure_chunks(spark, sf):
    """Chunks of at most 500 characters along the headings."""
    return structure.chunk_rows(files(spark, sf))


def queries():
    return {"structure_headings": structure_headings, "structure_chunks": structure_chunks}


def oracle_sql():
    return {}
