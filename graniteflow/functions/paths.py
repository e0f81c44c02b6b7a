"""Paths of the lake: where an object of a filing lies, and what a path says about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content types by file extension.
CONTENT_TYPES = {"pdf": "application/pdf", "html": "text/html", "htm": "text/html", "json": "application/json", "md": "text/markdown", "txt": "text/plain", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "zip": "application/zip"}


def period_folder(quarter: Column) -> Column:
    """Q1 to Q3, or FY for the fourth and for none."""
    return F.when(quarter.isin(1, 2, 3), F.concat(F.lit("Q"), quarter.cast("string"))).otherwise("FY")


def bronze(market: Column, code: Column, year: Column, quarter: Column, name: Column, offering: Column) -> Column:
    """Code first, then year and period; offerings lie in a folder of their own without a period."""
    return F.when(offering, F.concat_ws("/", F.lit("bronze"), market, code, F.lit("ipo"), name)).otherwise(F.concat_ws("/", F.lit("bronze"), market, code, year.cast("string"), period_folder(quarter), name))


def silver(market: Column, code: Column, year: Column, folder: Column, name: str) -> Column:
    """The place of a product of parsing."""
    return F.concat_ws("/", F.lit("silver"), market, code, year.cast("string"), folder, F.lit(name))


def sibling(path: Column, name: str) -> Column:
    """Another file of the same folder."""
    return F.regexp_replace(path, "[^/]+$", name)


def quarantined(path: Column, reason: Column) -> Column:
    return F.concat_ws("/", F.lit("quarantine"), reason, path)


def parsed(path: Column) -> dict[str, Column]:
    """market, code, year, quarter and file name out of a bronze path, nulls where it has another form."""
    part = F.split(path, "/")
    n = F.size(part)
    at = lambda i: F.get(part, F.lit(i))
    regular = (n >= 6) & (at(0) == "bronze")
    quarter = F.when(at(4) == "FY", 4).otherwise(F.regexp_extract(at(4), "^Q([1-4])$", 1).try_cast("int"))
    return {
        "market": F.when(at(0) == "bronze", at(1)), "code": F.when(at(0) == "bronze", at(2)), "year": F.when(regular, at(3).try_cast("int")),
        "quarter": F.when(regular, quarter), "file_name": F.element_at(part, -1),
    }


def content_type(path: Column) -> Column:
    """The type of an object by its extension; plain bytes where that is unknown."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.coalesce(*(F.when(ext == e, t) for e, t in CONTENT_TYPES.items()), F.lit("application/octet-stream"))


def gold(category: Column, market: Column, code: Column, name: Column) -> Column:
    """The place of a final product; parts that are null are left out."""
    return F.concat_ws("/", F.lit("gold"), category, market, code, name)


def application(kind: Column, folder: Column, name: Column) -> Column:
    """The place of what an application keeps; parts that are null are left out."""
    return F.concat_ws("/", F.lit("application"), kind, folder, name)


def silver_period(market: Column, doc_type: Column, code: Column, year: Column, quarter: Column, folder: Column, name: Column) -> Column:
    """The place of a product of parsing by type and period; folder and name may be null."""
    return F.concat_ws("/", F.lit("silver"), folder, market, doc_type, code, year.cast("string"), period_folder(quarter), name)


def artifacts(object_path: Column, markdown_path: Column) -> Column:
    """All places that a filing's products take: its file, the markdown, what lies beside that, and the folder of its images."""
    beside = F.transform(F.array(F.lit("structure.json"), F.lit("chunks.json"), F.lit("content_list.json"), F.lit("images/")), lambda n: F.regexp_replace(markdown_path, F.lit("[^/]+$"), n))
    some = F.nullif(markdown_path, F.lit(""))
    return F.array_distinct(F.array_compact(F.concat(F.array(F.nullif(object_path, F.lit(""))), F.when(some.isNotNull(), F.concat(F.array(some), beside)).otherwise(F.array().cast("array<string>")))))
