"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def id_key(column: Column | str) -> Column:
    """The form in which ids are compared: no letter case, no surrounding blanks, blank means none."""
    c = F.col(column) if isinstance(column, str) else column
    bare = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(bare != "", bare)


def newest_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``; the group limit runs before the shuffle as well as after it.

    Null keys form one group. An empty input gives an empty result.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def current_chunks(chunks: DataFrame, *columns: Column | str) -> DataFrame:
    """Current rows of document_chunks: the greatest ingested_at of every id.

    The result has ``key`` (the id as it is compared), ``id`` and the columns asked for. Expressions are
    evaluated before the shuffle, so a caller that reduces a text to what it needs moves only that.
    Rows without an id are left out. Null ingested_at counts as oldest; ties are settled by the values.
    """
    narrow = chunks.select(id_key("id").alias("key"), "id", "ingested_at", *columns).where("key IS NOT NULL")
    rest = [c for c in narrow.columns if c not in ("key", "ingested_at")]
    tie = F.xxhash64(*rest)
    return newest_per_key(narrow, ["key"], F.col("ingested_at").desc_nulls_last(), tie).drop("ingested_at")
