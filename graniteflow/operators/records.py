"""Record tables: look-ups of many keys at once, inserts, changes of rows, and rows that are set aside.

Every operator is one plan over whole sets of keys. Null keys find nothing and change nothing; of equal keys of a table
of changes the last one in order counts; empty inputs give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.functions.text import strip
from graniteflow.operators.latest import newest_per_key


def lookup(df: DataFrame, asked: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose ``column`` is among the asked keys."""
    return df.join(asked.select(F.col(key).alias(column)), column, "left_semi")


def first_filled(*values: Column) -> Column:
    """The first value that is not blank, without blanks at its ends."""
    return F.coalesce(*(F.nullif(strip(v), F.lit("")) for v in values))


def inserted(old: DataFrame, new: DataFrame, key: str, *order: Column) -> DataFrame:
    """The rows of ``new`` that a table gains: keys it lacks, the first in order of equal ones."""
    fresh = new.where(F.col(key).isNotNull()).join(old.select(key), key, "left_anti")
    return newest_per_key(fresh, [key], *order)


def changed(changes: DataFrame, key: str, order: list[Column], status: str, error: str, started: list[str], ended: list[str], at: str) -> DataFrame:
    """One row a key out of its changes (status, error, time): what a record is after all of them.

    The status is the last one given; each error counts as a retry; the error is that of the last change, so success
    clears it; the start is the first time of a status of ``started``, the end the last of ``ended``.
    """
    last = F.struct(*order)
    when = lambda names: F.when(F.col(status).isin(names), F.col(at))
    return changes.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(status, F.when(F.col(status).isNotNull(), last)).alias("status"),
        F.count_if(F.col(error).isNotNull()).alias("retries"),
        F.max_by(error, last).alias("error"),
        F.min(when(started)).alias("started_at"),
        F.max(when(ended)).alias("ended_at"),
    )


def cleared(df: DataFrame, keep: list[str], blank: list[str] = ()) -> DataFrame:
    """Rows with all columns null but those kept; those of ``blank`` are empty texts."""
    empty = lambda c: F.lit("") if c in blank else F.lit(None).cast(df.schema[c].dataType)
    return df.select(*(F.col(c) if c in keep else empty(c).alias(c) for c in df.columns))


def judged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with ``reason``: the name of the first rule that a row breaks, null where it breaks none; a null test is broken."""
    return df.withColumn("reason", F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))


def set_aside(rows: DataFrame, key: str, path: str, stage: Column, known: tuple[str, ...], other: str) -> DataFrame:
    """Quarantine records of judged rows with a reason: one a key, pending, under a path of their own; an unknown stage counts as ``other``."""
    bad = rows.where("reason IS NOT NULL")
    named = F.when(stage.isin(*known), stage).otherwise(F.lit(other))
    place = F.concat_ws("/", F.lit("quarantine"), "reason", path)
    copied = F.coalesce(F.nullif(F.col(path), F.lit("")).isNotNull(), F.lit(False))
    return newest_per_key(bad, [key], F.col("reason"), F.col(path)).select(
        F.md5(F.concat_ws("|", F.lit("quarantine"), key)).alias("record_id"), key, named.alias("stage"), "reason", path, F.when(copied, place).alias("quarantine_path"), copied.alias("copied"), F.lit("pending").alias("status"),
    )


# What becomes of a record and of its document by the action that resolves it.
ACTIONS = {"restore": ("resolved", "crawled"), "re_crawl": ("resolved", None), "discard": ("discarded", "discarded")}


def resolved(records: DataFrame, decisions: DataFrame, key: str = "record_id") -> DataFrame:
    """Records with ``decisions`` (record_id, action): status, what to do with the object, and the document's new status.

    Only pending records change; an unknown action changes nothing; ``document_status`` is null where the document's row goes
    or where it stays as it is, which ``removed`` tells.
    """
    met = records.join(decisions.select(key, "action"), key, "left")
    takes = (F.col("status") == "pending") & F.col("action").isin(*ACTIONS)
    of = lambda i: F.coalesce(*(F.when(takes & (F.col("action") == a), F.lit(v[i])) for a, v in ACTIONS.items()))
    out = met.withColumn("document_status", of(1)).withColumn("removed", F.coalesce(takes & (F.col("action") == "re_crawl"), F.lit(False)))
    source = F.when(F.coalesce(takes, F.lit(False)) & (F.col("action") == "restore"), F.col("quarantine_path"))
    return out.withColumn("copy_back", source).withColumn("status", F.coalesce(of(0), "status")).drop("action")


def numbered(df: DataFrame, key: str, order: list[Column], start: int = 0) -> DataFrame:
    """Rows with ``place``, counted from ``start`` within their key."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1 + start)


def kept_and_linked(chunks: DataFrame, document: str, place: str, parent: str, text: str) -> DataFrame:
    """Chunks without the blank ones, numbered anew from 0; a parent is the new number of its row, null where that is gone.

    ``place`` and ``parent`` are the old numbers within a document.
    """
    fit = numbered(chunks.where(strip(F.col(text)) != ""), document, [F.col(place)]).withColumnRenamed("place", "__new") if place == "place" else chunks.where(strip(F.col(text)) != "").withColumn("__new", F.row_number().over(Window.partitionBy(document).orderBy(place)) - 1)
    above = fit.select(document, F.col(place).alias(parent), F.col("__new").alias("__up"))
    met = fit.join(above, [document, parent], "left")
    return met.select(*(F.col("__new").alias(place) if c == place else F.col("__up").alias(parent) if c == parent else F.col(c) for c in chunks.columns))
