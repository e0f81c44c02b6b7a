"""Scans over lifecycle tables, folds of events into rows, deduplication, and set differences by key.

All of them are single DataFrame plans: filters reach the scan, joins are equi-joins or semi/anti joins, and every
limit has a total order so that results do not depend on how rows are spread. Null keys never match in joins; empty
inputs give empty results; repeated rows are kept unless the operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.operators.latest import newest_per_key


def first_n(df: DataFrame, n: int, *order: Column, offset: int = 0) -> DataFrame:
    """The first ``n`` rows in a total order after ``offset``; n = 0 means all. No global sort is needed for n > 0."""
    ordered = df.orderBy(*order)
    ordered = ordered.offset(offset) if offset else ordered
    return ordered.limit(n) if n else ordered


def limit_then_filter(df: DataFrame, before: Column, n: int, order: Sequence[Column], after: Column) -> DataFrame:
    """Rows of the first ``n`` that satisfy ``before``, filtered by ``after``: the limit counts rows that fall out later."""
    return first_n(df.where(before), n, *order).where(after)


def having(df: DataFrame, present: DataFrame, absent: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``present`` and not in ``absent``."""
    return df.join(present.select(key), key, "left_semi").join(absent.select(key), key, "left_anti")


def missing_tasks(subjects: DataFrame, slots: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Every subject with every slot, without what is done. ``slots`` are few literal rows, so the product is an expand."""
    return subjects.crossJoin(F.broadcast(slots)).join(done.select(*keys).distinct(), keys, "left_anti")


def fold(events: DataFrame, keys: list[str], order: Sequence[Column], fields: list[str]) -> DataFrame:
    """One row per key in which every field has its last non-null value: an upsert that never overwrites with null."""
    at = F.struct(*order)
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields]
    return events.groupBy(*keys).agg(*last)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Old rows updated by new ones of the same key, field by field where the new value is not null, and new keys added."""
    n = new.select(*keys, *(F.col(f).alias(f"new_{f}") for f in fields))
    return old.join(n, keys, "full").select(*keys, *(F.coalesce(f"new_{f}", f).alias(f) for f in fields))


def unique_by(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of every non-null key; rows without a key stay, as they cannot be compared."""
    keyed = df.withColumn("__key", key)
    kept = newest_per_key(keyed.where("__key IS NOT NULL"), ["__key"], *order)
    return kept.unionByName(keyed.where("__key IS NULL")).drop("__key")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphans(df: DataFrame, keys: DataFrame, column: str, other: str) -> DataFrame:
    """Rows whose key is not among the keys."""
    return df.join(keys.select(F.col(other).alias(column)), column, "left_anti")


def without(tables: dict[str, DataFrame], doomed: DataFrame, column: str) -> dict[str, DataFrame]:
    """Every table without the rows that belong to the doomed keys: a cascading delete as a rewrite."""
    return {name: df.join(doomed.select(column), column, "left_anti") for name, df in tables.items()}


def targets(companies: DataFrame, codes: DataFrame | None, n: int) -> DataFrame:
    """Companies (code, ...) that a job takes: the first ``n`` by code where no list of codes is given, else all on the list (none of an empty one)."""
    return first_n(companies, n, F.col("code")) if codes is None else companies.join(codes.select("code"), "code", "left_semi")
