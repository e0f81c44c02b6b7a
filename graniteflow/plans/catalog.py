"""All queries of the core with their SQL twins, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graniteflow.plans import benchmark_plans, engine_plans, graph_plans, hierarchy_plans, lifecycle_plans, lookup_plans, record_plans, search_plans, source_plans, structure_plans, surface_plans, text_plans

Query = Callable[[SparkSession, str], DataFrame]
MODULES = [search_plans, hierarchy_plans, lifecycle_plans, graph_plans, benchmark_plans, text_plans, structure_plans, lookup_plans, record_plans, surface_plans, source_plans, engine_plans]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in MODULES:
        out |= m.queries()
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        out |= m.oracle_sql()
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["vector_topk_filtered"](spark, sf_dir)
