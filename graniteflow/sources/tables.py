"""Readers of the tables: Parquet folders, with only the columns asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``; columns are pruned here so that scans stay narrow."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
