"""The catalogue: tables that exist, their sizes and statistics, schemas that rows have to fit, and uniqueness audits."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemas of tables that the engine writes and that no input brings along.
SCHEMAS = {
    "quarantine_records": "record_id string, document_id string, stage string, reason string, original_path string, quarantine_path string, copied boolean, status string",
    "validation_logs": "log_id string, document_id string, stage string, rule string, level string, passed boolean, message string, at timestamp",
    "images": "image_id string, parsed_document_id string, document_id string, image_index int, filename string, file_hash string",
    "image_annotations": "annotation_id string, image_id string, version int, status string, annotator string, confidence double",
    "vectors": "chunk_id string, document_id string, stock_code string, company_name string, doc_type string, year int, quarter int, embedding array<float>",
}


def run_sql(spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **views: DataFrame) -> DataFrame:
    """A statement with named parameters over views, which go by their names for this statement only."""
    return spark.sql(sql, args=args or {}, **views) if views else spark.sql(sql, args=args or {})


def create_tables(spark: SparkSession, folder: str, schemas: dict[str, str] = SCHEMAS) -> list[str]:
    """Empty tables at places below a folder where there are none yet; the names of those made."""
    made = []
    for name, schema in schemas.items():
        if find(spark, folder, name) is None:
            spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
            made.append(name)
    return made


def find(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """The table of a name below a folder, None where there is none."""
    try:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    except (AnalysisException, Py4JJavaError):
        return None


def inventory(spark: SparkSession, folder: str, names: Iterable[str]) -> DataFrame:
    """(table_name, present, n): whether each table exists and its number of rows, 0 for a missing one. Counts come from the file footers."""
    parts = []
    for name in names:
        df = find(spark, folder, name)
        label = F.lit(name).alias("table_name")
        parts.append(spark.range(1).select(label, F.lit(False).alias("present"), F.lit(0).cast("bigint").alias("n")) if df is None else df.agg(F.count("*").alias("n")).select(label, F.lit(True).alias("present"), "n"))
    return reduce(DataFrame.union, parts)


def statistics(df: DataFrame, *columns: str) -> DataFrame:
    """(column_name, filled, distinct_values): what an optimiser would keep about columns, exact, in two passes of hashes."""
    one = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.xxhash64(F.col(c).cast("string")).alias("h"), F.col(c).isNotNull().alias("filled")) for c in columns))).alias("x")).select("x.*")
    per = one.groupBy("column_name", "filled", "h").agg(F.count("*").alias("n"))
    return per.groupBy("column_name").agg(F.sum(F.when(F.col("filled"), F.col("n")).otherwise(0)).alias("filled"), F.count_if("filled").alias("distinct_values"))


def fits(vector: Column, dimension: int) -> Column:
    """What keeps a vector out of a collection of a dimension: "missing", "dimension", "value", or null if nothing does."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNull() | (F.size(vector) == 0), "missing").when(F.size(vector) != dimension, "dimension").when(bad, "value")


def key_violations(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, duplicate_keys, null_keys): how each table breaks the uniqueness of its key."""
    parts = []
    for name, (df, key) in tables.items():
        per = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
        parts.append(per.agg(F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys")).select(F.lit(name).alias("table_name"), "duplicate_keys", "null_keys"))
    return reduce(DataFrame.union, parts)
