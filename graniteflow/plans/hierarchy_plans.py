"""Queries over the parent links of chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.operators import hierarchy
from graniteflow.operators.latest import current_chunks, id_key
from graniteflow.sources.tables import table


def chunk_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, id, parent, label, place) of the current chunks."""
    chunks = table(spark, sf_dir, "document_chunks", "id", "document_id", "chunk_index", "parent_chunk_id", "ingested_at")
    return current_chunks(
        chunks,
        id_key("parent_chunk_id").alias("parent"),
        F.coalesce(F.col("chunk_index").cast("string"), F.lit("-")).alias("label"),
        hierarchy.placed(id_key("document_id"), F.col("chunk_index"), F.col("id")).alias("place"),
    )


def chunk_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for the nodes; the number of rows comes from the file footers."""
    return hierarchy.partitions_for(spark, table(spark, sf_dir, "document_chunks").count())


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root, depth and path of every chunk."""
    return hierarchy.trees(chunk_nodes(spark, sf_dir), chunk_partitions(spark, sf_dir))


def p3_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk below every chunk."""
    return hierarchy.descendants(chunk_nodes(spark, sf_dir), chunk_partitions(spark, sf_dir))


CUR = """
cur AS (
  SELECT lower(trim(id)) AS k, arg_max(id, ingested_at) AS id,
         nullif(arg_max(coalesce(lower(trim(parent_chunk_id)), ''), ingested_at), '') AS p,
         arg_max(coalesce(CAST(chunk_index AS VARCHAR), '-'), ingested_at) AS label
  FROM document_chunks WHERE lower(trim(id)) <> '' GROUP BY 1
), node AS (
  SELECT a.k, a.id, a.label, b.k AS p FROM cur a LEFT JOIN cur b ON a.p = b.k
)"""

P3_FOUND_SQL = f"""
WITH RECURSIVE {CUR}, up AS (
  SELECT k AS start, k AS at, label AS path, [k] AS seen, CAST(NULL AS VARCHAR) AS ring FROM node
  UNION ALL
  SELECT u.start, n.p, q.label || '/' || u.path, list_append(u.seen, n.p),
         CASE WHEN list_contains(u.seen, n.p) THEN n.p END
  FROM up u JOIN node n ON n.k = u.at JOIN node q ON q.k = n.p WHERE u.ring IS NULL
), ends AS (
  SELECT u.* FROM up u JOIN node n ON n.k = u.at WHERE u.ring IS NOT NULL OR n.p IS NULL
), low AS (
  SELECT e.start, min(n.id) AS id
  FROM (SELECT start, unnest(seen[list_position(seen, ring):]) AS k FROM ends WHERE ring IS NOT NULL) e JOIN node n ON n.k = e.k
  GROUP BY e.start
)
SELECT s.id, CASE WHEN e.ring IS NULL THEN r.id ELSE l.id END AS root_id,
       CAST(CASE WHEN e.ring IS NULL THEN len(e.seen) - 1 ELSE -1 END AS INTEGER) AS node_depth,
       CASE WHEN e.ring IS NULL THEN e.path ELSE '' END AS node_path
FROM ends e JOIN node s ON s.k = e.start JOIN node r ON r.k = e.at LEFT JOIN low l ON l.start = e.start
"""

P3_DESCENDANTS_SQL = f"""
WITH RECURSIVE {CUR}, up AS (
  SELECT k AS start, k AS at, [k] AS seen, FALSE AS ring FROM node
  UNION ALL
  SELECT u.start, n.p, list_append(u.seen, n.p), list_contains(u.seen, n.p)
  FROM up u JOIN node n ON n.k = u.at WHERE n.p IS NOT NULL AND NOT u.ring
), circle AS (SELECT DISTINCT start FROM up u WHERE u.ring AND u.at = u.start)
SELECT a.id, d.id AS descendant_id, CAST(len(u.seen) - 1 AS INTEGER) AS levels
FROM up u JOIN node a ON a.k = u.at JOIN node d ON d.k = u.start
WHERE len(u.seen) > 1 AND NOT u.ring AND u.start NOT IN (SELECT start FROM circle)
"""


def queries():
    return {"p3_found": p3_found, "p3_descendants": p3_descendants}


def oracle_sql():
    return {"p3_found": P3_FOUND_SQL, "p3_descendants": P3_DESCENDANTS_SQL}
