"""The property graph of companies, filings and chunks as node and edge tables, and walks on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators import hierarchy
from graniteflow.operators.latest import current_chunks, id_key
from graniteflow.plans import hierarchy_plans
from graniteflow.sources.tables import table

SQL: dict[str, str] = {}
QUERIES = {}


def query(name, sql=None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def nodes(spark, sf):
    """(label, id) of all nodes; a company is named by its filings."""
    docs = table(spark, sf, "source_documents", "id", "stock_code")
    chunks = table(spark, sf, "document_chunks", id_key("id").alias("id")).where("id IS NOT NULL")
    part = lambda label, df: df.distinct().select(F.lit(label).alias("label"), "id")
    return part("Company", docs.select(F.col("stock_code").alias("id"))).union(part("Document", docs.select("id"))).union(part("Chunk", chunks))


def edges(spark, sf):
    """(type, src, dst): company to filing, parentless chunk to filing, chunk to child. Ends that do not exist give none."""
    docs = table(spark, sf, "source_documents", "id", "stock_code")
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "parent_chunk_id")
    chunks = current_chunks(raw, "document_id", id_key("parent_chunk_id").alias("parent")).select("key", "document_id", "parent")
    owns = docs.distinct().select(F.lit("HAS_DOCUMENT").alias("type"), F.col("stock_code").alias("src"), F.col("id").alias("dst"))
    roots = chunks.where("parent IS NULL").join(docs.select(F.col("id").alias("document_id")), "document_id", "left_semi")
    belongs = roots.select(F.lit("BELONGS_TO").alias("type"), F.col("key").alias("src"), F.col("document_id").alias("dst"))
    child = chunks.where("parent IS NOT NULL").join(chunks.select(F.col("key").alias("parent")), "parent", "left_semi")
    return owns.union(belongs).union(child.select(F.lit("HAS_CHILD").alias("type"), F.col("parent").alias("src"), F.col("key").alias("dst")))


CUR = """cur AS (SELECT lower(trim(id)) AS k, arg_max(document_id, ingested_at) AS document_id,
  nullif(arg_max(coalesce(lower(trim(parent_chunk_id)), ''), ingested_at), '') AS p, arg_max(coalesce(chunk_index, 999999), ingested_at) AS idx
  FROM document_chunks WHERE lower(trim(id)) <> '' GROUP BY 1)"""
EDGES = f"""{CUR}, edges AS (
  SELECT DISTINCT 'HAS_DOCUMENT' AS type, stock_code AS src, id AS dst FROM source_documents
  UNION ALL SELECT 'BELONGS_TO', k, document_id FROM cur WHERE p IS NULL AND document_id IN (SELECT id FROM source_documents)
  UNION ALL SELECT 'HAS_CHILD', p, k FROM cur WHERE p IN (SELECT k FROM cur))"""


@query("graph_edges", f"WITH {EDGES} SELECT * FROM edges")
def graph_edges(spark, sf):
    """All edges of the graph."""
    return edges(spark, sf)


@query("graph_stats", f"""
WITH {EDGES} SELECT 'node' AS kind, 'Company' AS name, count(DISTINCT stock_code) AS n FROM source_documents
UNION ALL SELECT 'node', 'Document', count(DISTINCT id) FROM source_documents UNION ALL SELECT 'node', 'Chunk', count(*) FROM cur
UNION ALL SELECT 'edge', type, count(*) FROM edges GROUP BY type""")
def graph_stats(spark, sf):
    """Numbers of nodes by label and of edges by type."""
    n = nodes(spark, sf).groupBy(F.lit("node").alias("kind"), F.col("label").alias("name")).agg(F.count("*").alias("n"))
    return n.union(edges(spark, sf).groupBy(F.lit("edge").alias("kind"), F.col("type").alias("name")).agg(F.count("*").alias("n")))


@query("graph_children", f"""
WITH {CUR} SELECT p AS parent, k AS child, CAST(row_number() OVER (PARTITION BY p ORDER BY idx, k) AS INTEGER) AS place FROM cur WHERE p IN (SELECT k FROM cur)""")
def graph_children(spark, sf):
    """The children of every chunk in order of their numbers, those without a number last."""
    from pyspark.sql import Window

    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "parent_chunk_id", "chunk_index")
    c = current_chunks(raw, id_key("parent_chunk_id").alias("parent"), F.coalesce("chunk_index", F.lit(999999)).alias("idx"))
    kept = c.where("parent IS NOT NULL").join(c.select(F.col("key").alias("parent")), "parent", "left_semi")
    w = Window.partitionBy("parent").orderBy("idx", "key")
    return kept.select("parent", F.col("key").alias("child"), F.row_number().over(w).alias("place"))


@query("graph_within_two_levels", f"SELECT * FROM ({hierarchy_plans.P3_DESCENDANTS_SQL}) WHERE levels <= 2")
def graph_within(spark, sf):
    """Descendants of every chunk down to two levels."""
    return hierarchy_plans.p3_descendants(spark, sf).where("levels <= 2")


@query("graph_siblings", f"""
WITH {CUR} SELECT k AS chunk, CAST(count(*) OVER (PARTITION BY p) - 1 AS BIGINT) AS siblings FROM cur WHERE p IN (SELECT k FROM cur)""")
def graph_siblings(spark, sf):
    """How many other chunks share the parent of each chunk; pre-aggregated by parent, so a large family moves as one row."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "parent_chunk_id")
    c = current_chunks(raw, id_key("parent_chunk_id").alias("parent"))
    kept = c.where("parent IS NOT NULL").join(c.select(F.col("key").alias("parent")), "parent", "left_semi")
    return kept.join(kept.groupBy("parent").agg((F.count("*") - 1).alias("siblings")), "parent").select(F.col("key").alias("chunk"), "siblings")


@query("part_tree", """
WITH RECURSIVE t AS (
  SELECT p_partkey AS id, p_partkey AS root, 0 AS depth FROM part WHERE p_partkey < 4
  UNION ALL SELECT c.p_partkey, t.root, t.depth + 1 FROM t JOIN part c ON c.p_partkey // 4 = t.id AND c.p_partkey >= 4)
SELECT CAST(id AS VARCHAR) AS id, CAST(root AS VARCHAR) AS root_id, CAST(depth AS INTEGER) AS node_depth FROM t""")
def part_tree(spark, sf):
    """Root and depth in a tree derived from part keys, which crosses partitions at every step."""
    p = table(spark, sf, "part", "p_partkey")
    key = F.col("p_partkey").cast("string")
    up = F.when(F.col("p_partkey") >= 4, F.floor(F.col("p_partkey") / 4).cast("string"))
    rows = p.select(key.alias("key"), key.alias("id"), up.alias("parent"), key.alias("label"), F.col("p_partkey").alias("place"))
    return hierarchy.trees(rows).select("id", "root_id", "node_depth")


def queries():
    return QUERIES


def oracle_sql():
    return SQL
