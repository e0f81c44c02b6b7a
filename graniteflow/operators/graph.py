"""Walks over chunks and filings, and nodes that edges need.

Chunks are rows (key, document_id, parent, chunk_index), documents (document_id, stock_code, ...). Sets of keys are asked for
at once; single requests go through ``walk``. Results have a total order, so limits are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.session import cut


def of_documents(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """The chunks at the top of the given filings."""
    return chunks.where("parent IS NULL").join(documents.select("document_id"), "document_id", "left_semi")


def siblings(chunks: DataFrame, asked: DataFrame) -> DataFrame:
    """(chunk, sibling): the other chunks under the same parent in the same filing; the asked keys move, then their parents' children."""
    own = chunks.join(asked.select("key"), "key", "left_semi").where("parent IS NOT NULL").select(F.col("key").alias("chunk"), "parent", "document_id")
    other = chunks.where("parent IS NOT NULL").select("parent", "document_id", F.col("key").alias("sibling"))
    return own.join(other, ["parent", "document_id"]).where("chunk <> sibling").select("chunk", "sibling")


def below(chunks: DataFrame, asked: DataFrame, depth: int) -> DataFrame:
    """(top, key, depth, chunk_index): what lies up to ``depth`` levels below the asked keys, each once, at its least depth.

    One join a level on the frontier of that level; keys met before are left out, so rings end.
    """
    children = chunks.where("parent IS NOT NULL").select(F.col("parent"), "key", "chunk_index")
    front = cut(asked.select(F.col("key").alias("top"), "key").distinct().withColumns({"depth": F.lit(0), "chunk_index": F.lit(None).cast("int")}))
    found = front
    for level in range(1, depth + 1):
        step = front.select("top", F.col("key").alias("parent")).join(children, "parent").select("top", "key", F.lit(level).alias("depth"), "chunk_index").dropDuplicates(["top", "key"])
        front = cut(step.join(found.select("top", "key"), ["top", "key"], "left_anti"))
        if front.isEmpty():
            break
        found = cut(found.union(front))
    return found.where("depth > 0")


def walk(chunks: DataFrame, documents: DataFrame, kind: str, asked: str, depth: int | None, k: int) -> DataFrame:
    """(key, depth) of at most k chunks: those of a filing or company (``document``), beside a chunk (``chunk``), below one down
    to ``depth`` levels, 3 if none is given (``hierarchy``), or all below one (``children``). Another kind is an error."""
    spark = chunks.sparkSession
    one = spark.createDataFrame([(asked,)], "key string")
    last = F.coalesce("chunk_index", F.lit(999999))
    if kind == "document":
        rows = of_documents(chunks, documents.where((F.col("document_id") == asked) | (F.col("stock_code") == asked)))
        return rows.orderBy("document_id", last, "key").limit(k).select("key", F.lit(0).alias("depth"))
    if kind == "chunk":
        own = chunks.where(F.col("key") == asked).select("key", "chunk_index")
        beside = siblings(chunks, one).join(chunks, F.col("sibling") == F.col("key")).select("key", "chunk_index")
        rows = own.withColumn("first", F.lit(0)).union(beside.withColumn("first", F.lit(1)))
        return rows.orderBy("first", last, "key").limit(k).select("key", F.lit(0).alias("depth"))
    if kind in ("hierarchy", "children"):
        levels = depth or (3 if kind == "hierarchy" else 1 << 30)
        return below(chunks, one, levels).orderBy("depth", last, "key").limit(k).select("key", "depth")
    raise ValueError(f"no walk {kind}")


def stubs(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """(type, label, id): ends of edges (type, label, id) that are no nodes (label, id) yet."""
    return ends.distinct().join(nodes.select("label", "id"), ["label", "id"], "left_anti").select("type", "label", "id")


def without_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges (src, dst) after nodes are removed with all edges that touch them."""
    ids = gone.select("id").distinct()
    kept = edges.join(ids.select(F.col("id").alias("src")), "src", "left_anti").join(ids.select(F.col("id").alias("dst")), "dst", "left_anti")
    return nodes.join(ids, "id", "left_anti"), kept
