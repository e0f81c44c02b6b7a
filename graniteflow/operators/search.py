"""Ranked retrieval: exact vector search, BM25, fusion of ranked lists, context packing.

Single queries are broadcast; query sets that grow with the data meet it in blocks. Ties always go to the smaller id. Null or
mismatched vectors and null texts are never hits. Filters run below the ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.session import cut

K1, B, RRF = 1.2, 0.75, 60


def l2(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays in double precision."""
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def distance_score(distance: Column) -> Column:
    """A score in [0, 1] that falls with the distance."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 / (1 + distance)))


def nearest(vectors: DataFrame, query: DataFrame, key: str, k: int, where: Column | None = None) -> DataFrame:
    """(query, key, distance, rank) of the k nearest vectors of each query (query, q): a scan of the vectors per query block."""
    rows = vectors.where(where) if where is not None else vectors
    met = rows.crossJoin(F.broadcast(query)).where(F.size("embedding") == F.size("q"))
    ranked = met.select("query", key, F.round(l2(F.col("embedding"), F.col("q")), 6).alias("distance"))
    w = Window.partitionBy("query").orderBy("distance", key)
    return ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def whole(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the vectors of a list column that have ``width`` values and no null, out of its flat buffer."""
    rows = column.combine_chunks()
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(rows), -1).to_numpy(zero_copy_only=False) == width)
    flat = rows.take(pa.array(at)).flatten()
    good = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width).all(axis=1) if width else np.zeros(len(at), bool)
    values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(float).reshape(-1, width or 1)
    return at[good], values[good]


def nearest_in_blocks(vectors: DataFrame, queries: DataFrame, key: str, k: int, vector_block: int = 50_000, query_block: int = 2_048) -> DataFrame:
    """(query, key, distance, rank) as ``nearest``, for query sets that grow with the data: nothing is broadcast.

    Blocks of vectors meet blocks of queries, one task for each two; a task returns its k best for each query, and the
    best of these are the best of all. Vectors of other lengths than the first of a block, and those with nulls, are
    never hits.
    """
    n, m = vectors.count(), queries.count()
    rows, asks = max(1, -(-n // vector_block)), max(1, -(-m // query_block))
    piece = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = vectors.where("embedding IS NOT NULL").select(F.col(key).alias("id"), "embedding", piece(key, rows).alias("a")).withColumn("b", every(asks))
    right = queries.where("q IS NOT NULL").select("query", "q", piece("query", asks).alias("d")).withColumn("c", every(rows))

    def best(v: pa.Table, q: pa.Table) -> pa.Table:
        names = ["query", "id", "distance"]
        if not v.num_rows or not q.num_rows:
            return pa.Table.from_arrays([q["query"].slice(0, 0), v["id"].slice(0, 0), pa.array([], pa.float64())], names)
        width = len(q["q"][0])
        ask, asked = whole(q["q"], width)
        keep, x = whole(v["embedding"], width)
        out_q, out_v, out_d = [], [], []
        for i, own in zip(ask.tolist(), asked) if len(keep) else []:
            gap = x - own
            d = np.round(np.sqrt(np.einsum("ij,ij->i", gap, gap)), 6)
            # all that tie with the k-th stay, so that ties are settled by id at the end
            near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])
            out_q += [i] * len(near)
            out_v += keep[near].tolist()
            out_d.append(d[near])
        flat = np.concatenate([np.zeros(0), *out_d])
        return pa.Table.from_arrays([q["query"].take(pa.array(out_q, pa.int64())), v["id"].take(pa.array(out_v, pa.int64())), pa.array(flat)], names)

    kinds = f"query {queries.schema['query'].dataType.simpleString()}, id {vectors.schema[key].dataType.simpleString()}, distance double"
    found = left.groupBy("a", "b").cogroup(right.groupBy("c", "d")).applyInArrow(best, kinds)
    w = Window.partitionBy("query").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumnRenamed("id", key)


def spaced(text: Column) -> Column:
    """Lower-case words of letters a-z and digits, each between two spaces of its own; the rest of the text is dropped."""
    bare = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "  "))
    return F.when(bare == "", "").otherwise(F.concat(F.lit(" "), bare, F.lit(" ")))


def occurrences(spaced_text: str, term: str) -> Column:
    """How often a word is in a spaced text."""
    without = F.replace(spaced_text, F.lit(f" {term} "), F.lit(""))
    return ((F.length(spaced_text) - F.length(without)) / (len(term) + 2)).cast("int")


def word_counts(spaced_text: str, terms: list[str]) -> Column:
    """(len, tf): the words of a spaced text and how often each term is among them; null for a null text."""
    total = (F.length(spaced_text) - F.length(F.replace(spaced_text, F.lit(" "), F.lit("")))) / 2  # two spaces a word
    counts = F.struct(total.cast("int").alias("len"), F.array(*(occurrences(spaced_text, t) for t in terms)).alias("tf"))
    return F.when(F.col(spaced_text).isNotNull(), counts)


def bm25(docs: DataFrame, key: str, text: str | dict[str, float], terms: list[str], k: int, least: float = 0.3) -> DataFrame:
    """(key, score, rank) of the best texts. One pass over the texts counts words, and only the counts are kept.

    ``text`` is a column or several with their weights; the best weighted score of a column counts, and each has its own
    statistics. A text needs ``least`` of the terms in one column, at least one, to be a hit.
    """
    fields = {text: 1.0} if isinstance(text, str) else text
    base = docs.select(key, *(spaced(F.col(f)).alias(f) for f in fields))
    return bm25_counted(base.select(key, *(word_counts(f, terms).alias(f) for f in fields)), key, fields, len(terms), k, least)


def bm25_counted(counts: DataFrame, key: str, fields: dict[str, float], n_terms: int, k: int, least: float = 0.3) -> DataFrame:
    """``bm25`` of texts whose words are counted (see ``word_counts``), for tables that are reduced before a shuffle."""
    counted = cut(counts.where(F.coalesce(*fields).isNotNull()).select(key, *fields))
    need = max(1, int(least * n_terms))
    figures, scores = [], []
    for j, (f, weight) in enumerate(fields.items()):
        length, tfs = F.col(f)["len"], F.col(f)["tf"]
        figures += [F.count(f).alias(f"n{j}"), F.avg(length).alias(f"avg_len{j}")]
        figures += [F.count_if(tfs[i] > 0).alias(f"df{j}_{i}") for i in range(n_terms)]
        score = None
        for i in range(n_terms):
            idf = F.log(1 + (F.col(f"n{j}") - F.col(f"df{j}_{i}") + 0.5) / (F.col(f"df{j}_{i}") + 0.5))
            part = idf * tfs[i] * (K1 + 1) / (tfs[i] + K1 * (1 - B + B * length / F.col(f"avg_len{j}")))
            score = part if score is None else score + part
        scores.append(F.when(F.size(F.filter(tfs, lambda x: x > 0)) >= need, score * weight))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    hits = counted.crossJoin(F.broadcast(counted.agg(*figures))).select(key, F.round(best, 6).alias("score")).where("score IS NOT NULL")
    top = hits.orderBy(F.desc("score"), key).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))  # of k rows


def relative(score: str) -> Column:
    """Scores as a share of the best one; 0 where that is not positive. For result lists, not for tables."""
    best = F.max(score).over(Window.partitionBy(F.lit(1)))
    return F.when(best > 0, F.least(F.lit(1.0), F.col(score) / best)).otherwise(0.0)


def fuse(lists: list[tuple[DataFrame, float]], key: str, k: int, constant: int = RRF) -> DataFrame:
    """(key, score) of ranked lists (key, rank): weights of one sum over constant + rank; ties in order of appearance."""
    total = sum(w for _, w in lists) or len(lists)
    weights = [(w if sum(x for _, x in lists) else 1) / total for _, w in lists]
    rows = None
    for place, ((df, _), w) in enumerate(zip(lists, weights)):
        part = df.select(key, (F.lit(w) / (constant + F.col("rank"))).alias("s"), (F.lit(place * 1_000_000) + F.col("rank")).alias("seen"))
        rows = part if rows is None else rows.unionByName(part)
    fused = rows.groupBy(key).agg(F.round(F.sum("s"), 9).alias("score"), F.min("seen").alias("seen"))
    return fused.orderBy(F.desc("score"), "seen").limit(k).select(key, F.least(F.lit(1.0), F.col("score")).alias("score"))


def pack_context(hits: DataFrame, text: str, limit: int) -> DataFrame:
    """Hits (rank, text) in order while their lengths sum up to at most ``limit``; the first that does not fit ends it."""
    w = Window.partitionBy(F.lit(1)).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return hits.withColumn("running", F.sum(F.length(text)).over(w)).where(F.col("running") <= limit)
