"""Queries of ranked retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators import search as S
from graniteflow.operators.latest import current_chunks
from graniteflow.plans import lifecycle_plans
from graniteflow.sources.tables import table

SQL: dict[str, str] = {}
QUERIES = {}
TERMS = ["lithium", "mortgage", "lending", "turbines", "court"]
TOP_TEXTS = 50
FIELDS, CHUNK_TERMS = {"chunk_text": 2.0, "title": 1.5}, ["remuneration", "impairment", "governance", "policies", "resources"]


def query(name, sql=None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def asked(spark, sf, ids):
    v = table(spark, sf, "embeddings", "vec_id", "embedding")
    return v.where(F.col("vec_id").isin(ids)).select(F.col("vec_id").alias("query"), F.col("embedding").alias("q"))


DIST = "round(list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6)"


@query("vector_topk_filtered", f"""
SELECT vec_id, label, distance, round(1 / (1 + distance), 6) AS score FROM (
  SELECT e.vec_id, e.label, {DIST} AS distance FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id = 0) q WHERE e.label IN (1, 3, 5))
ORDER BY distance, vec_id LIMIT 10""")
def vector_topk_filtered(spark, sf):
    """The 10 vectors nearest to one, of some labels, with a score."""
    v = table(spark, sf, "embeddings", "vec_id", "label", "embedding").where(F.col("label").isin(1, 3, 5))
    met = v.crossJoin(F.broadcast(asked(spark, sf, [0])))
    d = met.select("vec_id", "label", F.round(S.l2(F.col("embedding"), F.col("q")), 6).alias("distance"))
    return d.orderBy("distance", "vec_id").limit(10).withColumn("score", F.round(S.distance_score(F.col("distance")), 6))


@query("vector_topk_multi", f"""
SELECT query, vec_id, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT query, vec_id, distance, row_number() OVER (PARTITION BY query ORDER BY distance, vec_id) AS rank FROM (
    SELECT q.vec_id AS query, e.vec_id, {DIST} AS distance FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 100 = 0) q)) WHERE rank <= 10""")
def vector_topk_multi(spark, sf):
    """The 10 nearest of all vectors for every one whose id is divisible by 100."""
    v = table(spark, sf, "embeddings", "vec_id", "embedding")
    return S.nearest_in_blocks(v, v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("q")), "vec_id", 10)


@query("vector_topk_cosine", """
SELECT vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS similarity
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 100) q ORDER BY similarity DESC, vec_id LIMIT 20""")
def vector_topk_cosine(spark, sf):
    """The 20 vectors most similar to one by angle."""
    v = table(spark, sf, "embeddings", "vec_id", "embedding").crossJoin(F.broadcast(asked(spark, sf, [100])))
    s = v.select("vec_id", F.round(S.cosine(F.col("embedding"), F.col("q")), 6).alias("similarity"))
    return s.orderBy(F.desc("similarity"), "vec_id").limit(20)


@query("label_centroids", """
SELECT label, CAST(k AS INTEGER) AS k, round(avg(x), 6) AS mean FROM (
  SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS k FROM embeddings) GROUP BY label, k""")
def label_centroids(spark, sf):
    """The mean vector of every label, one row a dimension."""
    v = table(spark, sf, "embeddings", "label", "embedding").select("label", F.posexplode("embedding").alias("k", "x"))
    return v.groupBy("label", "k").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))


LIST = ", ".join(f"'{t}'" for t in TERMS)
BM25_CTE = f"""
w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
t AS (SELECT unnest([{LIST}]) AS term),
c AS (SELECT doc_id, len(w) AS len, term, len(list_filter(w, lambda x: x = term)) AS tf FROM w, t),
s AS (SELECT count(*) AS n, avg(len(w)) AS avg_len FROM w),
d AS (SELECT term, count_if(tf > 0) AS df FROM c GROUP BY term),
bm AS (SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {S.K1 + 1} / (tf + {S.K1} * (1 - {S.B} + {S.B} * len / avg_len))), 6) AS score, count_if(tf > 0) AS hits
  FROM c JOIN d USING (term), s GROUP BY doc_id HAVING count_if(tf > 0) >= 1),
ft AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM bm ORDER BY score DESC, doc_id LIMIT {TOP_TEXTS})"""


def fulltext(spark, sf):
    return S.bm25(table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text", TERMS, TOP_TEXTS)


@query("bm25_topk", f"WITH {BM25_CTE} SELECT doc_id, score, CAST(rank AS INTEGER) AS rank, round(score / max(score) OVER (), 6) AS relative FROM ft")
def bm25_topk(spark, sf):
    """The texts that match five terms best, and their scores against the best."""
    return fulltext(spark, sf).withColumn("relative", F.round(S.relative("score"), 6))


CHUNK_LIST = ", ".join(f"'{t}'" for t in CHUNK_TERMS)


@query("chunk_bm25_topk", f"""
WITH f AS (
  SELECT id, 'chunk_text' AS field, {FIELDS["chunk_text"]} AS weight, chunk_text AS body FROM {lifecycle_plans.CUR} WHERE lower(trim(id)) <> ''
  UNION ALL SELECT id, 'title', {FIELDS["title"]}, title FROM {lifecycle_plans.CUR} WHERE lower(trim(id)) <> ''),
w AS (SELECT id, field, weight, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM f WHERE body IS NOT NULL),
t AS (SELECT unnest([{CHUNK_LIST}]) AS term),
c AS (SELECT id, field, weight, len(w) AS len, term, len(list_filter(w, lambda x: x = term)) AS tf FROM w, t),
s AS (SELECT field, count(*) AS n, avg(len(w)) AS avg_len FROM w GROUP BY field),
d AS (SELECT field, term, count_if(tf > 0) AS df FROM c GROUP BY field, term),
bm AS (SELECT id, field, weight * sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {S.K1 + 1} / (tf + {S.K1} * (1 - {S.B} + {S.B} * len / avg_len))) AS score
  FROM c JOIN d USING (field, term) JOIN s USING (field) GROUP BY id, field, weight HAVING count_if(tf > 0) >= 1),
best AS (SELECT id, round(max(score), 6) AS score FROM bm GROUP BY id)
SELECT id, score, CAST(row_number() OVER (ORDER BY score DESC, id) AS INTEGER) AS rank FROM best ORDER BY score DESC, id LIMIT {TOP_TEXTS}""")
def chunk_bm25_topk(spark, sf):
    """The current chunks that match five terms best, by their text or by their title."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", *FIELDS)
    words = raw.select("id", "ingested_at", *(S.spaced(F.col(f)).alias(f) for f in FIELDS))
    counts = current_chunks(words, *(S.word_counts(f, CHUNK_TERMS).alias(f) for f in FIELDS))
    return S.bm25_counted(counts, "id", FIELDS, len(CHUNK_TERMS), TOP_TEXTS)


@query("hybrid_fusion", f"""
WITH {BM25_CTE}, vt AS (
  SELECT doc_id, row_number() OVER (ORDER BY distance, doc_id) AS rank FROM (
    SELECT e.vec_id AS doc_id, {DIST} AS distance FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id = 200) q ORDER BY distance, doc_id LIMIT {TOP_TEXTS})),
u AS (SELECT doc_id, 0.6 / (60 + rank) AS s, rank AS seen FROM vt UNION ALL SELECT doc_id, 0.4 / (60 + rank), 1000000 + rank FROM ft)
SELECT doc_id, round(sum(s), 9) AS score FROM u GROUP BY doc_id ORDER BY round(sum(s), 9) DESC, min(seen) LIMIT 20""")
def hybrid_fusion(spark, sf):
    """A vector list and a text list as one, by weighted reciprocal ranks."""
    v = table(spark, sf, "embeddings", "vec_id", "embedding")
    vectors = S.nearest(v, asked(spark, sf, [200]), "vec_id", TOP_TEXTS).withColumnRenamed("vec_id", "doc_id")
    return S.fuse([(vectors, 0.6), (fulltext(spark, sf), 0.4)], "doc_id", 20)


@query("context_pack", f"""
WITH {BM25_CTE}, r AS (SELECT rank, doc_id, text, sum(length(text)) OVER (ORDER BY rank) AS running FROM ft JOIN documents USING (doc_id))
SELECT CAST(rank AS INTEGER) AS rank, doc_id, CAST(running AS BIGINT) AS running,
  CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS snippet FROM r WHERE running <= 20000""")
def context_pack(spark, sf):
    """The hits that fit into a context of 20,000 characters, with a snippet to cite."""
    docs = table(spark, sf, "documents", "doc_id", "text")
    hits = fulltext(spark, sf).join(docs, "doc_id")
    snippet = F.when(F.length("text") > 200, F.concat(F.substring("text", 1, 200), F.lit("..."))).otherwise(F.col("text"))
    return S.pack_context(hits, "text", 20_000).select("rank", "doc_id", "running", snippet.alias("snippet"))


def queries():
    return QUERIES


def oracle_sql():
    return SQL
