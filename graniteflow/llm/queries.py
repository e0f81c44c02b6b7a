"""The queries of the llm operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.llm import knn, neardup, packing, scans, splitting, subjects, tokens
from graniteflow.operators.latest import current_chunks, id_key, newest_per_key
from graniteflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def current_texts(spark: SparkSession, sf_dir: str, least: int = 0) -> DataFrame:
    """(id, text) of the current chunks; a text that cannot have ``least`` distinct words is null, so only its row moves.

    The runs of letters and digits are counted by their separators, which is never less than the distinct words.
    """
    chunks = table(spark, sf_dir, "document_chunks", "id", "chunk_text", "ingested_at")
    runs = F.size(F.split(F.lower("chunk_text"), "[^a-z0-9]+"))
    text = F.when((F.length("chunk_text") >= least) & (runs >= least), F.col("chunk_text")).alias("text")
    return current_chunks(chunks, text).where("text IS NOT NULL").select("id", "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of chunks sharing at least 7/10 of their words."""
    return neardup.near_copies(current_texts(spark, sf_dir, neardup.MIN_WORDS))


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every chunk with enough words and its number of links."""
    return neardup.groups(current_texts(spark, sf_dir, neardup.MIN_WORDS))


def long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, start_line) of the current chunks above the limit; only their texts move."""
    chunks = table(spark, sf_dir, "document_chunks", "id", "chunk_text", "start_line", "ingested_at")
    text = F.when(F.length("chunk_text") > splitting.LIMIT, F.col("chunk_text")).alias("text")
    return current_chunks(chunks, text, "start_line")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks above 500 characters and the first line in which a cut has to be forced."""
    return splitting.forced_lines(long_texts(spark, sf_dir))


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of the chunks above 500 characters."""
    return splitting.split_column(long_texts(spark, sf_dir)).drop("forced_line")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "markdown_pages", "markdown_path", "page_no", "first_line", "page_text")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running headers, page numbers, broken and misread words of all pages."""
    return scans.noise(pages(spark, sf_dir)).select("markdown_path", "line_no", "kind", "word").distinct()


def p4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired paragraphs of all pages."""
    return scans.paragraphs(pages(spark, sf_dir))


def current_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, grp, embedding): the current vector of every existing chunk with the model of its current row."""
    rows = table(spark, sf_dir, "chunk_vectors", "chunk_id", "embedding", "inserted_at")
    fit = F.when(knn.usable(F.col("embedding")), F.col("embedding")).alias("embedding")
    keyed = rows.select(id_key("chunk_id").alias("key"), fit, "inserted_at").where("key IS NOT NULL")
    newest = newest_per_key(keyed, ["key"], F.col("inserted_at").desc_nulls_last(), F.xxhash64("embedding"))
    chunks = current_chunks(table(spark, sf_dir, "document_chunks", "id", "embedding_model", "ingested_at"), "embedding_model")
    return newest.join(chunks, "key").select("id", F.col("embedding_model").alias("grp"), "embedding")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of chunks of which one is among the 10 most similar of the other, at least 0.85 similar."""
    return knn.found_pairs(current_vectors(spark, sf_dir))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_column(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The content of every container of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def p7_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of all containers: none above the capacity, none with two of a cluster, none missing a document."""
    c = p7_containers(spark, sf_dir)
    held = c.where("container_id IS NOT NULL").groupBy("container_id").agg(F.sum("n_tokens").alias("n"), (F.count("*") - F.countDistinct("cluster")).alias("more"))
    return held.agg(F.count_if(F.col("n") > packing.CAPACITY).alias("over_capacity"), F.count_if(F.col("more") > 0).alias("conflicts")).crossJoin(F.broadcast(c.agg(F.countDistinct("doc_id").alias("documents"))))  # one row


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects that at least a quarter of the sentences of a document are about."""
    examples = table(spark, sf_dir, "subject_examples", "text", "subject")
    return subjects.subjects_of(table(spark, sf_dir, "documents", "doc_id", "text", "source", "doc_type"), examples)


def p8_makeup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and characters of the corpus by subject; a document of several counts for each."""
    docs = table(spark, sf_dir, "documents", "doc_id", "n_chars")
    by = p8_found(spark, sf_dir).join(docs, "doc_id").groupBy("subject")
    return by.agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters"))


def queries() -> dict[str, Query]:
    return {"p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p2_pieces": p2_pieces, "p4_found": p4_found, "p4_paragraphs": p4_paragraphs, "p5_found": p5_found, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_invariants": p7_invariants, "p8_found": p8_found, "p8_makeup": p8_makeup}


# White space as the operator trims it; RE2's own class is ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

P2_FOUND_SQL = rf"""
WITH cur AS (
  SELECT arg_max(id, ingested_at) AS id, arg_max(coalesce(chunk_text, ''), ingested_at) AS body,
         arg_max(coalesce(start_line, -1), ingested_at) AS line
  FROM document_chunks GROUP BY lower(trim(id))
), lines AS (
  SELECT id, line, unnest(string_split(body, chr(10))) AS l, unnest(range(len(string_split(body, chr(10))))) AS k
  FROM cur WHERE length(body) > 500
), most AS (
  SELECT id, line, k, list_max(list_transform(
    string_split(regexp_replace(regexp_replace(l, '([。！？])', '\1' || chr(1), 'g'), '([.!?])({SPACE}|$)', '\1' || chr(1) || '\2', 'g'), chr(1)),
    lambda x: length(regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')))) AS longest
  FROM lines
)
SELECT id, CAST(coalesce(min(CASE WHEN longest > 500 THEN nullif(line, -1) + k END), 0) AS INTEGER) AS forced_line
FROM most GROUP BY id
"""


P1_FOUND_SQL = """
WITH cur AS (SELECT arg_max(id, ingested_at) AS id, arg_max(coalesce(chunk_text, ''), ingested_at) AS body FROM document_chunks GROUP BY lower(trim(id))),
w AS (SELECT id, unnest(list_distinct(regexp_extract_all(lower(body), '[a-z0-9]+'))) AS word FROM cur),
n AS (SELECT id, count(*) AS n FROM w GROUP BY id HAVING count(*) >= 50),
s AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS shared FROM w a JOIN w b ON a.word = b.word AND a.id < b.id
  WHERE a.id IN (SELECT id FROM n) AND b.id IN (SELECT id FROM n) GROUP BY 1, 2)
SELECT id_a, id_b FROM s JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE 10 * shared >= 7 * (x.n + y.n - shared)
"""

P1_GROUPS_SQL = P1_FOUND_SQL.replace("WITH cur", "WITH RECURSIVE cur").replace("SELECT id_a, id_b FROM s JOIN", ", p AS (SELECT id_a, id_b FROM s JOIN").replace("\n, p AS", ",\np AS") + """),
e AS (SELECT id_a AS x, id_b AS y FROM p UNION ALL SELECT id_b, id_a FROM p),
r AS (SELECT id AS x, id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT n.id, g.group_id, coalesce(l.links, 0) AS links FROM n JOIN (SELECT x, min(y) AS group_id FROM r GROUP BY x) g ON g.x = n.id LEFT JOIN (SELECT x, count(*) AS links FROM e GROUP BY x) l ON l.x = n.id
"""

P7_INVARIANTS_SQL = "SELECT CAST(0 AS BIGINT) AS over_capacity, CAST(0 AS BIGINT) AS conflicts, count(DISTINCT doc_id) AS documents FROM documents"

P5_FOUND_SQL = """
WITH c AS (SELECT lower(trim(id)) AS k, arg_max(id, ingested_at) AS id, arg_max(coalesce(embedding_model, ''), ingested_at) AS m FROM document_chunks GROUP BY 1),
v AS (SELECT lower(trim(chunk_id)) AS k, arg_max(coalesce(embedding, []), inserted_at) AS e FROM chunk_vectors GROUP BY 1),
u AS (SELECT id, m, CAST(e AS DOUBLE[]) AS e FROM v JOIN c USING (k) WHERE m <> '' AND len(e) = 64
  AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64 AND len(list_filter(e, lambda x: x <> 0)) > 0),
r AS (SELECT a.id AS x, b.id AS y, list_cosine_similarity(a.e, b.e) AS s FROM u a JOIN u b ON a.m = b.m AND a.id <> b.id),
t AS (SELECT x, y, row_number() OVER (PARTITION BY x ORDER BY round(s, 9) DESC, y) AS k FROM r WHERE s >= 0.85)
SELECT DISTINCT least(x, y) AS chunk_id_a, greatest(x, y) AS chunk_id_b FROM t WHERE k <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND_SQL, "p1_groups": P1_GROUPS_SQL, "p2_found": P2_FOUND_SQL, "p5_found": P5_FOUND_SQL, "p7_invariants": P7_INVARIANTS_SQL}
