"""Full-text index, graph retrieval, derived relations, quality rules, and structure of documents, with SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from graniteflow.operators import fulltext, graph, ontology, records, stats, structure
from graniteflow.operators.latest import current_chunks, id_key
from graniteflow.plans import graph_plans
from graniteflow.plans.fixture import Registry, rows_sql
from graniteflow.plans.lifecycle_plans import CUR
from graniteflow.session import ensure_checkpoint_dir
from graniteflow.sources.tables import table

query = Registry()

# ---- full-text index over chunks

FILTERS = ["stock_code", "doc_type", "market", "year"]


def chunk_index(spark, sf) -> fulltext.Index:
    """The index of the current chunks in the shared folder, built where this session has not built it yet."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/fulltext-{uuid.uuid5(uuid.NAMESPACE_URL, sf).hex}"
    try:
        return fulltext.load(spark, folder)
    except Exception as e:  # noqa: BLE001 - the first call of a session finds nothing there
        if "PATH_NOT_FOUND" not in str(e):
            raise
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "chunk_text", "title")
    docs = table(spark, sf, "source_documents", F.col("id").alias("document_id"), *FILTERS).groupBy("document_id").agg(*(F.min(c).alias(c) for c in FILTERS))
    rows = current_chunks(raw, "document_id", "chunk_text", "title").join(docs, "document_id", "left")
    fulltext.build(rows, "id", ["chunk_text", "title"], FILTERS).save(folder)
    return fulltext.load(spark, folder)


TERMS = ["remuneration", "impairment", "governance", "policies", "resources"]
IN = ", ".join(f"'{t}'" for t in TERMS)
# words as the index makes them, for texts without scripts that have no spaces; the terms asked for are Latin
INDEX_SQL = f"""
f AS (SELECT id, 'chunk_text' AS field, 2.0 AS weight, chunk_text AS body FROM {CUR} WHERE lower(trim(id)) <> '' UNION ALL SELECT id, 'title', 1.5, title FROM {CUR} WHERE lower(trim(id)) <> ''),
w AS (SELECT id, field, weight, list_concat(regexp_extract_all(regexp_replace(lower(body), '[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}]', ' ', 'g'), '[\\p{{L}}\\p{{N}}]+'),
  list_filter(flatten(list_transform(regexp_extract_all(lower(body), '[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}]+'), lambda r: list_transform(range(greatest(1, length(r) - 1)), lambda i: substr(r, CAST(i AS INTEGER) + 1, 2)))), lambda x: x <> '')) AS w FROM f WHERE body IS NOT NULL),
t AS (SELECT unnest([{IN}]) AS term),
x AS (SELECT * FROM w WHERE len(w) > 0),
c AS (SELECT id, field, weight, len(w) AS len, term, len(list_filter(w, lambda y: y = term)) AS tf FROM x, t),
s AS (SELECT field, count(*) AS n, avg(len(w)) AS avg_len FROM x GROUP BY field),
d AS (SELECT field, term, count_if(tf > 0) AS df FROM c GROUP BY field, term),
bm AS (SELECT id, field, weight * sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS score FROM c JOIN d USING (field, term) JOIN s USING (field) WHERE tf > 0 GROUP BY id, field, weight),
docs AS (SELECT lower(trim(c.id)) AS k, min(s.market) AS market, min(s.year) AS year FROM {CUR} c LEFT JOIN source_documents s ON s.id = c.document_id GROUP BY 1),
best AS (SELECT id, round(max(score), 6) AS score FROM bm GROUP BY id)"""


@query("bm25_filtered", f"""
WITH {INDEX_SQL}, hit AS (SELECT id AS key, score FROM best JOIN docs ON k = lower(trim(id)) WHERE market = 'hk_stock' AND year >= 2022 ORDER BY score DESC, key LIMIT 50)
SELECT key, score, round(score / max(score) OVER (), 6) AS relative, CAST(row_number() OVER (ORDER BY score DESC, key) AS INTEGER) AS rank FROM hit""")
def bm25_filtered(spark, sf):
    """The chunks of one market and some years that match five terms best, out of the index."""
    where = (F.col("market") == "hk_stock") & (F.col("year") >= 2022)
    return fulltext.search(chunk_index(spark, sf), " ".join(TERMS), {"chunk_text": 2.0, "title": 1.5}, 50, where)


@query("bm25_page", f"""
WITH {INDEX_SQL}, hit AS (SELECT id AS key, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM best)
SELECT key, score, CAST(rank AS INTEGER) AS rank FROM hit WHERE rank > 20 AND rank <= 40""")
def bm25_page(spark, sf):
    """The third and fourth ten hits of all chunks."""
    return fulltext.search(chunk_index(spark, sf), " ".join(TERMS), {"chunk_text": 2.0, "title": 1.5}, 20, offset=20).select("key", "score", "rank")


@query("term_frequencies", f"WITH {INDEX_SQL} SELECT field, term, CAST(df AS BIGINT) AS df FROM d WHERE df > 0")
def term_frequencies(spark, sf):
    """In how many chunks each of five terms is, by field."""
    return chunk_index(spark, sf).frequencies.where(F.col("term").isin(TERMS)).select("field", "term", "df")


@query("index_rejects", """
SELECT count(*) FILTER (coalesce(trim(id), '') <> '') AS accepted, count(*) FILTER (coalesce(trim(id), '') = '') AS rejected FROM (SELECT CASE WHEN chunk_index IS NULL THEN '  ' ELSE id END AS id FROM document_chunks)""")
def index_rejects(spark, sf):
    """How many rows an index takes and how many it refuses for want of an id; rows without a number stand for these."""
    rows = table(spark, sf, "document_chunks", "id", "chunk_index").select(F.when(F.col("chunk_index").isNull(), "  ").otherwise(F.col("id")).alias("id"))
    good, bad = fulltext.accepted(rows, "id")
    return good.agg(F.count("*").alias("accepted")).crossJoin(F.broadcast(bad.agg(F.count("*").alias("rejected"))))  # one row each


@query("index_questions", rows_sql("question VARCHAR, best VARCHAR, hits INT", [("资产减值", "cn", 1), ("asset growth", "en", 2), ("nothing like it", None, 0), ("", None, 0)]))
def index_questions(spark, sf):
    """Questions in scripts with and without spaces on a few texts."""
    rows = spark.createDataFrame([("cn", "公司资产减值准备", "x"), ("en", "Asset growth and more asset growth", "x"), ("de", "growth", None), (None, "growth", "x"), ("no", None, None)], "id string, text string, kind string")
    good, _ = fulltext.accepted(rows, "id")
    index, out = fulltext.build(good, "id", ["text"], ["kind"]), None
    for q in ("资产减值", "asset growth", "nothing like it", ""):
        hits = fulltext.search(index, q, {"text": 1.0}, 5)
        part = hits.agg(F.min_by("key", "rank").alias("best"), F.count("*").cast("int").alias("hits")).select(F.lit(q).alias("question"), "best", "hits")
        out = part if out is None else out.union(part)
    return out


@query("index_rows", f"""
SELECT c.id, c.document_id, d.stock_code, d.company_name, d.doc_type, d.market, d.year, d.quarter, c.chunk_index, c.title, c.title_level, CAST(length(c.chunk_text) AS INTEGER) AS n_chars, coalesce(c.is_table, FALSE) AS is_table
FROM {CUR} c JOIN (SELECT id, min(stock_code) AS stock_code, min(company_name) AS company_name, min(doc_type) AS doc_type, min(market) AS market, min(year) AS year, min(quarter) AS quarter FROM source_documents GROUP BY id) d ON d.id = c.document_id
WHERE c.es_indexed_at IS NULL AND trim(c.chunk_text, ' ') <> ''""")
def index_rows(spark, sf):
    """The rows that an index is still to get: chunks with text, widened by all columns of their filing."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "chunk_index", "title", "title_level", "is_table", "es_indexed_at", "chunk_text")
    size = F.when(F.trim("chunk_text") != "", F.length("chunk_text")).alias("n_chars")
    c = current_chunks(raw, "document_id", "chunk_index", "title", "title_level", F.coalesce("is_table", F.lit(False)).alias("is_table"), "es_indexed_at", size).where("es_indexed_at IS NULL AND n_chars IS NOT NULL")
    wide = ("stock_code", "company_name", "doc_type", "market", "year", "quarter")
    d = table(spark, sf, "source_documents", "id", *wide).groupBy(F.col("id").alias("document_id")).agg(*(F.min(x).alias(x) for x in wide))
    return c.join(d, "document_id").select("id", "document_id", *wide, "chunk_index", "title", "title_level", "n_chars", "is_table")


@query("index_lineage", f"SELECT document_id, count(*) AS chunks, CAST(count(*) FILTER (es_indexed_at IS NULL) AS BIGINT) AS pending FROM {CUR} GROUP BY document_id")
def index_lineage(spark, sf):
    """Chunks in all and not yet indexed, by filing."""
    c = current_chunks(table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "es_indexed_at"), "document_id", "es_indexed_at")
    return c.groupBy("document_id").agg(F.count("*").alias("chunks"), F.count_if(F.col("es_indexed_at").isNull()).alias("pending"))


# ---- graph

def parts(spark, sf):
    """(chunks, documents) as graph retrieval takes them."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "parent_chunk_id", "chunk_index")
    c = current_chunks(raw, "document_id", id_key("parent_chunk_id").alias("parent"), "chunk_index")
    d = table(spark, sf, "source_documents", "id", "stock_code", "year").groupBy(F.col("id").alias("document_id")).agg(F.min("stock_code").alias("stock_code"), F.min("year").alias("year"))
    return c, d


DOC = "(SELECT id, min(stock_code) AS stock_code, min(year) AS year FROM source_documents GROUP BY id)"


@query("graph_document_chunks", f"""
WITH {graph_plans.CUR}, top AS (SELECT stock_code FROM source_documents GROUP BY stock_code ORDER BY count(DISTINCT id) DESC, stock_code LIMIT 1)
SELECT k AS chunk, c.document_id FROM cur c JOIN {DOC} d ON d.id = c.document_id WHERE p IS NULL AND d.stock_code = (SELECT stock_code FROM top) AND d.year >= 2022""")
def graph_document_chunks(spark, sf):
    """The chunks at the top of the filings of one company and some years: the company with most filings."""
    c, d = parts(spark, sf)
    n = d.groupBy("stock_code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "stock_code").limit(1).select("stock_code")
    return graph.of_documents(c, d.where("year >= 2022").join(F.broadcast(n), "stock_code", "left_semi")).select(F.col("key").alias("chunk"), "document_id")  # one row


@query("graph_sibling_rows", f"""
WITH {graph_plans.CUR}, a AS (SELECT * FROM cur WHERE document_id IN (SELECT id FROM source_documents WHERE doc_type = 'annual_reports') AND p IN (SELECT k FROM cur))
SELECT a.k AS chunk, b.k AS sibling FROM a JOIN cur b ON b.p = a.p AND b.document_id = a.document_id AND b.k <> a.k""")
def graph_sibling_rows(spark, sf):
    """The chunks that share parent and filing with those of annual reports, as rows."""
    c, _ = parts(spark, sf)
    asked = c.join(table(spark, sf, "source_documents", F.col("id").alias("document_id"), "doc_type").where("doc_type = 'annual_reports'"), "document_id", "left_semi")
    known = asked.join(c.select(F.col("key").alias("parent")), "parent", "left_semi")
    return graph.siblings(c, known.select("key"))


@query("graph_stubs", """
SELECT DISTINCT type, label, id FROM (
  SELECT 'BELONGS_TO' AS type, 'Document' AS label, document_id AS id FROM chunk_vectors WHERE document_id NOT IN (SELECT id FROM source_documents)
  UNION ALL SELECT 'EMBEDS', 'Chunk', lower(trim(chunk_id)) FROM chunk_vectors WHERE lower(trim(chunk_id)) NOT IN (SELECT lower(trim(id)) FROM document_chunks WHERE id IS NOT NULL)) WHERE id <> ''""")
def graph_stubs(spark, sf):
    """The nodes that edges name and that are not there: they come as stubs of their key alone."""
    v = table(spark, sf, "chunk_vectors", "document_id", id_key("chunk_id").alias("chunk"))
    nodes = graph_plans.nodes(spark, sf)
    e = v.select(F.lit("BELONGS_TO").alias("type"), F.lit("Document").alias("label"), F.col("document_id").alias("id")).union(v.select(F.lit("EMBEDS"), F.lit("Chunk"), "chunk"))
    return graph.stubs(nodes, e.where("id <> ''"))


@query("graph_walks", rows_sql("walk VARCHAR, chunk VARCHAR, depth INT", [("document", "r", 0), ("document", "s", 0), ("chunk", "a", 0), ("chunk", "b", 0), ("hierarchy", "a", 1), ("hierarchy", "b", 1), ("hierarchy", "c", 2), ("children", "b", 1), ("children", "a", 1), ("children", "c", 2), ("children", "d", 3)]))
def graph_walks(spark, sf):
    """All ways to walk a small graph, by the dispatcher."""
    c = spark.createDataFrame([("r", "x", None, 0), ("s", "x", None, 1), ("a", "x", "r", 3), ("b", "x", "r", 2), ("c", "x", "a", 4), ("d", "x", "c", None)], "key string, document_id string, parent string, chunk_index int")
    d = spark.createDataFrame([("x", "000001", 2023), ("y", "000002", 2023)], "document_id string, stock_code string, year int")
    out = None
    for walk, asked, depth in (("document", "000001", None), ("chunk", "a", None), ("hierarchy", "r", 2), ("children", "r", 9)):
        part = graph.walk(c, d, walk, asked, depth, 10).select(F.lit(walk).alias("walk"), F.col("key").alias("chunk"), "depth")
        out = part if out is None else out.union(part)
    return out


@query("graph_build_counts", f"""
WITH {graph_plans.EDGES}, s AS (SELECT document_id, count(*) AS chunks, count(*) FILTER (p IS NULL) AS roots FROM cur WHERE document_id IN (SELECT id FROM source_documents) GROUP BY document_id)
SELECT document_id, chunks, roots, roots > 0 AS valid FROM s""")
def graph_build_counts(spark, sf):
    """Nodes and edges that each filing brings, and whether it passes: with chunks there must be one that belongs to it."""
    c, d = parts(spark, sf)
    n = c.join(d.select("document_id"), "document_id", "left_semi").groupBy("document_id").agg(F.count("*").alias("chunks"), F.count_if(F.col("parent").isNull()).alias("roots"))
    return n.withColumn("valid", F.col("roots") > 0)


@query("graph_reset", "SELECT 'node' AS kind, CAST(0 AS BIGINT) AS left_over UNION ALL SELECT 'edge', 0")
def graph_reset(spark, sf):
    """A graph without its nodes has none of its edges either."""
    nodes, edges = graph_plans.nodes(spark, sf), graph_plans.edges(spark, sf)
    no_nodes, no_edges = graph.without_nodes(nodes, edges, nodes.select("id"))
    return no_nodes.agg(F.count("*").alias("left_over")).select(F.lit("node").alias("kind"), "left_over").union(no_edges.agg(F.count("*").alias("left_over")).select(F.lit("edge"), "left_over"))


@query("company_nodes", """
SELECT stock_code AS code, arg_min(company_name, (created_at IS NOT NULL, created_at, id, company_name)) AS name FROM source_documents WHERE company_name IS NOT NULL GROUP BY stock_code""")
def company_nodes(spark, sf):
    """The company nodes of the graph with the first name that their filings give them."""
    d = table(spark, sf, "source_documents", "stock_code", "company_name", "created_at", "id").where("company_name IS NOT NULL")
    return d.groupBy(F.col("stock_code").alias("code")).agg(F.min_by("company_name", F.struct("created_at", "id", "company_name")).alias("name"))


@query("chunk_parents", f"WITH {graph_plans.CUR} SELECT k AS child, p AS parent, p IN (SELECT k FROM cur) AS present FROM cur WHERE p IS NOT NULL")
def chunk_parents(spark, sf):
    """Edges from child to parent, and whether the parent is there."""
    c, _ = parts(spark, sf)
    known = c.select(F.col("key").alias("parent")).withColumn("present", F.lit(True))
    return c.where("parent IS NOT NULL").select(F.col("key").alias("child"), "parent").join(known, "parent", "left").select("child", "parent", F.coalesce("present", F.lit(False)).alias("present"))


# ---- derived relations

HOLDINGS = [("a", "b", 40.0), ("a", "b", 20.0), ("b", "c", 51.0), ("c", "d", 90.0), ("d", "a", 60.0), ("e", "f", 50.0), ("f", "g", 70.0), (None, "g", 99.0)]
HELD = rows_sql("holder VARCHAR, held VARCHAR, percent DOUBLE", HOLDINGS)


@query("indirect_control", f"""
WITH RECURSIVE l AS (SELECT holder, held FROM ({HELD}) WHERE holder IS NOT NULL GROUP BY ALL HAVING sum(percent) > 50),
t AS (SELECT holder, held, 1 AS steps FROM l UNION SELECT t.holder, l.held, t.steps + 1 FROM t JOIN l ON l.holder = t.held WHERE t.steps < 9 AND l.held <> t.holder)
SELECT holder AS controller, held AS controlled, CAST(min(steps) AS INTEGER) AS steps FROM t GROUP BY ALL HAVING NOT (holder = 'b' AND held = 'd')""")
def indirect_control(spark, sf):
    """Who controls whom through chains of holdings above half, but for what is known already."""
    h = spark.createDataFrame(HOLDINGS, "holder string, held string, percent double")
    return ontology.indirect_control(h, 50.0, spark.createDataFrame([("b", "d")], "controller string, controlled string"))


@query("supplier_control", """
WITH RECURSIVE h AS (SELECT l_suppkey % 40 AS holder, l_partkey % 40 AS held, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT held, sum(n) AS total FROM h WHERE holder <> held GROUP BY held),
l AS (SELECT holder, h.held FROM h JOIN t ON t.held = h.held WHERE holder <> h.held AND 100.0 * n / total > 2.9), c AS (SELECT holder, held, 1 AS steps FROM l UNION SELECT c.holder, l.held, c.steps + 1 FROM c JOIN l ON l.holder = c.held WHERE l.held <> c.holder AND c.steps < 12)
SELECT holder AS controller, held AS controlled, CAST(min(steps) AS INTEGER) AS steps FROM c GROUP BY ALL""")
def supplier_control(spark, sf):
    """Chains among 40 groups of suppliers and parts, by shares of the lines above 2.9 percent: all lines count."""
    li = table(spark, sf, "lineitem", (F.col("l_suppkey") % 40).alias("holder"), (F.col("l_partkey") % 40).alias("held")).where("holder <> held")
    n = li.groupBy("holder", "held").agg(F.count("*").alias("n"))
    total = n.groupBy("held").agg(F.sum("n").alias("total"))
    return ontology.indirect_control(n.join(total, "held").select("holder", "held", (100.0 * F.col("n") / F.col("total")).alias("percent")), 2.9)


OFFICERS = [("x", "Ann Lee", "1970"), ("y", "Ann Lee", "1970"), ("z", "Ann Lee", "1980"), ("x", "Bo Li", "1960"), ("y", "Bo Li", "1960"), ("w", "Bo Li", "1960"), ("x", "Ann Lee", "1970"), ("v", None, "1960"), ("u", "Bo Li", None)]
OFFICER_SQL = rows_sql("company VARCHAR, name VARCHAR, born VARCHAR", OFFICERS)


@query("shared_officers", f"SELECT a.company AS company_a, b.company AS company_b, count(*) AS officers FROM (SELECT DISTINCT * FROM ({OFFICER_SQL})) a JOIN (SELECT DISTINCT * FROM ({OFFICER_SQL})) b ON a.name = b.name AND a.born = b.born AND a.company < b.company GROUP BY ALL")
def shared_officers(spark, sf):
    """Companies with officers in common."""
    return ontology.shared_officers(spark.createDataFrame(OFFICERS, "company string, name string, born string"), 2)


@query("shared_former_names", """
WITH n AS (SELECT DISTINCT code, trim(unnest(string_split(pre_name, ',')), ' ') AS name FROM companies WHERE pre_name IS NOT NULL AND code IS NOT NULL)
SELECT a.code AS company_a, b.code AS company_b, count(*) AS officers FROM n a JOIN n b ON a.name = b.name AND a.code < b.code WHERE a.name <> '' GROUP BY ALL""")
def shared_former_names(spark, sf):
    """Companies that have had a name in common, by the same operator."""
    c = table(spark, sf, "companies", "code", "pre_name").where("code IS NOT NULL").select(F.col("code").alias("company"), F.explode(F.split("pre_name", ",")).alias("name")).withColumn("name", F.trim("name")).where("name <> ''")
    return ontology.shared_officers(c.withColumn("born", F.lit("-")))


@query("mapped_industries", """
WITH own AS (SELECT DISTINCT code AS company, industry FROM companies WHERE industry IS NOT NULL), m AS (SELECT * FROM (VALUES ('energy', 'utilities', 0.9), ('energy', 'mining', 0.5), ('mining', 'energy', 0.8), ('banking', 'finance', 0.95), ('banking', 'finance', 0.85)) t(a, b, c))
SELECT company, industry, 1.0::DOUBLE AS confidence, FALSE AS derived FROM own UNION ALL
SELECT company, b, CAST(max(c) AS DOUBLE), TRUE FROM own JOIN m ON a = industry WHERE c >= 0.8 AND NOT EXISTS (SELECT 1 FROM own o WHERE o.company = own.company AND o.industry = b) GROUP BY company, b""")
def mapped_industries(spark, sf):
    """Industries of companies with those that a mapping adds from a confidence of 0.8."""
    own = table(spark, sf, "companies", F.col("code").alias("company"), "industry").where("industry IS NOT NULL").distinct()
    m = spark.createDataFrame([("energy", "utilities", 0.9), ("energy", "mining", 0.5), ("mining", "energy", 0.8), ("banking", "finance", 0.95), ("banking", "finance", 0.85)], "from_industry string, to_industry string, confidence double")
    return ontology.mapped_industries(own, m)


# ---- quality

@query("bronze_rules", """
SELECT coalesce(reason, 'good') AS reason, count(*) AS n FROM (SELECT CASE WHEN NOT coalesce(file_size BETWEEN 1 AND 500000000, FALSE) THEN 'size' WHEN NOT coalesce(file_hash <> '', FALSE) THEN 'hash' WHEN NOT coalesce(stock_code <> '' AND company_name <> '', FALSE) THEN 'metadata'
  WHEN NOT coalesce(publish_date IS NULL OR year(publish_date) BETWEEN year - 1 AND year + 2, FALSE) THEN 'date' END AS reason FROM source_documents) GROUP BY 1""")
def bronze_rules(spark, sf):
    """Filings by the first rule of intake that they break."""
    d = table(spark, sf, "source_documents", "file_size", "file_hash", "stock_code", "company_name", "publish_date", "year")
    rules = {"size": F.col("file_size").between(1, 500_000_000), "hash": F.col("file_hash") != "", "metadata": (F.col("stock_code") != "") & (F.col("company_name") != ""), "date": F.col("publish_date").isNull() | F.year("publish_date").between(F.col("year") - 1, F.col("year") + 2)}
    return records.judged(d, rules).groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query("silver_rules", """
SELECT coalesce(reason, 'good') AS reason, count(*) AS n FROM (SELECT CASE WHEN text IS NULL OR length(text) <= 100 THEN 'short' WHEN (length(text) - length(replace(text, chr(65533), ''))) / length(text) >= 0.01 THEN 'garbled'
  WHEN length(regexp_replace(text, '[^\\p{L}]', '', 'g')) / length(text) < 0.5 THEN 'letters' END AS reason FROM documents) GROUP BY 1""")
def silver_rules(spark, sf):
    """Texts by the first rule that they break: length, garbled characters, share of letters."""
    t = F.col("text")
    broken = F.length(t) - F.length(F.replace(t, F.lit("�"), F.lit("")))
    letters = F.length(F.regexp_replace(t, "[^\\p{L}]", ""))
    rules = {"short": F.length(t) > 100, "garbled": broken / F.length(t) < 0.01, "letters": letters / F.length(t) >= 0.5}
    return records.judged(table(spark, sf, "documents", "text"), rules).groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query("monitors", """
SELECT market, count(*) FILTER (vectorized_at IS NULL) AS backlog, count(*) FILTER (vectorized_at IS NULL) > 100 AS backlog_alert, round(max(epoch(crawled_at) - epoch(publish_date)) / 3600, 4) AS worst_lag_hours, coalesce(max(epoch(crawled_at) - epoch(publish_date)) > 7200, FALSE) AS lag_alert,
  round(count(*) FILTER (status <> 'failed') / count(*), 6) AS success, count(*) FILTER (status <> 'failed') / count(*) < 0.9 AS success_alert FROM source_documents GROUP BY market""")
def monitors(spark, sf):
    """Backlog, lag and success of every market with their alerts."""
    d = table(spark, sf, "source_documents", "market", "vectorized_at", "crawled_at", "publish_date", "status")
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    n = d.groupBy("market").agg(F.count_if(F.col("vectorized_at").isNull()).alias("backlog"), F.max(seconds("crawled_at") - seconds("publish_date")).alias("lag"), stats.ratio(F.count_if(F.col("status") != "failed"), F.count("*")).alias("success"))
    return n.select("market", "backlog", (F.col("backlog") > 100).alias("backlog_alert"), F.round(F.col("lag") / 3600, 4).alias("worst_lag_hours"), F.coalesce(F.col("lag") > 7200, F.lit(False)).alias("lag_alert"), F.round("success", 6).alias("success"), (F.col("success") < 0.9).alias("success_alert"))


@query("gate_cases", rows_sql("total INT, ok INT, parse BOOLEAN, index BOOLEAN", [(0, 0, True, False), (100, 79, False, False), (100, 80, True, False), (100, 89, True, False), (100, 90, True, True)]))
def gate_cases(spark, sf):
    """The two gates at their thresholds and on nothing."""
    d = spark.createDataFrame([(0, 0), (100, 79), (100, 80), (100, 89), (100, 90)], "total int, ok int")
    return d.select("total", "ok", stats.gate(F.col("total"), F.col("ok"), 0.8, True).alias("parse"), stats.gate(F.col("total"), F.col("ok"), 0.9, False).alias("index"))


@query("prospectus_pages", rows_sql("id INT, fault VARCHAR", [(1, None), (2, "too small"), (3, "short text"), (4, "no keyword"), (5, "encoding")]))
def prospectus_pages(spark, sf):
    """Whether downloaded pages are prospectuses, with what is wrong first."""
    body = lambda t: f"<html><body><p>{t}</p>{'<!-- ' + 'x' * 1200 + ' -->'}</body></html>".encode()
    rows = [(1, body("招股说明书 " + "长" * 120)), (2, b"<p>x</p>"), (3, body("招股说明书")), (4, body("长" * 150)), (5, b"\xff\xfe\x81" + b"\x80" * 1100)]
    return structure.page_faults(spark.createDataFrame([(i, bytearray(b)) for i, b in rows], "id int, content binary"))


@query("vectorizable_chunks", f"""
SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN s.id IS NULL THEN 'no filing' WHEN c.status = 'vectorized' THEN 'done' WHEN coalesce(c.is_table, FALSE) AND length(regexp_replace(regexp_replace(coalesce(c.chunk_text, ''), '<[^>]+>', '', 'g'), '[^A-Za-z]', '', 'g')) < 10 THEN 'skipped' WHEN coalesce(trim(c.chunk_text, ' '), '') = '' THEN 'blank' ELSE 'to do' END AS outcome
FROM {CUR} c LEFT JOIN (SELECT DISTINCT id FROM source_documents) s ON s.id = c.document_id) GROUP BY outcome""")
def vectorizable_chunks(spark, sf):
    """What vectorising would do with every chunk: rejects, those that are done, tables with too few letters, blanks, the rest."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "status", "is_table", "chunk_text")
    letters = F.length(F.regexp_replace(F.regexp_replace(F.coalesce("chunk_text", F.lit("")), "<[^>]+>", ""), "[^A-Za-z]", "")).alias("letters")
    c = current_chunks(raw, "document_id", "status", F.coalesce("is_table", F.lit(False)).alias("is_table"), letters, (F.coalesce(F.trim("chunk_text"), F.lit("")) == "").alias("blank"))
    s = table(spark, sf, "source_documents", F.col("id").alias("document_id")).distinct().withColumn("known", F.lit(True))
    outcome = F.when(F.col("known").isNull(), "no filing").when(F.col("status") == "vectorized", "done").when(F.col("is_table") & (F.col("letters") < 10), "skipped").when(F.col("blank"), "blank").otherwise("to do")
    return c.join(s, "document_id", "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


# ---- structure of documents

MARKDOWN = [
    ("cn", "hs_stock", "# 第一节 重要提示\n一、提示\n# 第二节 公司概况\n## 一、基本情况\n文字\n## 二、股本\n### 1、普通股\n### 2、优先股\n## 三、其他\n（一）甲\n（二）乙\n## 九、断号\n第三节 财务报告. .. 31\n<table>\n# not a heading\n</table>\n# 第三节 财务报告\n"),
    ("us", "us_stock", "# PART I\n## Item 1. Business\n### Overview\n## Item 2. Properties\n## Item 3 (continued)\n"),
    ("flat", "hk_stock", "# A\nshort line\nlong, line, with, too, many\n## B\n"), ("none", "hk_stock", ""), ("null", "us_stock", None),
    ("dots", "hs_stock", "# 第一章 总则\n## 1.1 范围\n## 1.2 定义\n# 第二章 细则\n## 2.1 一般\n"), ("alpha", "hs_stock", "# 第一节 总则\n# 第二节 细则\n一、甲\n(1)子\n(2)丑\na) 小\nb) 大\n二、乙\n"),
]
LEVELS = [
    ("cn", 0, "第一节 重要提示", 1, -1), ("cn", 1, "第二节 公司概况", 1, -1), ("cn", 2, "一、基本情况", 2, 1), ("cn", 3, "二、股本", 2, 1), ("cn", 4, "1、普通股", 3, 3), ("cn", 5, "2、优先股", 3, 3), ("cn", 6, "三、其他", 2, 1), ("cn", 7, "（一）甲", 3, 6), ("cn", 8, "（二）乙", 3, 6), ("cn", 9, "第三节 财务报告", 1, -1),
    ("us", 0, "PART I", 1, -1), ("us", 1, "Item 1. Business", 2, 0), ("us", 2, "Overview", 3, 1), ("us", 3, "Item 2. Properties", 2, 0), ("flat", 0, "A", 1, -1), ("flat", 1, "short line", 1, -1), ("flat", 2, "B", 1, -1),
    ("dots", 0, "第一章 总则", 1, -1), ("dots", 1, "1.1 范围", 1, -1), ("dots", 2, "1.2 定义", 1, -1), ("dots", 3, "第二章 细则", 1, -1), ("dots", 4, "2.1 一般", 1, -1),
    ("alpha", 0, "第一节 总则", 1, -1), ("alpha", 1, "第二节 细则", 1, -1), ("alpha", 2, "一、甲", 2, 1), ("alpha", 3, "(1)子", 3, 2), ("alpha", 4, "(2)丑", 3, 2), ("alpha", 5, "a) 小", 4, 4), ("alpha", 6, "b) 大", 4, 4), ("alpha", 7, "二、乙", 2, 1),
]


def made_up(spark):
    return spark.createDataFrame(MARKDOWN, "doc string, market string, text string")


@query("heading_levels", rows_sql("doc VARCHAR, heading_index INT, title VARCHAR, level INT, parent_index INT", LEVELS))
def heading_levels(spark, sf):
    """Levels and parents of the headings of made-up reports in all modes."""
    return structure.heading_rows(made_up(spark)).select("doc", "heading_index", "title", "level", "parent_index")


@query("heading_counts", rows_sql("doc VARCHAR, mode VARCHAR, headings BIGINT, deepest INT", [("cn", "chinese", 10, 3), ("us", "english", 4, 3), ("flat", "simple", 3, 1), ("none", "simple", 0, None), ("null", "simple", 0, None), ("dots", "simple", 5, 1), ("alpha", "chinese", 8, 4)]))
def heading_counts(spark, sf):
    """The mode of each made-up report and how many headings it has."""
    d = made_up(spark)
    n = structure.heading_rows(d).groupBy("doc").agg(F.count("*").alias("headings"), F.max("level").alias("deepest"))
    return structure.modes(d).join(n, "doc", "left").select("doc", "mode", F.coalesce("headings", F.lit(0)).alias("headings"), "deepest")


NUMBER_CASES = [("一、x", "numeral", 1), ("一、 x", "numeral then space", 1), ("十二、x", "numeral", 12), ("二十一、x", "numeral", 21), ("1.2.3 x", "dotted 3", 3), ("3. x", "arabic.", 3), ("（四）x", "bracket numeral", 4), ("(5)x", "bracket arabic", 5), ("b) x", "small letter", 2), ("(iv) x", "bracket small roman", 4), ("XII. x", "roman", 12), ("x", "", 0)]


@query("heading_numbers", rows_sql("title VARCHAR, form VARCHAR, number INT", NUMBER_CASES))
def heading_numbers(spark, sf):
    """Forms and values of the numbers of headings."""
    rows = [(t, *structure.numbered(t)[:2]) for t, *_ in NUMBER_CASES]
    return spark.createDataFrame(rows, "title string, form string, number int")


@query("chunk_pieces", rows_sql("chunk_index INT, title VARCHAR, title_level INT, heading_index INT, parent_index INT, start_line INT, end_line INT, is_table BOOLEAN, n_chars INT", [
    (0, None, None, -1, None, 1, 2, False, 22), (1, "A (Part 1)", 1, 0, None, 3, 5, False, 487), (2, "A (Part 2)", 1, 0, None, 6, 6, False, 241), (3, "B", 1, 1, None, 7, 10, True, 36), (4, "C", 1, 2, None, 11, 12, False, 3),
]))
def chunk_pieces(spark, sf):
    """The chunks of a made-up report: a preface, a long section in pieces, a table kept whole."""
    line = lambda c: ", ".join([c * 40] * 5 + [c * 31])
    text = "preface, a, b, c, d, e\n\n# A\n" + "\n".join(line(c) for c in "xyz") + "\n# B\n<table>\n<tr><td>1</td></tr>\n</table>\n# C\n"
    got = structure.chunk_rows(spark.createDataFrame([("d", "hk_stock", text)], "doc string, market string, text string"))
    return got.select("chunk_index", "title", "title_level", "heading_index", "parent_index", "start_line", "end_line", "is_table", F.length("chunk_text").alias("n_chars"))


@query("saved_chunks", rows_sql("doc VARCHAR, n INT, parent INT, text VARCHAR", [("d", 0, None, "one"), ("d", 1, 0, "three"), ("d", 2, None, "four"), ("e", 0, None, "x")]))
def saved_chunks(spark, sf):
    """Chunks numbered anew without the blank ones; a parent that is gone is none."""
    d = spark.createDataFrame([("d", 1, None, "one"), ("d", 2, 1, " "), ("d", 3, 1, "three"), ("d", 4, 2, "four"), ("e", 7, None, "x"), ("e", 8, None, None)], "doc string, n int, parent int, text string")
    return records.kept_and_linked(d, "doc", "n", "parent", "text").select("doc", F.col("n").cast("int").alias("n"), F.col("parent").cast("int").alias("parent"), "text")


@query("loaded_structures", rows_sql("id INT, title VARCHAR, level INT", [(1, "A", 1), (1, "B", 2), (2, "C", 1)]))
def loaded_structures(spark, sf):
    """Headings out of JSON that is a list or an object that wraps one."""
    d = spark.createDataFrame([(1, '[{"title": "A", "level": 1}, {"title": "B", "level": 2}]'), (2, '{"structure": [{"title": "C", "level": 1}]}'), (3, "no"), (4, None)], "id int, body string")
    return structure.loaded(d).select("id", "title", "level")


@query("chunking_outcomes", rows_sql("outcome VARCHAR, n BIGINT", [("chunked", 5), ("empty", 2), ("skipped", 1)]))
def chunking_outcomes(spark, sf):
    """What chunking does with every made-up report and one that has chunks already."""
    d = made_up(spark).withColumn("chunks_count", F.lit(0)).union(spark.createDataFrame([("old", "hk_stock", "text", 5)], "doc string, market string, text string, chunks_count int"))
    return structure.outcomes(d).groupBy("outcome").agg(F.count("*").alias("n"))


@query("quantiles_by_priority", """
SELECT o_orderpriority, count(*) AS n, round(percentile_cont(0.1) WITHIN GROUP (ORDER BY o_totalprice), 6) AS p10, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice), 6) AS p50, round(percentile_cont(0.99) WITHIN GROUP (ORDER BY o_totalprice), 6) AS p99 FROM orders GROUP BY 1""")
def quantiles_by_priority(spark, sf):
    """Exact quantiles of large groups without holding them."""
    q = stats.exact_quantiles(table(spark, sf, "orders", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice", p10=0.1, p50=0.5, p99=0.99)
    return q.select("o_orderpriority", "n", *(F.round(p, 6).alias(p) for p in ("p10", "p50", "p99")))


def queries():
    return query.queries


def oracle_sql():
    return query.sql
