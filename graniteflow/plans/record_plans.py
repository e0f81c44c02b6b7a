"""Look-ups, inserts, changes and quarantine of record tables, each over the whole set of keys that another table names."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.functions import paths
from graniteflow.functions.text import strip
from graniteflow.operators import lifecycle as L
from graniteflow.operators import records as R
from graniteflow.operators.latest import current_chunks, id_key, newest_per_key
from graniteflow.plans.fixture import Registry
from graniteflow.plans.lifecycle_plans import CUR
from graniteflow.sources.tables import table

query = Registry()


@query("documents_by_id", "SELECT DISTINCT id, stock_code, market, status FROM source_documents WHERE id IN (SELECT document_id FROM parsed_documents)")
def documents_by_id(spark, sf):
    """The filings that parsed versions name."""
    d = table(spark, sf, "source_documents", "id", "stock_code", "market", "status")
    return R.lookup(d, table(spark, sf, "parsed_documents", "document_id"), "id", "document_id").distinct()


@query("documents_by_path", "SELECT DISTINCT object_path, id FROM source_documents WHERE object_path IN (SELECT object_path FROM source_documents WHERE market = 'hk_stock')")
def documents_by_path(spark, sf):
    """The filings at some object paths."""
    d = table(spark, sf, "source_documents", "id", "object_path", "market")
    return R.lookup(d.drop("market"), d.where("market = 'hk_stock'"), "object_path", "object_path").distinct()


@query("parsed_by_id", "SELECT DISTINCT id, document_id, status FROM parsed_documents WHERE id IN (SELECT id FROM parsed_documents WHERE status <> 'active')")
def parsed_by_id(spark, sf):
    """Parsed versions by their id."""
    p = table(spark, sf, "parsed_documents", "id", "document_id", "status")
    return R.lookup(p, p.where("status <> 'active'"), "id", "id").distinct()


@query("chunk_by_id", f"""
SELECT c.id, c.document_id, c.chunk_index, coalesce(c.title, '') AS title, CAST(length(coalesce(c.chunk_text, '')) AS INTEGER) AS n_chars, c.title_level, coalesce(c.is_table, FALSE) AS is_table FROM {CUR} c
WHERE lower(trim(c.id)) IN (SELECT lower(trim(chunk_id)) FROM chunk_vectors WHERE lower(trim(chunk_id)) <> '')""")
def chunk_by_id(spark, sf):
    """The current chunks that vectors name, with defaults for null text and flag."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "chunk_index", "title", "chunk_text", "title_level", "is_table")
    c = current_chunks(raw, "document_id", "chunk_index", F.coalesce("title", F.lit("")).alias("title"), F.length(F.coalesce("chunk_text", F.lit(""))).alias("n_chars"), "title_level", F.coalesce("is_table", F.lit(False)).alias("is_table"))
    asked = table(spark, sf, "chunk_vectors", id_key("chunk_id").alias("key"))
    return R.lookup(c, asked, "key", "key").drop("key")


@query("company_by_code", "SELECT DISTINCT code, org_id, name FROM companies WHERE code IN (SELECT stock_code FROM source_documents)")
def company_by_code(spark, sf):
    """The companies whose codes filings name."""
    return R.lookup(table(spark, sf, "companies", "code", "org_id", "name"), table(spark, sf, "source_documents", "stock_code"), "code", "stock_code").distinct()


@query("company_by_org_id", "SELECT DISTINCT org_id, code, market FROM companies WHERE org_id IN (SELECT org_id FROM companies WHERE industry IS NULL)")
def company_by_org_id(spark, sf):
    """Companies by their identifier."""
    c = table(spark, sf, "companies", "org_id", "code", "market", "industry")
    return R.lookup(c.drop("industry"), c.where("industry IS NULL"), "org_id", "org_id").distinct()


@query("hk_company_by_code", "SELECT DISTINCT code, name FROM companies WHERE market = 'hk_stock' AND code IN (SELECT stock_code FROM document_chunks)")
def hk_company_by_code(spark, sf):
    """The companies of one market whose codes chunks name."""
    c = table(spark, sf, "companies", "code", "name", "market").where("market = 'hk_stock'").drop("market")
    return R.lookup(c, table(spark, sf, "document_chunks", "stock_code"), "code", "stock_code").distinct()


@query("hk_companies_page", "SELECT code, org_id FROM (SELECT DISTINCT code, org_id FROM companies WHERE market = 'hk_stock' AND org_id IS NOT NULL) ORDER BY code, org_id LIMIT 25 OFFSET 5")
def hk_companies_page(spark, sf):
    """A page of one market's companies that have an identifier."""
    c = table(spark, sf, "companies", "code", "org_id", "market").where("market = 'hk_stock' AND org_id IS NOT NULL").select("code", "org_id").distinct()
    return L.first_n(c, 25, F.col("code"), F.col("org_id"), offset=5)


@query("companies_without_value", "SELECT 'org_id' AS missing, code, name FROM companies WHERE org_id IS NULL OR trim(org_id, ' ') = '' UNION ALL SELECT 'pre_name', code, name FROM companies WHERE pre_name IS NULL OR trim(pre_name, ' ') = ''")
def companies_without_value(spark, sf):
    """Companies that lack an identifier or a former name, one pass over the table."""
    c = table(spark, sf, "companies", "code", "name", "org_id", "pre_name")
    lacks = F.array_compact(F.array(*(F.when(F.coalesce(F.trim(n), F.lit("")) == "", F.lit(n)) for n in ("org_id", "pre_name"))))
    return c.select(F.explode(lacks).alias("missing"), "code", "name")


@query("company_lists", """
WITH c AS (SELECT code, min(name) AS name, market FROM companies WHERE code IS NOT NULL GROUP BY code, market)
SELECT 'all' AS asked, code, name FROM (SELECT * FROM c WHERE market = 'hs_stock' ORDER BY code LIMIT 15)
UNION ALL SELECT 'listed', code, name FROM c WHERE market = 'hk_stock' AND code IN (SELECT stock_code FROM source_documents WHERE doc_type = 'annual_reports')""")
def company_lists(spark, sf):
    """What a job takes: the first companies where no codes are given, all with a code on the list where they are, none for an empty list."""
    c = table(spark, sf, "companies", "code", "name", "market").where("code IS NOT NULL").groupBy("code", "market").agg(F.min("name").alias("name"))
    listed = table(spark, sf, "source_documents", "stock_code", "doc_type").where("doc_type = 'annual_reports'").select(F.col("stock_code").alias("code"))
    parts = [("all", L.targets(c.where("market = 'hs_stock'"), None, 15)), ("listed", L.targets(c.where("market = 'hk_stock'"), listed, 15)), ("empty", L.targets(c, listed.limit(0), 15))]
    out = None
    for name, df in parts:
        part = df.select(F.lit(name).alias("asked"), "code", "name")
        out = part if out is None else out.union(part)
    return out


# ---- quarantine, logs, tasks: record tables made of what filings and parses show

RULES_SQL = "CASE WHEN NOT coalesce(object_path <> '', FALSE) THEN 'no_path' WHEN NOT coalesce(file_size >= 1024, FALSE) THEN 'too_small' WHEN NOT coalesce(error_message IS NULL, FALSE) THEN 'error' END"
JUDGED = f"(SELECT DISTINCT id, object_path, market, status, crawled_at, {RULES_SQL} AS reason FROM source_documents)"
RECORDS = f"""(SELECT md5('quarantine|' || id) AS record_id, id AS document_id, stage, reason, object_path, copied, CASE WHEN copied THEN concat_ws('/', 'quarantine', reason, object_path) END AS quarantine_path FROM (
  SELECT id, CASE WHEN status IN ('crawled', 'parsed') THEN status ELSE 'validation_failed' END AS stage, reason, object_path, coalesce(object_path <> '', FALSE) AS copied,
    row_number() OVER (PARTITION BY id ORDER BY reason, object_path NULLS FIRST) AS rn FROM {JUDGED} WHERE reason IS NOT NULL) WHERE rn = 1)"""


def judged(spark, sf):
    d = table(spark, sf, "source_documents", "id", "object_path", "market", "status", "crawled_at", "file_size", "error_message").distinct()
    return R.judged(d, {"no_path": F.col("object_path") != "", "too_small": F.col("file_size") >= 1024, "error": F.col("error_message").isNull()})


def quarantine(spark, sf):
    rows = judged(spark, sf).withColumnRenamed("id", "document_id")
    return R.set_aside(rows, "document_id", "object_path", F.col("status"), ("crawled", "parsed"), "validation_failed")


@query("crawl_validation", f"SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM {JUDGED} GROUP BY 1")
def crawl_validation(spark, sf):
    """How many filings pass the rules of a crawl result, and what the others break first."""
    return judged(spark, sf).select("id", "object_path", "market", "status", "crawled_at", "reason").distinct().groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))


@query("quarantine_records", f"SELECT record_id, document_id, stage, reason, object_path, quarantine_path, copied, 'pending' AS status FROM {RECORDS}")
def quarantine_records(spark, sf):
    """One record for every filing that breaks a rule, with its place in quarantine if it has a file."""
    return quarantine(spark, sf)


@query("quarantine_pending", f"SELECT record_id, document_id, reason FROM {RECORDS} WHERE stage = 'validation_failed' ORDER BY document_id LIMIT 40")
def quarantine_pending(spark, sf):
    """The first pending records of a stage."""
    return L.first_n(quarantine(spark, sf).where("status = 'pending' AND stage = 'validation_failed'"), 40, F.col("document_id")).select("record_id", "document_id", "reason")


@query("quarantine_by_id", f"SELECT record_id, document_id, stage FROM {RECORDS} WHERE record_id IN (SELECT md5('quarantine|' || document_id) FROM parsed_documents)")
def quarantine_by_id(spark, sf):
    """Records by their id."""
    asked = table(spark, sf, "parsed_documents", F.md5(F.concat(F.lit("quarantine|"), "document_id")).alias("record_id"))
    return R.lookup(quarantine(spark, sf), asked, "record_id", "record_id").select("record_id", "document_id", "stage")


@query("quarantine_statistics", f"""
SELECT 'stage' AS kind, stage AS name, count(*) AS n FROM {RECORDS} GROUP BY stage UNION ALL SELECT 'total', 'all', count(*) FROM {RECORDS} UNION ALL SELECT 'warning', CASE WHEN count(*) > 100 THEN 'yes' ELSE 'no' END, count(*) FROM {RECORDS}""")
def quarantine_statistics(spark, sf):
    """Pending records by stage, in all, and whether they are more than 100; one pass, then a handful of rows."""
    per = quarantine(spark, sf).where("status = 'pending'").groupBy("stage").agg(F.count("*").alias("n"))
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return per.select(F.lit("stage").alias("kind"), F.col("stage").alias("name"), "n").union(total.select(F.lit("total"), F.lit("all"), "n")).union(total.select(F.lit("warning"), F.when(F.col("n") > 100, "yes").otherwise("no"), "n"))


ACTION_SQL = "CASE reason WHEN 'no_path' THEN 'discard' WHEN 'too_small' THEN 're_crawl' WHEN 'error' THEN 'restore' END"


@query("quarantine_resolved", f"""
SELECT record_id, CASE {ACTION_SQL} WHEN 'discard' THEN 'discarded' ELSE 'resolved' END AS status, CASE {ACTION_SQL} WHEN 'discard' THEN 'discarded' WHEN 'restore' THEN 'crawled' END AS document_status,
  {ACTION_SQL} = 're_crawl' AS removed, CASE WHEN {ACTION_SQL} = 'restore' THEN quarantine_path END AS copy_back FROM {RECORDS}""")
def quarantine_resolved(spark, sf):
    """Records after decisions: restored to their path, crawled anew, or discarded."""
    q = quarantine(spark, sf)
    action = F.when(F.col("reason") == "no_path", "discard").when(F.col("reason") == "too_small", "re_crawl").otherwise("restore")
    return R.resolved(q, q.select("record_id", action.alias("action"))).select("record_id", "status", "document_status", "removed", "copy_back")


@query("recrawled_documents", f"SELECT DISTINCT id FROM source_documents WHERE id NOT IN (SELECT document_id FROM {RECORDS} WHERE {ACTION_SQL} = 're_crawl')")
def recrawled_documents(spark, sf):
    """The filings that stay when those to be crawled anew have lost their rows."""
    gone = quarantine(spark, sf).where("reason = 'too_small'").select("document_id")
    return L.orphans(table(spark, sf, "source_documents", "id").distinct(), gone, "id", "document_id")


@query("validation_logs", f"""
SELECT document_id, rule, passed, CAST(row_number() OVER (PARTITION BY document_id ORDER BY t NULLS FIRST, rule) - 1 AS INTEGER) AS place FROM (
  SELECT DISTINCT id AS document_id, crawled_at AS t, unnest(['no_path', 'too_small', 'error']) AS rule,
    unnest([coalesce(object_path <> '', FALSE), coalesce(file_size >= 1024, FALSE), error_message IS NULL]) AS passed FROM source_documents)""")
def validation_logs(spark, sf):
    """The log of every filing: one row a rule, in order of time."""
    d = table(spark, sf, "source_documents", "id", "crawled_at", "object_path", "file_size", "error_message")
    tests = {"no_path": F.col("object_path") != "", "too_small": F.col("file_size") >= 1024, "error": F.col("error_message").isNull()}
    logs = F.array(*(F.struct(F.lit(n).alias("rule"), F.coalesce(t, F.lit(False)).alias("passed")) for n, t in tests.items()))
    rows = d.select(F.col("id").alias("document_id"), F.col("crawled_at").alias("at"), F.explode(logs).alias("x")).select("document_id", "at", "x.rule", "x.passed").distinct()
    return R.numbered(rows, "document_id", [F.col("at").asc_nulls_first(), F.col("rule")]).drop("at")


@query("tasks_pending", """
SELECT task_id, document_id FROM (SELECT DISTINCT md5('vectorize|' || id) AS task_id, id AS document_id, created_at FROM source_documents WHERE vectorized_at IS NULL AND object_path <> '')
ORDER BY created_at NULLS FIRST, task_id LIMIT 60""")
def tasks_pending(spark, sf):
    """The oldest pending tasks of a step: filings that have a file and not been through it."""
    d = table(spark, sf, "source_documents", "id", "created_at", "vectorized_at", "object_path").where("vectorized_at IS NULL AND object_path <> ''")
    rows = d.select(F.md5(F.concat(F.lit("vectorize|"), "id")).alias("task_id"), F.col("id").alias("document_id"), "created_at").distinct()
    return L.first_n(rows, 60, F.col("created_at").asc_nulls_first(), F.col("task_id")).drop("created_at")


# ---- changes

@query("status_changes", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, CAST(count_if(event_type = 'error') AS BIGINT) AS retries, CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'failed' END AS error,
  min(ts) FILTER (event_type IN ('signup', 'view')) AS started_at, max(ts) FILTER (event_type = 'purchase') AS ended_at FROM events GROUP BY user_id""")
def status_changes(spark, sf):
    """State of records after all their changes: errors count retries and are cleared by what follows, start and end are stamped."""
    e = table(spark, sf, "events", "user_id", "ts", "event_id", "event_type").withColumn("error", F.when(F.col("event_type") == "error", "failed"))
    return R.changed(e, "user_id", [F.col("ts"), F.col("event_id")], "event_type", "error", ["signup", "view"], ["purchase"], "ts")


@query("task_durations", """
SELECT user_id, CAST(epoch(max(ts) FILTER (event_type = 'purchase')) - epoch(min(ts) FILTER (event_type IN ('signup', 'view'))) AS BIGINT) AS seconds FROM events GROUP BY user_id
HAVING max(ts) FILTER (event_type = 'purchase') >= min(ts) FILTER (event_type IN ('signup', 'view'))""")
def task_durations(spark, sf):
    """Seconds from the first start to the last end of each record that has both in this order."""
    done = status_changes(spark, sf).where("ended_at >= started_at")
    seconds = (F.unix_micros(F.col("ended_at").cast("timestamp")) / 1e6).cast("double") - (F.unix_micros(F.col("started_at").cast("timestamp")) / 1e6).cast("double")
    return done.select("user_id", F.round(seconds).cast("bigint").alias("seconds"))


@query("archived_versions", """
SELECT document_id, id, CASE WHEN rn = 1 THEN status ELSE 'archived' END AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY status = 'active' DESC, parsed_at DESC NULLS LAST, id) AS rn FROM (SELECT DISTINCT document_id, id, status, parsed_at FROM parsed_documents))""")
def archived_versions(spark, sf):
    """Parsed versions with all but the newest active one archived."""
    p = table(spark, sf, "parsed_documents", "document_id", "id", "status", "parsed_at").distinct()
    n = R.numbered(p, "document_id", [(F.col("status") == "active").desc(), F.col("parsed_at").desc_nulls_last(), F.col("id")])
    return n.select("document_id", "id", F.when(F.col("place") == 0, F.col("status")).otherwise("archived").alias("status"))


@query("chunk_info_updates", """
SELECT p.id, coalesce(c.n, p.chunks_count) AS chunks_count, coalesce(CASE WHEN c.n > 0 AND p.markdown_path <> '' THEN regexp_replace(p.markdown_path, '[^/]+$', 'chunks.json') END, '') AS chunks_path
FROM (SELECT DISTINCT id, document_id, markdown_path, chunks_count FROM parsed_documents) p LEFT JOIN (SELECT document_id, CAST(count(DISTINCT lower(trim(id))) AS INTEGER) AS n FROM document_chunks GROUP BY 1) c ON c.document_id = p.document_id""")
def chunk_info_updates(spark, sf):
    """Parsed versions with the number of chunks that there are, where there are any, and the place of the chunks."""
    p = table(spark, sf, "parsed_documents", "id", "document_id", "markdown_path", "chunks_count").distinct()
    n = table(spark, sf, "document_chunks", "document_id", id_key("id").alias("key")).groupBy("document_id").agg(F.countDistinct("key").cast("int").alias("n"))
    path = F.when((F.col("n") > 0) & (F.col("markdown_path") != ""), paths.sibling(F.col("markdown_path"), "chunks.json"))
    return p.join(n, "document_id", "left").select("id", F.coalesce("n", "chunks_count").alias("chunks_count"), F.coalesce(path, F.lit("")).alias("chunks_path"))


@query("cleared_companies", "SELECT org_id, code, '' AS name, CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS INTEGER) AS staff_num FROM companies")
def cleared_companies(spark, sf):
    """Companies before a fresh load: only their keys are left."""
    return R.cleared(table(spark, sf, "companies", "org_id", "code", "name", "industry", "staff_num"), ["org_id", "code"], ["name"])


@query("org_id_updates", """
SELECT c.code, c.market, coalesce(u.new_id, c.org_id) AS org_id FROM (SELECT DISTINCT code, market, org_id FROM companies) c
LEFT JOIN (SELECT stock_code AS code, max(market) || '-' || stock_code AS new_id FROM source_documents WHERE market = 'hk_stock' GROUP BY stock_code) u ON u.code = c.code""")
def org_id_updates(spark, sf):
    """Companies with the identifiers that another source has for their codes."""
    c = table(spark, sf, "companies", "code", "market", "org_id").distinct()
    u = table(spark, sf, "source_documents", "stock_code", "market").where("market = 'hk_stock'").groupBy(F.col("stock_code").alias("code")).agg(F.max("market").alias("m"))
    return c.join(u.select("code", F.concat_ws("-", "m", "code").alias("new_id")), "code", "left").select("code", "market", F.coalesce("new_id", "org_id").alias("org_id"))


@query("document_inserts", """
SELECT id, stock_code, url FROM (
  SELECT id, stock_code, coalesce(nullif(trim(source_url, ' '), ''), nullif(trim(object_path, ' '), '')) AS url, row_number() OVER (PARTITION BY id ORDER BY created_at NULLS FIRST, object_path NULLS FIRST, source_url NULLS FIRST) AS rn FROM source_documents
  WHERE id NOT IN (SELECT document_id FROM parsed_documents)) WHERE rn = 1""")
def document_inserts(spark, sf):
    """The filings that a table of those parsed would gain, each once, with the first address that is filled."""
    d = table(spark, sf, "source_documents", "id", "stock_code", "source_url", "object_path", "created_at")
    new = R.inserted(table(spark, sf, "parsed_documents", F.col("document_id").alias("id")), d, "id", F.col("created_at").asc_nulls_first(), F.col("object_path").asc_nulls_first(), F.col("source_url").asc_nulls_first())
    return new.select("id", "stock_code", R.first_filled(F.col("source_url"), F.col("object_path")).alias("url"))


@query("chunk_inserts", f"""
SELECT document_id, id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY chunk_index NULLS LAST, id) - 1 AS INTEGER) AS place FROM {CUR} WHERE chunk_text IS NOT NULL AND regexp_replace(chunk_text, '\\s|\u3000|\u00a0', '', 'g') <> ''""")
def chunk_inserts(spark, sf):
    """Chunks with text as they would be saved: numbered anew within their filing."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "chunk_index", "chunk_text")
    c = current_chunks(raw, "document_id", "chunk_index", (strip(F.col("chunk_text")) != "").alias("filled")).where("filled")
    return R.numbered(c, "document_id", [F.col("chunk_index").asc_nulls_last(), F.col("id")]).select("document_id", "id", F.col("place").cast("int").alias("place"))


# ---- images

IMAGES = """(SELECT DISTINCT md5(id || '|' || k) AS image_id, id AS parsed_document_id, document_id, CAST(k AS INTEGER) AS image_index, regexp_replace(markdown_path, '[^/]+$', 'images/' || k || '.png') AS filename
  FROM (SELECT DISTINCT id, document_id, markdown_path, unnest(range(images_count)) AS k FROM parsed_documents WHERE images_count > 0 AND markdown_path <> ''))"""


def images(spark, sf):
    p = table(spark, sf, "parsed_documents", "id", "document_id", "markdown_path", "images_count").where("images_count > 0 AND markdown_path <> ''").distinct()
    each = p.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("images_count") - 1)))
    name = F.regexp_replace(F.col("markdown_path"), F.lit("[^/]+$"), F.concat(F.lit("images/"), F.col("k").cast("string"), F.lit(".png")))
    return each.select(F.md5(F.concat_ws("|", "id", "k")).alias("image_id"), F.col("id").alias("parsed_document_id"), "document_id", F.col("k").alias("image_index"), name.alias("filename")).distinct()


@query("image_records", f"SELECT * FROM {IMAGES}")
def image_records(spark, sf):
    """A row for every image of a parsed version."""
    return images(spark, sf)


@query("images_of_parsed", f"SELECT parsed_document_id, image_id, image_index FROM {IMAGES} WHERE parsed_document_id IN (SELECT id FROM parsed_documents WHERE status = 'active')")
def images_of_parsed(spark, sf):
    """The images of active versions."""
    asked = table(spark, sf, "parsed_documents", "id", "status").where("status = 'active'")
    return R.lookup(images(spark, sf), asked, "parsed_document_id", "id").select("parsed_document_id", "image_id", "image_index")


@query("images_of_documents", f"SELECT document_id, count(*) AS n, min(image_id) AS first_id FROM {IMAGES} WHERE document_id IN (SELECT id FROM source_documents) GROUP BY document_id")
def images_of_documents(spark, sf):
    """The images of filings over all their versions."""
    return R.lookup(images(spark, sf), table(spark, sf, "source_documents", "id"), "document_id", "id").groupBy("document_id").agg(F.count("*").alias("n"), F.min("image_id").alias("first_id"))


@query("image_by_id", f"SELECT image_id, filename FROM {IMAGES} WHERE image_id IN (SELECT md5(id || '|0') FROM parsed_documents)")
def image_by_id(spark, sf):
    """Images by their id."""
    asked = table(spark, sf, "parsed_documents", F.md5(F.concat("id", F.lit("|0"))).alias("image_id"))
    return R.lookup(images(spark, sf), asked, "image_id", "image_id").select("image_id", "filename")


@query("image_backfill", f"SELECT i.image_id, i.parsed_document_id FROM {IMAGES} i WHERE parsed_document_id NOT IN (SELECT id FROM parsed_documents WHERE status = 'active')")
def image_backfill(spark, sf):
    """Image rows that versions lack, out of what is listed for them, where only active versions have had theirs made."""
    have = table(spark, sf, "parsed_documents", "id", "status").where("status = 'active'")
    return L.orphans(images(spark, sf), have, "parsed_document_id", "id").select("image_id", "parsed_document_id")


NOTES = "(SELECT event_id, user_id AS image_id, CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' ELSE 'draft' END AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS version FROM events)"


def notes(spark, sf):
    e = table(spark, sf, "events", "event_id", "user_id", "event_type", "ts")
    status = F.when(F.col("event_type") == "purchase", "approved").when(F.col("event_type") == "error", "rejected").otherwise("draft")
    return R.numbered(e, "user_id", [F.col("ts"), F.col("event_id")], 1).select("event_id", F.col("user_id").alias("image_id"), status.alias("status"), F.col("place").alias("version"))


@query("annotation_versions", f"SELECT image_id, event_id, status, CAST(version AS INTEGER) AS version FROM {NOTES}")
def annotation_versions(spark, sf):
    """Annotations with their version: the next after the largest of their image, in order of time."""
    return notes(spark, sf)


@query("latest_annotation", f"SELECT image_id, event_id, CAST(version AS INTEGER) AS version FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY version DESC) AS rn FROM {NOTES} WHERE status = 'approved') WHERE rn = 1")
def latest_annotation(spark, sf):
    """The highest approved version of each image."""
    return newest_per_key(notes(spark, sf).where("status = 'approved'"), ["image_id"], F.desc("version")).select("image_id", "event_id", "version")


@query("artifact_paths", """
SELECT DISTINCT id, unnest(list_distinct(list_filter([nullif(object_path, ''), nullif(markdown_path, ''), regexp_replace(nullif(markdown_path, ''), '[^/]+$', 'structure.json'), regexp_replace(nullif(markdown_path, ''), '[^/]+$', 'chunks.json'),
  regexp_replace(nullif(markdown_path, ''), '[^/]+$', 'content_list.json'), regexp_replace(nullif(markdown_path, ''), '[^/]+$', 'images/')], lambda x: x IS NOT NULL))) AS path
FROM (SELECT DISTINCT d.id, d.object_path, p.markdown_path FROM source_documents d JOIN parsed_documents p ON p.document_id = d.id)""")
def artifact_paths(spark, sf):
    """All objects that go when a filing goes."""
    d = table(spark, sf, "source_documents", "id", "object_path").distinct()
    p = table(spark, sf, "parsed_documents", F.col("document_id").alias("id"), "markdown_path").distinct()
    return d.join(p, "id").select("id", F.explode(paths.artifacts(F.col("object_path"), F.col("markdown_path"))).alias("path")).distinct()


# ---- repair

@query("unparsed_documents", """
SELECT id, created_at FROM (SELECT DISTINCT id, created_at FROM source_documents WHERE id NOT IN (SELECT document_id FROM parsed_documents)) ORDER BY created_at NULLS FIRST, id LIMIT 500""")
def unparsed_documents(spark, sf):
    """The oldest filings without any parse."""
    d = table(spark, sf, "source_documents", "id", "created_at").distinct()
    return L.first_n(L.orphans(d, table(spark, sf, "parsed_documents", "document_id"), "id", "document_id"), 500, F.col("created_at").asc_nulls_first(), F.col("id"))


@query("without_unparsed", "SELECT status, count(*) AS n FROM source_documents WHERE id IN (SELECT document_id FROM parsed_documents) GROUP BY status")
def without_unparsed(spark, sf):
    """What is left, by status, when filings without a parse are deleted."""
    d = table(spark, sf, "source_documents", "id", "status")
    gone = L.orphans(d.select("id").distinct(), table(spark, sf, "parsed_documents", "document_id"), "id", "document_id")
    return L.without({"source_documents": d}, gone, "id")["source_documents"].groupBy("status").agg(F.count("*").alias("n"))


@query("chunk_rollback", """
WITH last AS (SELECT max(chunked_at) AS t FROM source_documents), doomed AS (SELECT DISTINCT id FROM source_documents, last WHERE chunked_at >= t - INTERVAL 72 HOUR)
SELECT (SELECT count(*) FROM doomed) AS documents, (SELECT count(*) FROM document_chunks WHERE document_id IN (SELECT id FROM doomed)) AS chunks, (SELECT count(*) FROM document_chunks WHERE document_id IS NULL OR document_id NOT IN (SELECT id FROM doomed)) AS kept""")
def chunk_rollback(spark, sf):
    """What undoing the chunking of the last 72 hours before the newest would take and leave."""
    d = table(spark, sf, "source_documents", "id", "chunked_at").where("chunked_at IS NOT NULL")
    last = d.agg(F.max("chunked_at").alias("t"))  # one row
    doomed = d.crossJoin(F.broadcast(last)).where(F.col("chunked_at") >= F.col("t") - F.expr("INTERVAL 72 HOURS")).select("id").distinct().withColumn("hit", F.lit(True))
    c = table(spark, sf, "document_chunks", "document_id").groupBy("document_id").agg(F.count("*").alias("n"))
    met = c.join(doomed, F.col("document_id") == F.col("id"), "left")
    sums = met.agg(F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("chunks"), F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("n"))), F.lit(0)).alias("kept"))
    return doomed.agg(F.count("*").alias("documents")).crossJoin(F.broadcast(sums))


@query("incomplete_documents", """
SELECT DISTINCT id, CASE WHEN coalesce(object_path, '') = '' THEN 'no path' WHEN file_size IS NULL THEN 'no object' WHEN file_size < 1024 THEN 'too small' ELSE 'kind' END AS reason FROM source_documents
WHERE coalesce(object_path, '') = '' OR file_size IS NULL OR file_size < 1024 OR NOT regexp_matches(lower(object_path), '[.](pdf|html?)$')""")
def incomplete_documents(spark, sf):
    """Filings whose object cannot be whole, with the first reason."""
    d = table(spark, sf, "source_documents", "id", "object_path", "file_size")
    rules = {"no path": F.coalesce("object_path", F.lit("")) != "", "no object": F.col("file_size").isNotNull(), "too small": F.col("file_size") >= 1024, "kind": F.lower("object_path").rlike("[.](pdf|html?)$")}
    return R.judged(d, rules).where("reason IS NOT NULL").select("id", "reason").distinct()


@query("status_audit", """
SELECT count(*) AS total, count(status) AS filled, count(*) - count(status) AS missing, CAST(count_if(status = 'vectorized' AND vectorized_at IS NULL) AS BIGINT) AS unstamped FROM document_chunks""")
def status_audit(spark, sf):
    """How far a status column is filled, and where it contradicts its time."""
    c = table(spark, sf, "document_chunks", "status", "vectorized_at")
    return c.agg(F.count("*").alias("total"), F.count("status").alias("filled"), (F.count("*") - F.count("status")).alias("missing"), F.count_if((F.col("status") == "vectorized") & F.col("vectorized_at").isNull()).alias("unstamped"))


def queries():
    return query.queries


def oracle_sql():
    return query.sql
