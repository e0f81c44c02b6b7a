"""Queries over filings, their parsed versions, chunks and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.operators import lifecycle as L
from graniteflow.operators import stats
from graniteflow.operators.latest import current_chunks, id_key, newest_per_key
from graniteflow.sources.tables import table

SQL: dict[str, str] = {}
QUERIES = {}

# current rows of document_chunks, as DuckDB finds them
CUR = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(id)) ORDER BY ingested_at DESC) AS rn FROM document_chunks) WHERE rn = 1)"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


@query("scan_pending_documents", """
SELECT DISTINCT id, object_path, crawled_at FROM source_documents WHERE status IN ('crawled', 'parsed', 'processed')
AND regexp_matches(lower(object_path), '[.](pdf|html?)$')""")
def scan_pending(spark: SparkSession, sf: str) -> DataFrame:
    """All pending filings of a readable kind, oldest first."""
    docs = table(spark, sf, "source_documents", "id", "object_path", "crawled_at", "status")
    rows = docs.where(F.col("status").isin("crawled", "parsed", "processed")).drop("status").distinct()
    return L.limit_then_filter(rows, F.lit(True), 0, [F.col("crawled_at").asc_nulls_first(), F.col("id")], F.lower("object_path").rlike("[.](pdf|html?)$"))


@query("scan_unchunked_parses", """
SELECT p.id, p.document_id, d.stock_code, p.markdown_path
FROM parsed_documents p JOIN (SELECT DISTINCT id, stock_code FROM source_documents) d ON p.document_id = d.id
WHERE p.markdown_path <> '' AND p.chunks_count = 0""")
def scan_unchunked(spark, sf):
    """Parsed versions that have text but no chunks yet."""
    parsed = table(spark, sf, "parsed_documents", "id", "document_id", "markdown_path", "chunks_count")
    docs = table(spark, sf, "source_documents", "id", "stock_code").distinct().withColumnRenamed("id", "document_id")
    return parsed.where("markdown_path <> '' AND chunks_count = 0").join(docs, "document_id").select("id", "document_id", "stock_code", "markdown_path")


@query("scan_unvectorized_chunks", f"""
SELECT d.market, c.status, count(*) AS chunks, CAST(count_if(c.is_table) AS BIGINT) AS table_chunks
FROM {CUR} c JOIN (SELECT DISTINCT id, market FROM source_documents) d ON c.document_id = d.id
WHERE c.status IN ('pending', 'failed') GROUP BY ALL""")
def scan_unvectorized(spark, sf):
    """Chunks that still need a vector, failed ones included, with their number of tables."""
    chunks = current_chunks(table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "status", "is_table"), "document_id", "status", "is_table")
    docs = table(spark, sf, "source_documents", "id", "market").distinct().withColumnRenamed("id", "document_id")
    todo = chunks.where(F.col("status").isin("pending", "failed")).drop("id", "key").join(docs, "document_id")
    return todo.groupBy("market", "status").agg(F.count("*").alias("chunks"), F.count_if("is_table").alias("table_chunks"))


@query("scan_unindexed_chunks", f"""
SELECT c.id, c.chunk_index, d.stock_code, d.year, CAST(length(c.chunk_text) AS INTEGER) AS n_chars
FROM {CUR} c JOIN (SELECT DISTINCT id, stock_code, year FROM source_documents) d ON c.document_id = d.id
WHERE c.es_indexed_at IS NULL AND trim(c.chunk_text, ' ') <> ''""")
def scan_unindexed(spark, sf):
    """Chunks with text that the full-text index lacks, widened by columns of their filing."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "chunk_index", "es_indexed_at", "chunk_text")
    size = F.when(F.trim("chunk_text") != "", F.length("chunk_text")).alias("n_chars")
    docs = table(spark, sf, "source_documents", "id", "stock_code", "year").distinct().withColumnRenamed("id", "document_id")
    chunks = current_chunks(raw, "document_id", "chunk_index", "es_indexed_at", size).where("es_indexed_at IS NULL AND n_chars IS NOT NULL")
    return chunks.join(docs, "document_id").select("id", "chunk_index", "stock_code", "year", "n_chars")


@query("scan_chunked_not_graphed", f"""
SELECT DISTINCT id, crawled_at FROM source_documents s
WHERE EXISTS (SELECT 1 FROM document_chunks c WHERE c.document_id = s.id)
  AND s.id NOT IN (SELECT id FROM source_documents WHERE graphed_at IS NOT NULL)
ORDER BY crawled_at NULLS FIRST, id LIMIT 100""")
def scan_not_graphed(spark, sf):
    """Filings with chunks that are not in the graph yet; the limit comes after the exclusion."""
    docs = table(spark, sf, "source_documents", "id", "crawled_at", "graphed_at")
    chunks = table(spark, sf, "document_chunks", "document_id").withColumnRenamed("document_id", "id")
    rows = L.having(docs.select("id", "crawled_at").distinct(), chunks, docs.where("graphed_at IS NOT NULL"), "id")
    return L.first_n(rows, 100, F.col("crawled_at").asc_nulls_first(), F.col("id"))


@query("latest_parse_per_document", """
SELECT document_id, id, markdown_path, parsed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY parsed_at DESC NULLS LAST, id) AS rn
  FROM parsed_documents WHERE status = 'active') WHERE rn = 1""")
def latest_parse(spark, sf):
    """The newest active parse of every filing."""
    rows = table(spark, sf, "parsed_documents", "document_id", "id", "markdown_path", "parsed_at", "status").where("status = 'active'").drop("status")
    return newest_per_key(rows, ["document_id"], F.col("parsed_at").desc_nulls_last(), F.col("id"))


@query("latest_filing_per_company", """
SELECT stock_code, id, year, publish_date FROM (
  SELECT stock_code, id, year, publish_date, row_number() OVER (PARTITION BY stock_code ORDER BY year DESC, publish_date DESC NULLS LAST, id) AS rn
  FROM source_documents WHERE doc_type IN ('annual_reports', '10k')) WHERE rn = 1""")
def latest_filing(spark, sf):
    """The newest annual report of every company."""
    rows = table(spark, sf, "source_documents", "stock_code", "id", "year", "publish_date", "doc_type").where(F.col("doc_type").isin("annual_reports", "10k")).drop("doc_type")
    return newest_per_key(rows, ["stock_code"], F.desc("year"), F.col("publish_date").desc_nulls_last(), F.col("id"))


@query("filings_of_period", """
SELECT DISTINCT id, stock_code, year, quarter FROM source_documents
WHERE year = 2023 AND CASE WHEN doc_type IN ('annual_reports', '10k') THEN quarter IS NULL OR quarter = 4 ELSE quarter = 3 END""")
def filings_of_period(spark, sf):
    """Annual reports of a year, stored with quarter 4 or none, and third-quarter reports."""
    d = table(spark, sf, "source_documents", "id", "stock_code", "year", "quarter", "doc_type")
    annual = F.col("doc_type").isin("annual_reports", "10k")
    right = F.when(annual, F.col("quarter").isNull() | (F.col("quarter") == 4)).otherwise(F.col("quarter") == 3)
    return d.where((F.col("year") == 2023) & right).drop("doc_type").distinct()


@query("filings_by_code_ordered", """
SELECT * FROM (SELECT DISTINCT stock_code, year, quarter, id FROM source_documents)
ORDER BY stock_code, year DESC, quarter DESC NULLS FIRST, id LIMIT 120 OFFSET 30""")
def filings_by_code(spark, sf):
    """A page of the filings of all companies, newest period first, annual ones without quarter before."""
    d = table(spark, sf, "source_documents", "stock_code", "year", "quarter", "id").distinct()
    return L.first_n(d, 120, F.col("stock_code"), F.desc("year"), F.col("quarter").desc_nulls_first(), F.col("id"), offset=30)


@query("unique_by_source_url", """
SELECT id, source_url FROM (
  SELECT id, source_url, row_number() OVER (PARTITION BY nullif(trim(source_url, ' '), ''), CASE WHEN nullif(trim(source_url, ' '), '') IS NULL THEN id END ORDER BY created_at, id) AS rn
  FROM (SELECT DISTINCT id, source_url, created_at FROM source_documents)) WHERE rn = 1""")
def unique_url(spark, sf):
    """The first filing of every source address; those without an address all stay."""
    d = table(spark, sf, "source_documents", "id", "source_url", "created_at").distinct()
    address = F.nullif(F.trim("source_url"), F.lit(""))
    return L.unique_by(d, address, F.col("created_at"), F.col("id")).select("id", "source_url")


@query("duplicate_documents", "SELECT id, count(*) AS n_rows FROM source_documents GROUP BY id HAVING count(*) > 1")
def duplicate_documents(spark, sf):
    """Filings that were delivered more than once."""
    return L.duplicates(table(spark, sf, "source_documents", "id"), ["id"])


@query("duplicate_periods", """
SELECT stock_code, doc_type, year, coalesce(quarter, 4) AS period, count(DISTINCT id) AS filings FROM source_documents
WHERE doc_type <> 'ipo_prospectus' GROUP BY ALL HAVING count(DISTINCT id) > 1""")
def duplicate_periods(spark, sf):
    """Periods for which a company has several filings, quarter 4 and none being one."""
    d = table(spark, sf, "source_documents", "stock_code", "doc_type", "year", "quarter", "id").where("doc_type <> 'ipo_prospectus'")
    keyed = d.withColumn("period", F.coalesce("quarter", F.lit(4)))
    return keyed.groupBy("stock_code", "doc_type", "year", "period").agg(F.countDistinct("id").alias("filings")).where("filings > 1")


@query("orphan_vectors", """
SELECT DISTINCT chunk_id FROM chunk_vectors v
WHERE NOT EXISTS (SELECT 1 FROM document_chunks c WHERE lower(trim(c.id)) = lower(trim(v.chunk_id)))""")
def orphan_vectors(spark, sf):
    """Vectors of chunks that do not exist."""
    v = table(spark, sf, "chunk_vectors", "chunk_id").withColumn("key", id_key("chunk_id"))
    c = table(spark, sf, "document_chunks", "id").withColumn("k", id_key("id"))
    return L.orphans(v, c, "key", "k").select("chunk_id").distinct()


@query("redundant_vectors", """
SELECT chunk_id, inserted_at FROM (
  SELECT chunk_id, inserted_at, row_number() OVER (PARTITION BY lower(trim(chunk_id)) ORDER BY inserted_at DESC NULLS LAST) AS rn FROM chunk_vectors) WHERE rn > 1""")
def redundant_vectors(spark, sf):
    """Vectors that a newer one of the same chunk has made obsolete."""
    from pyspark.sql import Window

    v = table(spark, sf, "chunk_vectors", "chunk_id", "inserted_at")
    w = Window.partitionBy(id_key("chunk_id")).orderBy(F.col("inserted_at").desc_nulls_last())
    return v.withColumn("rn", F.row_number().over(w)).where("rn > 1").select("chunk_id", "inserted_at")


@query("missing_report_tasks", """
SELECT c.code, y.year, q.quarter, CASE q.quarter WHEN 4 THEN 'annual_reports' WHEN 2 THEN 'interim_reports' ELSE 'quarterly_reports' END AS doc_type
FROM (SELECT DISTINCT code FROM companies WHERE market = 'hs_stock') c, (SELECT unnest([2022, 2023]) AS year) y, (SELECT unnest([1, 2, 3, 4]) AS quarter) q
WHERE NOT EXISTS (SELECT 1 FROM source_documents s WHERE s.stock_code = c.code AND s.year = y.year AND s.quarter = q.quarter)""")
def missing_tasks(spark, sf):
    """Reports that every company should have and that are not there; a stored null quarter matches none."""
    companies = table(spark, sf, "companies", "code", "market").where("market = 'hs_stock'").select("code").distinct()
    slots = spark.createDataFrame([(y, q) for y in (2022, 2023) for q in (1, 2, 3, 4)], "year int, quarter int")
    done = table(spark, sf, "source_documents", F.col("stock_code").alias("code"), "year", "quarter")
    kind = F.when(F.col("quarter") == 4, "annual_reports").when(F.col("quarter") == 2, "interim_reports").otherwise("quarterly_reports")
    return L.missing_tasks(companies, slots, done, ["code", "year", "quarter"]).withColumn("doc_type", kind)


@query("hydrated_chunks", f"""
SELECT c.id, c.title, d.company_name, d.market, d.year FROM {CUR} c
JOIN (SELECT id, min(company_name) AS company_name, min(market) AS market, min(year) AS year FROM source_documents GROUP BY id) d ON c.document_id = d.id
WHERE c.is_table""")
def hydrated(spark, sf):
    """Table chunks with the columns of their filing."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "title", "is_table")
    docs = table(spark, sf, "source_documents", "id", "company_name", "market", "year").groupBy("id").agg(*(F.min(c).alias(c) for c in ("company_name", "market", "year")))
    chunks = current_chunks(raw, "document_id", "title", "is_table").where("is_table").withColumnRenamed("id", "chunk_id")
    return chunks.join(docs.withColumnRenamed("id", "document_id"), "document_id").select(F.col("chunk_id").alias("id"), "title", "company_name", "market", "year")


@query("event_fold", """
SELECT user_id, arg_max(event_type, (ts, event_id)) FILTER (value > 20) AS event_type, arg_max(value, (ts, event_id)) FILTER (value <= 20) AS small_value
FROM events GROUP BY user_id""")
def event_fold(spark, sf):
    """The state of every user after all events, each field from the last event that sets it."""
    e = table(spark, sf, "events", "user_id", "ts", "event_id", "event_type", "value")
    sparse = e.select("user_id", "ts", "event_id", F.when(F.col("value") > 20, F.col("event_type")).alias("event_type"), F.when(F.col("value") <= 20, F.col("value")).alias("small_value"))
    return L.fold(sparse, ["user_id"], [F.col("ts"), F.col("event_id")], ["event_type", "small_value"])


@query("company_upsert", """
SELECT coalesce(o.code, n.code) AS code, coalesce(n.name, o.name) AS name, coalesce(n.market, o.market) AS market
FROM (SELECT code, min(name) AS name, min(market) AS market FROM companies GROUP BY code) o
FULL JOIN (SELECT stock_code AS code, max(company_name) AS name, CAST(NULL AS VARCHAR) AS market FROM source_documents WHERE year >= 2024 GROUP BY stock_code) n ON o.code = n.code""")
def company_upsert(spark, sf):
    """Companies after the names of recent filings were written over them; a null market overwrites nothing."""
    old = table(spark, sf, "companies", "code", "name", "market").groupBy("code").agg(F.min("name").alias("name"), F.min("market").alias("market"))
    new = table(spark, sf, "source_documents", "stock_code", "company_name", "year").where("year >= 2024").groupBy(F.col("stock_code").alias("code"))
    return L.upsert(old, new.agg(F.max("company_name").alias("name"), F.lit(None).cast("string").alias("market")), ["code"], ["name", "market"])


@query("cascade_delete", f"""
WITH doomed AS (SELECT DISTINCT id AS document_id FROM source_documents WHERE status = 'failed')
SELECT 'parsed_documents' AS table_name, count(*) AS kept FROM parsed_documents WHERE document_id NOT IN (SELECT document_id FROM doomed)
UNION ALL SELECT 'document_chunks', count(*) FROM document_chunks WHERE document_id NOT IN (SELECT document_id FROM doomed)
UNION ALL SELECT 'chunk_vectors', count(*) FROM chunk_vectors WHERE document_id NOT IN (SELECT document_id FROM doomed)""")
def cascade_delete(spark, sf):
    """What is left of three tables after the failed filings and all that hangs on them were removed."""
    doomed = table(spark, sf, "source_documents", "id", "status").where("status = 'failed'").select(F.col("id").alias("document_id"))
    names = ("parsed_documents", "document_chunks", "chunk_vectors")
    left = L.without({n: table(spark, sf, n, "document_id") for n in names}, doomed, "document_id")
    counts = [df.agg(F.count("*").alias("kept")).select(F.lit(n).alias("table_name"), "kept") for n, df in left.items()]
    return counts[0].union(counts[1]).union(counts[2])


@query("mislabelled_parsed", """
SELECT DISTINCT id FROM source_documents s WHERE status IN ('parsed', 'processed', 'vectorized')
AND NOT EXISTS (SELECT 1 FROM parsed_documents p WHERE p.document_id = s.id AND p.status = 'active')""")
def mislabelled(spark, sf):
    """Filings said to be parsed that have no active parse."""
    docs = table(spark, sf, "source_documents", "id", "status").where(F.col("status").isin("parsed", "processed", "vectorized")).select("id").distinct()
    active = table(spark, sf, "parsed_documents", "document_id", "status").where("status = 'active'")
    return L.orphans(docs, active, "id", "document_id")


@query("status_counts", "SELECT market, status, count(*) AS n FROM source_documents GROUP BY ALL")
def status_counts(spark, sf):
    """Rows by market and status."""
    return table(spark, sf, "source_documents", "market", "status").groupBy("market", "status").agg(F.count("*").alias("n"))


@query("layer_coverage", f"""
SELECT market, count(*) AS total, count(crawled_at) AS crawled, count(parsed_at) AS parsed, count(vectorized_at) AS vectorized,
  round(count(crawled_at) / count(*), 6) AS crawled_rate, round(count(parsed_at) / count(*), 6) AS parsed_rate, round(count(vectorized_at) / count(*), 6) AS vectorized_rate
FROM source_documents GROUP BY market""")
def layer_coverage(spark, sf):
    """How far the filings of each market have come."""
    d = table(spark, sf, "source_documents", "market", "crawled_at", "parsed_at", "vectorized_at")
    return stats.coverage(d, ["market"], crawled=F.col("crawled_at").isNotNull(), parsed=F.col("parsed_at").isNotNull(), vectorized=F.col("vectorized_at").isNotNull())


@query("chunk_statistics", f"""
SELECT embedding_model, count(*) AS chunks, count(DISTINCT document_id) AS documents, CAST(count_if(is_table) AS BIGINT) AS tables,
  round(count(*) / count(DISTINCT document_id), 6) AS chunks_per_document FROM {CUR} GROUP BY embedding_model""")
def chunk_statistics(spark, sf):
    """Chunks, filings and tables by model."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "is_table", "embedding_model")
    by = current_chunks(raw, "document_id", "is_table", "embedding_model").groupBy("embedding_model")
    out = by.agg(F.count("*").alias("chunks"), F.countDistinct("document_id").alias("documents"), F.count_if("is_table").alias("tables"))
    return out.withColumn("chunks_per_document", F.round(stats.ratio(F.col("chunks"), F.col("documents")), 6))


@query("quality_gates", """
SELECT market, total, ok, CASE WHEN total = 0 THEN TRUE ELSE ok / total >= 0.8 END AS parse_passes, CASE WHEN total = 0 THEN FALSE ELSE ok / total >= 0.9 END AS index_passes
FROM (SELECT market, count(*) AS total, CAST(count_if(status IN ('parsed', 'processed', 'vectorized')) AS BIGINT) AS ok FROM source_documents GROUP BY market)""")
def quality_gates(spark, sf):
    """Whether the success rate of each market passes the two gates, which treat an empty run differently."""
    d = table(spark, sf, "source_documents", "market", "status").groupBy("market")
    n = d.agg(F.count("*").alias("total"), F.count_if(F.col("status").isin("parsed", "processed", "vectorized")).alias("ok"))
    return n.select("market", "total", "ok", stats.gate(F.col("total"), F.col("ok"), 0.8, True).alias("parse_passes"), stats.gate(F.col("total"), F.col("ok"), 0.9, False).alias("index_passes"))


@query("volume_deviation", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), m AS (SELECT avg(n) AS mean FROM d)
SELECT day, n, round(n / mean - 1, 6) AS deviation FROM d, m WHERE abs(n / mean - 1) > 0.05""")
def volume_deviation(spark, sf):
    """Days whose number of events departs from the mean of all days."""
    days = table(spark, sf, "events", "ts").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    mean = days.agg(F.avg("n").alias("mean"))  # one row
    off = days.crossJoin(F.broadcast(mean)).withColumn("d", F.col("n") / F.col("mean") - 1)
    return off.where(F.abs("d") > 0.05).select("day", "n", F.round("d", 6).alias("deviation"))


@query("chunk_size_audit", f"""
SELECT id, chunk_size, CAST(length(chunk_text) AS INTEGER) AS n_chars FROM {CUR} WHERE chunk_text IS NOT NULL AND chunk_size IS DISTINCT FROM length(chunk_text)""")
def chunk_size_audit(spark, sf):
    """Chunks whose stored size is not that of their text."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "chunk_size", "chunk_text")
    rows = current_chunks(raw, "chunk_size", F.length("chunk_text").alias("n_chars"))
    return rows.where("n_chars IS NOT NULL AND NOT (chunk_size <=> n_chars)").select("id", "chunk_size", "n_chars")


@query("stage_of_documents", """
SELECT stage, count(*) AS n FROM (SELECT CASE WHEN graphed_at IS NOT NULL THEN 'graphed' WHEN vectorized_at IS NOT NULL THEN 'vectorized' WHEN chunked_at IS NOT NULL THEN 'chunked'
 WHEN parsed_at IS NOT NULL THEN 'parsed' WHEN crawled_at IS NOT NULL THEN 'crawled' ELSE 'new' END AS stage FROM source_documents) GROUP BY stage""")
def stage_of_documents(spark, sf):
    """The last stage that each filing has reached by its timestamps."""
    stages = ("graphed", "vectorized", "chunked", "parsed", "crawled")
    d = table(spark, sf, "source_documents", *(f"{s}_at" for s in stages))
    stage = F.coalesce(*(F.when(F.col(f"{s}_at").isNotNull(), s) for s in stages), F.lit("new"))
    return d.groupBy(stage.alias("stage")).agg(F.count("*").alias("n"))


def queries():
    return QUERIES


def oracle_sql():
    return SQL
