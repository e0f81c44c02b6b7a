"""Look-ups, pages and existence checks, set-wise: many keys in one join instead of one query a key."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators import lifecycle as L
from graniteflow.operators.latest import current_chunks, newest_per_key
from graniteflow.session import ensure_checkpoint_dir
from graniteflow.sources.tables import table
from graniteflow.streaming import incremental

SQL: dict[str, str] = {}
QUERIES = {}
CUR = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(id)) ORDER BY ingested_at DESC) AS rn FROM document_chunks) WHERE rn = 1)"


def query(name, sql=None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


@query("documents_by_url", """
SELECT DISTINCT s.id, trim(s.source_url, ' ') AS url FROM source_documents s JOIN (SELECT DISTINCT trim(source_url, ' ') AS u FROM source_documents WHERE market = 'us_stock' AND trim(source_url, ' ') <> '') q ON trim(s.source_url, ' ') = q.u""")
def documents_by_url(spark, sf):
    """Filings found by trimmed source addresses; blank addresses find nothing."""
    d = table(spark, sf, "source_documents", "id", "market", F.trim("source_url").alias("url"))
    asked = d.where("market = 'us_stock' AND url <> ''").select("url").distinct()
    return d.join(asked, "url", "left_semi").select("id", "url").distinct()


@query("document_for_task", """
SELECT stock_code, market, doc_type, id FROM (
  SELECT stock_code, market, doc_type, id, row_number() OVER (PARTITION BY stock_code, market, doc_type ORDER BY created_at DESC NULLS LAST, id) AS rn FROM (SELECT DISTINCT stock_code, market, doc_type, id, created_at FROM source_documents)) WHERE rn = 1""")
def document_for_task(spark, sf):
    """The newest filing of every code, market and type."""
    d = table(spark, sf, "source_documents", "stock_code", "market", "doc_type", "id", "created_at").distinct()
    return newest_per_key(d, ["stock_code", "market", "doc_type"], F.col("created_at").desc_nulls_last(), F.col("id")).drop("created_at")


@query("chunks_of_documents", f"""
SELECT document_id, id, chunk_index, coalesce(chunk_text, '') <> '' AS has_text, coalesce(is_table, FALSE) AS is_table FROM {CUR}
WHERE document_id IN (SELECT id FROM source_documents WHERE doc_type = '10k')""")
def chunks_of_documents(spark, sf):
    """The chunks of some filings with defaults for what is null."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "document_id", "chunk_index", "chunk_text", "is_table")
    has = (F.coalesce("chunk_text", F.lit("")) != "").alias("has_text")
    c = current_chunks(raw, "document_id", "chunk_index", has, F.coalesce("is_table", F.lit(False)).alias("is_table"))
    asked = table(spark, sf, "source_documents", "id", "doc_type").where("doc_type = '10k'").select(F.col("id").alias("document_id"))
    return c.join(asked, "document_id", "left_semi").select("document_id", "id", "chunk_index", "has_text", "is_table")


@query("companies_page", "SELECT code, name FROM (SELECT DISTINCT code, name FROM companies WHERE industry = 'energy') ORDER BY code, name LIMIT 20 OFFSET 10")
def companies_page(spark, sf):
    """A page of the companies of an industry in order of code."""
    c = table(spark, sf, "companies", "code", "name", "industry").where("industry = 'energy'").select("code", "name").distinct()
    return L.first_n(c, 20, F.col("code"), F.col("name"), offset=10)


@query("companies_with_filings", """
SELECT code, count(DISTINCT id) AS filings FROM companies JOIN source_documents ON stock_code = code GROUP BY code""")
def companies_with_filings(spark, sf):
    """Companies that have filings, and how many; filings are counted before the join."""
    n = table(spark, sf, "source_documents", "stock_code", "id").groupBy(F.col("stock_code").alias("code")).agg(F.countDistinct("id").alias("filings"))
    return table(spark, sf, "companies", "code").distinct().join(n, "code")


@query("companies_without_filings", "SELECT code FROM companies WHERE code IS NOT NULL EXCEPT SELECT stock_code FROM source_documents")
def companies_without_filings(spark, sf):
    """Companies that no filing names."""
    c = table(spark, sf, "companies", "code").where("code IS NOT NULL").distinct()
    return L.orphans(c, table(spark, sf, "source_documents", "stock_code"), "code", "stock_code")


@query("parse_versions", """
SELECT document_id, id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY parsed_at NULLS FIRST, id) AS INTEGER) AS version, status = 'active' AS active FROM (SELECT DISTINCT document_id, id, parsed_at, status FROM parsed_documents)""")
def parse_versions(spark, sf):
    """Parsed versions of each filing, numbered from the oldest."""
    from pyspark.sql import Window

    p = table(spark, sf, "parsed_documents", "document_id", "id", "parsed_at", "status").distinct()
    w = Window.partitionBy("document_id").orderBy(F.col("parsed_at").asc_nulls_first(), "id")
    return p.select("document_id", "id", F.row_number().over(w).alias("version"), (F.col("status") == "active").alias("active"))


@query("existence_of_documents", """
SELECT DISTINCT v.document_id, s.id IS NOT NULL AS found FROM chunk_vectors v LEFT JOIN (SELECT DISTINCT id FROM source_documents) s ON s.id = v.document_id""")
def existence_of_documents(spark, sf):
    """Whether each filing that vectors name exists."""
    v = table(spark, sf, "chunk_vectors", "document_id").distinct()
    s = table(spark, sf, "source_documents", "id").distinct().withColumn("found", F.lit(True))
    return v.join(s, F.col("document_id") == F.col("id"), "left").select("document_id", F.coalesce("found", F.lit(False)).alias("found"))


@query("column_audit", """
SELECT 'industry' AS column_name, count(*) AS total, count(industry) AS filled FROM companies UNION ALL SELECT 'staff_num', count(*), count(staff_num) FROM companies UNION ALL SELECT 'pre_name', count(*), count(pre_name) FROM companies""")
def column_audit(spark, sf):
    """How many rows of each of some columns hold a value, in one pass."""
    names = ("industry", "staff_num", "pre_name")
    one = table(spark, sf, "companies", *names).agg(F.count("*").alias("total"), *(F.count(c).alias(c) for c in names))
    return one.unpivot(["total"], list(names), "column_name", "filled").select("column_name", "total", "filled")


@query("changed_names", """
SELECT c.code, c.old_name, d.new_name FROM (SELECT code, min(name) AS old_name FROM companies GROUP BY code) c
JOIN (SELECT stock_code AS code, max(company_name) AS new_name FROM source_documents GROUP BY 1) d ON c.code = d.code WHERE c.old_name IS DISTINCT FROM d.new_name""")
def changed_names(spark, sf):
    """Companies whose filings carry another name than the list: what a refresh of the list has to fetch."""
    old = table(spark, sf, "companies", "code", "name").groupBy("code").agg(F.min("name").alias("old_name"))
    new = table(spark, sf, "source_documents", "stock_code", "company_name").groupBy(F.col("stock_code").alias("code")).agg(F.max("company_name").alias("new_name"))
    return old.join(new, "code").where("NOT (old_name <=> new_name)")


@query("code_changes", """
SELECT name, count(DISTINCT stock_code) AS codes, arg_max(stock_code, (n, stock_code)) AS main_code FROM (SELECT company_name AS name, stock_code, count(*) AS n FROM source_documents GROUP BY 1, 2) GROUP BY name""")
def code_changes(spark, sf):
    """The code under which each name files most, and the number of its codes."""
    n = table(spark, sf, "source_documents", F.col("company_name").alias("name"), "stock_code").groupBy("name", "stock_code").agg(F.count("*").alias("n"))
    return n.groupBy("name").agg(F.count("*").alias("codes"), F.max_by("stock_code", F.struct("n", "stock_code")).alias("main_code"))


@query("pending_incremental", "SELECT DISTINCT id FROM source_documents WHERE vectorized_at IS NULL OR updated_at > vectorized_at")
def pending_incremental(spark, sf):
    """Filings never vectorised or changed since."""
    return incremental.to_do(table(spark, sf, "source_documents", "id", "vectorized_at", "updated_at"), "vectorized_at", "updated_at").select("id").distinct()


@query("stream_event_windows", """
SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_event_windows(spark, sf):
    """Hourly counts of events by a stream that takes what has arrived and ends; the windows still open are emitted too."""
    import uuid

    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    counts = incremental.windowed_counts(stream, "ts", "event_type")

    incremental.update_now(counts, f"{at}/out", f"{at}/state").awaitTermination()
    return incremental.newest_updates(spark, f"{at}/out", ["start", "event_type"]).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("stream_upserts", """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY user_id""")
def stream_upserts(spark, sf):
    """The last event of every user by a stream that keeps a table in buckets of keys."""
    import uuid

    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf).select("user_id", "event_type", "ts", F.struct("ts", "event_id").alias("at"))
    incremental.upsert_now(stream, ["user_id"], "at", f"{at}/table", f"{at}/state", 8).awaitTermination()
    return incremental.upserted(spark, f"{at}/table").select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("stream_first_arrivals", "SELECT DISTINCT user_id FROM events")
def stream_first_arrivals(spark, sf):
    """Users at their first event, by a stream that drops keys seen within the watermark."""
    import uuid

    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf).select("user_id", "ts")
    incremental.append_now(incremental.unique_arrivals(stream, "user_id", "ts", "3650 days"), f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("user_id")


def queries():
    return QUERIES


def oracle_sql():
    return SQL
