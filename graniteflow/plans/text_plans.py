"""Queries of the scalar library: text, names, periods, paths, hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.functions import names as N
from graniteflow.functions import paths, period, text
from graniteflow.operators.latest import current_chunks
from graniteflow.sources.tables import table

SQL: dict[str, str] = {}
QUERIES = {}
WS = text.BLANK


def query(name, sql=None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def strip_sql(x):
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


@query("clean_text", f"""
SELECT doc_id, md5({strip_sql(f"array_to_string(list_transform(string_split(regexp_replace(text, chr(10) || '{{2,}}', chr(10), 'g'), chr(10)), lambda x: {strip_sql(chr(114) + 'egexp_replace(x, ' + chr(39) + ' +' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}), chr(10))")}) AS digest
FROM documents""")
def clean_text(spark, sf):
    """Digests of cleaned texts."""
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(text.clean(F.col("text"))).alias("digest"))


def number_sql():
    out = "regexp_replace(body, '<[^>]+>', ' ', 'g')"
    for pattern, by in text.TABLE_NUMBERS:
        out = f"regexp_replace({out}, '{pattern.replace('[BLANK]', f'[{WS}]')}', '{by}', 'g')"
    return f"trim(regexp_replace({out}, '[{WS}]+', ' ', 'g'), ' ')"


@query("table_text", f"""
SELECT id, {number_sql()} AS words FROM (
  SELECT arg_max(id, ingested_at) AS id, arg_max(coalesce(chunk_text, ''), ingested_at) AS body, arg_max(is_table, ingested_at) AS t FROM document_chunks GROUP BY lower(trim(id))) WHERE t""")
def table_text(spark, sf):
    """The words of table chunks without their figures."""
    raw = table(spark, sf, "document_chunks", "id", "ingested_at", "is_table", "chunk_text")
    rows = current_chunks(raw, "is_table", F.when(F.col("is_table"), F.coalesce("chunk_text", F.lit(""))).alias("body")).where("is_table")
    return rows.select("id", text.table_text(F.col("body")).alias("words"))


@query("markdown_lines", """
SELECT doc_id, CAST(len(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1])) AS INTEGER) AS lines_kept, CAST(len(l) AS INTEGER) AS lines_in
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)""")
def markdown_lines(spark, sf):
    """Lines of each text and how many are left without repeats of the line before."""
    d = table(spark, sf, "documents", "doc_id", "text").where("text IS NOT NULL").select("doc_id", F.split("text", "\n").alias("l"))
    return d.select("doc_id", F.size(text.without_repeats(F.col("l"))).alias("lines_kept"), F.size("l").alias("lines_in"))


@query("snippets", "SELECT doc_id, CASE WHEN length(text) > 80 THEN substr(text, 1, 77) || '...' ELSE text END AS snippet, CAST(length(text) // 4 AS INTEGER) AS tokens_estimate FROM documents")
def snippets(spark, sf):
    """The start of each text and a rough number of tokens."""
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", text.cut(F.col("text"), 80).alias("snippet"), F.expr("CAST(length(text) div 4 AS INT)").alias("tokens_estimate"))


@query("safe_names", """SELECT DISTINCT title, regexp_replace(regexp_replace(regexp_replace(title || ': "a/b"?', '[<>:"/\\\\|?*]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS safe FROM document_chunks WHERE title IS NOT NULL""")
def safe_names(spark, sf):
    """Chunk titles as file names."""
    t = table(spark, sf, "document_chunks", "title").where("title IS NOT NULL").distinct()
    return t.select("title", text.safe_name(F.concat("title", F.lit(': "a/b"?'))).alias("safe"))


@query("file_sizes", """
SELECT DISTINCT id, CASE WHEN file_size < 1024 THEN printf('%.2f B', file_size / 1.0) WHEN file_size < 1048576 THEN printf('%.2f KB', file_size / 1024.0) WHEN file_size < 1073741824 THEN printf('%.2f MB', file_size / 1048576.0)
  WHEN file_size IS NOT NULL THEN printf('%.2f GB', file_size / 1073741824.0) END AS size FROM source_documents""")
def file_sizes(spark, sf):
    """File sizes in readable form."""
    d = table(spark, sf, "source_documents", "id", "file_size")
    return d.select("id", text.file_size(F.col("file_size")).alias("size")).distinct()


def exchange_sql(code):
    return "CASE " + " ".join(f"WHEN starts_with({code}, '{p}') THEN '{e}'" for p, e in N.EXCHANGES) + f" WHEN {code} IS NOT NULL THEN 'SZ' END"


@query("company_codes", f"""
SELECT DISTINCT code, market, CASE market WHEN 'hs_stock' THEN regexp_matches(upper(code), '^[0-9]{{6}}$') WHEN 'hk_stock' THEN regexp_matches(upper(code), '^[0-9]{{5}}$')
  WHEN 'us_stock' THEN regexp_matches(upper(code), '^[A-Z]{{1,5}}$') ELSE FALSE END AS valid,
  CASE WHEN TRY_CAST(code AS DOUBLE) >= 0 AND TRY_CAST(code AS DOUBLE) < 1e6 THEN lpad(CAST(CAST(TRY_CAST(code AS DOUBLE) AS BIGINT) AS VARCHAR), 6, '0') ELSE code END AS padded,
  {exchange_sql('code')} AS exchange FROM companies WHERE code IS NOT NULL""")
def company_codes(spark, sf):
    """Codes with their validity, padded form and exchange."""
    c = table(spark, sf, "companies", "code", "market").where("code IS NOT NULL").distinct()
    code = F.col("code")
    return c.select("code", "market", N.valid_code(code, F.col("market")).alias("valid"), N.padded_code(code).alias("padded"), N.exchange(code).alias("exchange"))


def bare_sql(x):
    n = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '[ 　]', '', 'g'), '[ABＡＢab]$', ''), '^\\*+', ''), '^ST', '')"
    cases = " ".join(f"WHEN n LIKE '%{s}' THEN left(n, length(n) - {len(s)})" for s in N.SUFFIXES)
    return f"(SELECT CASE {cases} ELSE n END FROM (SELECT {n} AS n))"


SEARCHED = ["Torkadale", "Torkadale Development Limited", "*ST Zelriquay A", "Savriford", "Quin", "Galrimere Group plc Holding", "nothing here"]
ASKED = " UNION ALL ".join(f"SELECT '{q}' AS query" for q in SEARCHED)


@query("name_search", f"""
WITH q AS (SELECT query, {bare_sql('query')} AS bare FROM ({ASKED})),
c AS (SELECT code, name, org_name_en, org_short_name_en, pre_name, {bare_sql('name')} AS own FROM companies),
h AS (SELECT query, code, min(CASE WHEN query = name OR query = org_name_en OR query = org_short_name_en THEN 1 WHEN bare <> '' AND own = bare THEN 2 WHEN bare <> '' AND contains(own, bare) THEN 3
  WHEN own <> '' AND contains(bare, own) THEN 4 WHEN bare <> '' AND EXISTS (SELECT 1 FROM (SELECT unnest(string_split(pre_name, ',')) AS f) WHERE contains(f, bare) OR (f <> '' AND contains(bare, f))) THEN 5 END) AS tier FROM c, q GROUP BY query, code)
SELECT query, code, CAST(tier AS INTEGER) AS tier, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY tier, code) AS place FROM h WHERE tier IS NOT NULL) WHERE place <= 30""")
def name_search(spark, sf):
    """Companies found by several names in five tiers."""
    c = table(spark, sf, "companies", "code", "name", "org_name_en", "org_short_name_en", "pre_name")
    return N.search(c, spark.createDataFrame([(q,) for q in SEARCHED], "query string"), 30)


@query("fiscal_periods", """
WITH f AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' ELSE '6-K' END AS form,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS reported, CAST(o_orderdate AS DATE) + 40 AS filed, o_custkey % 12 + 1 AS fye FROM orders),
n AS (SELECT *, ((month(reported) - fye - 1) % 12 + 12) % 12 + 1 AS nth FROM f)
SELECT o_orderkey, CAST(coalesce(CASE WHEN form = '10-K' AND fye <= 3 THEN year(reported) - 1 WHEN form = '10-Q' AND fye > 3 AND month(reported) > fye THEN year(reported) + 1 ELSE year(reported) END, year(filed)) AS INTEGER) AS fiscal_year,
  CAST(CASE WHEN form <> '10-Q' THEN NULL WHEN reported IS NULL THEN 1 WHEN nth IN (5, 6, 7) THEN 2 WHEN nth IN (8, 9, 10) THEN 3 ELSE 1 END AS INTEGER) AS fiscal_quarter FROM n""")
def fiscal_periods(spark, sf):
    """Fiscal years and quarters of filings derived from orders."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    form = F.when(F.col("o_orderkey") % 3 == 0, "10-K").when(F.col("o_orderkey") % 3 == 1, "10-Q").otherwise("6-K")
    reported = F.when(F.col("o_orderkey") % 11 != 0, F.to_date("o_orderdate"))
    rows = o.select("o_orderkey", form.alias("form"), reported.alias("reported"), F.date_add(F.to_date("o_orderdate"), 40).alias("filed"), (F.col("o_custkey") % 12 + 1).alias("fye"))
    year, quarter = period.fiscal_period(F.col("form"), F.col("reported"), F.col("filed"), F.col("fye"))
    return rows.select("o_orderkey", year.cast("int").alias("fiscal_year"), quarter.cast("int").alias("fiscal_quarter"))


TITLES = ["2023 Annual Report", "Interim Report 2022", "First Quarter Results 2021", "二零二三年第三季度报告 2023", "截至2022年9月30日止九个月业绩", "截至2021年11月止业绩", "2022-2023 results", "截至2023年3月31日止年度年報", "二零二一年年報", "Circular"]
TITLE_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS title" for t in TITLES)
QUARTER_CASES = " ".join(f"WHEN regexp_matches(lower(title), '{'|'.join(w)}') THEN '{q}'" for q, w in period.QUARTER_WORDS.items())


@query("title_periods", f"""
SELECT title, CASE {QUARTER_CASES} WHEN TRY_CAST(regexp_extract(title, '截至.*?([0-9]{{4}})年([0-9]{{1,2}})月', 2) AS INTEGER) BETWEEN 1 AND 12
  THEN 'Q' || CAST(CAST(ceil(TRY_CAST(regexp_extract(title, '截至.*?([0-9]{{4}})年([0-9]{{1,2}})月', 2) AS INTEGER) / 3) AS INTEGER) AS VARCHAR) END AS quarter,
  CAST(coalesce(TRY_CAST(regexp_extract(title, '截至.*?([0-9]{{4}})年([0-9]{{1,2}})月', 1) AS INTEGER)
      - CASE WHEN TRY_CAST(regexp_extract(title, '截至.*?([0-9]{{4}})年([0-9]{{1,2}})月', 2) AS INTEGER) <= 6 AND regexp_matches(lower(title), '年报|年報|年度|annual') THEN 1 ELSE 0 END,
    TRY_CAST(regexp_extract(title, '([0-9]{{4}})[-/][0-9]{{4}}', 1) AS INTEGER), TRY_CAST(regexp_extract(title, '([0-9]{{4}})年', 1) AS INTEGER),
    2000 + TRY_CAST(translate(nullif(regexp_extract(title, '二[零〇]([零〇一二三四五六七八九]{{2}})', 1), ''), '〇零一二三四五六七八九', '00123456789') AS INTEGER),
    TRY_CAST(regexp_extract(title, '(20[0-9]{{2}})', 1) AS INTEGER)) AS INTEGER) AS year FROM ({TITLE_ROWS})""")
def title_periods(spark, sf):
    """Quarters and years that titles name."""
    t = spark.createDataFrame([(x,) for x in TITLES], "title string")
    return t.select("title", period.title_quarter(F.col("title")).alias("quarter"), period.title_year(F.col("title")).alias("year"))


@query("quarters_before", """
SELECT o_orderkey, CAST(CASE WHEN quarter(o_orderdate) = 1 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS INTEGER) AS year, CAST(CASE WHEN quarter(o_orderdate) = 1 THEN 4 ELSE quarter(o_orderdate) - 1 END AS INTEGER) AS quarter FROM orders""")
def quarters_before(spark, sf):
    """The quarter before the one of each order."""
    o = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    y, q = period.quarter_before(F.year("o_orderdate"), F.quarter("o_orderdate"))
    return o.select("o_orderkey", y.alias("year"), q.alias("quarter"))


@query("event_times", """
SELECT event_id, epoch_ms(date_trunc('minute', ts)) AS ms, strftime(ts, '%d-%m-%Y') AS day FROM events""")
def event_times(spark, sf):
    """Times as text and back to milliseconds, and days in another order."""
    e = table(spark, sf, "events", "event_id", "ts")
    return e.select("event_id", period.to_ms(F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("ms"), F.date_format("ts", "dd-MM-yyyy").alias("day"))


@query("event_properties", """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(DISTINCT json_extract_string(props, '$.k')) AS kinds FROM events GROUP BY event_type""")
def event_properties(spark, sf):
    """A JSON property by event type."""
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events", "event_type", "props").groupBy("event_type").agg(F.sum(k).alias("total"), F.countDistinct(k).alias("kinds"))


@query("path_parts", """
SELECT DISTINCT object_path, p[2] AS market, p[3] AS code, CASE WHEN len(p) >= 6 THEN TRY_CAST(p[4] AS INTEGER) END AS year,
  CASE WHEN len(p) >= 6 THEN CASE WHEN p[5] = 'FY' THEN 4 ELSE TRY_CAST(nullif(regexp_extract(p[5], '^Q([1-4])$', 1), '') AS INTEGER) END END AS quarter, p[len(p)] AS file_name
FROM (SELECT object_path, string_split(object_path, '/') AS p FROM source_documents WHERE starts_with(object_path, 'bronze/'))""")
def path_parts(spark, sf):
    """What object paths say."""
    d = table(spark, sf, "source_documents", "object_path").where("startswith(object_path, 'bronze/')").distinct()
    return d.select("object_path", *(c.alias(n) for n, c in paths.parsed(F.col("object_path")).items()))


@query("path_codec", """
SELECT DISTINCT id, CASE WHEN doc_type = 'ipo_prospectus' THEN concat_ws('/', 'bronze', market, stock_code, 'ipo', 'f.pdf')
  ELSE concat_ws('/', 'bronze', market, stock_code, CAST(year AS VARCHAR), CASE WHEN quarter IN (1, 2, 3) THEN 'Q' || quarter ELSE 'FY' END, 'f.pdf') END AS path,
  CASE WHEN lower(object_path) LIKE '%.pdf' THEN 'application/pdf' WHEN lower(object_path) LIKE '%.html' OR lower(object_path) LIKE '%.htm' THEN 'text/html' ELSE 'application/octet-stream' END AS content_type FROM source_documents""")
def path_codec(spark, sf):
    """The path that a filing should have, and the type of the object it has."""
    d = table(spark, sf, "source_documents", "id", "market", "stock_code", "year", "quarter", "doc_type", "object_path")
    c = F.col
    path = paths.bronze(c("market"), c("stock_code"), c("year"), c("quarter"), F.lit("f.pdf"), c("doc_type") == "ipo_prospectus")
    return d.select("id", path.alias("path"), paths.content_type(c("object_path")).alias("content_type")).distinct()


@query("text_hashes", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def text_hashes(spark, sf):
    """Digests of texts."""
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"))


@query("sibling_paths", """
SELECT DISTINCT markdown_path, regexp_replace(markdown_path, '[^/]*$', 'structure.json') AS structure_path, 'quarantine/parse_failed/' || markdown_path AS quarantine_path FROM parsed_documents WHERE markdown_path <> ''""")
def sibling_paths(spark, sf):
    """The places of the products beside a markdown file and of its copy in quarantine."""
    p = table(spark, sf, "parsed_documents", "markdown_path").where("markdown_path <> ''").distinct()
    path = F.col("markdown_path")
    return p.select("markdown_path", paths.sibling(path, "structure.json").alias("structure_path"), paths.quarantined(path, F.lit("parse_failed")).alias("quarantine_path"))


def queries():
    return QUERIES


def oracle_sql():
    return SQL
