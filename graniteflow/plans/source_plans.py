"""Sources, sinks, object stores and the catalogue, on files that a query writes itself into the shared folder.

The files are a few made-up ones of some bytes; what they should give is known and is the SQL twin.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile

from pyspark.sql import functions as F

from graniteflow.functions import names
from graniteflow.operators import lifecycle as L
from graniteflow.operators import records as R
from graniteflow.plans.fixture import Registry, rows_sql
from graniteflow.session import ensure_checkpoint_dir
from graniteflow.sources import catalog, files
from graniteflow.sources.objects import ObjectStore
from graniteflow.sources.tables import table

query = Registry()


def scratch(spark) -> tuple[ObjectStore, str]:
    """An empty store in the folder that all machines share, and where it is."""
    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/objects-{uuid.uuid4().hex}"
    return ObjectStore(spark, at), at


@query("object_store_calls", rows_sql("step INT, called VARCHAR, result VARCHAR", [
    (1, "put", "5"), (2, "put_json", '{"a": [1, "ü"]}'), (3, "get", "hello"), (4, "exists", "yes"), (5, "exists missing", "no"), (6, "info", "a/one.txt 5 text/plain"), (7, "copy", "a/one.txt,a/two.txt,b/x.json"),
    (8, "move", "a/one.txt,b/x.json,c/two.txt"), (9, "list prefix", "a/one.txt"), (10, "list most", "a/one.txt,b/x.json"), (11, "delete", "yes"), (12, "delete again", "no"), (13, "delete prefix", "2"), (14, "left", "c/two.txt 5"), (15, "get missing", "none"), (16, "move missing", "no"), (17, "empty prefix", "refused"),
]))
def object_store_calls(spark, sf):
    """Every call on single objects of a store, one after the other."""
    s, _ = scratch(spark)
    yes = lambda b: "yes" if b else "no"
    held = lambda **k: ",".join(n for n, _ in s.listing(**k))
    out = [("put", str(s.put("a/one.txt", b"hello")))]
    s.put_json("b/x.json", {"a": [1, "ü"]})
    out.append(("put_json", json.dumps(s.get_json("b/x.json"), ensure_ascii=False)))
    out += [("get", s.get("a/one.txt").decode()), ("exists", yes(s.exists("a/one.txt"))), ("exists missing", yes(s.exists("a/none")))]
    i = s.info("a/one.txt")
    out.append(("info", f"{i['name']} {i['size']} {i['content_type']}"))
    s.copy("a/one.txt", "a/two.txt")
    out.append(("copy", held()))
    s.move("a/two.txt", "c/two.txt")
    out += [("move", held()), ("list prefix", held(prefix="a/")), ("list most", held(most=2))]
    out += [("delete", yes(s.delete("a/one.txt"))), ("delete again", yes(s.delete("a/one.txt")))]
    s.put("b/xy.txt", b"")
    out += [("delete prefix", str(s.delete_prefix("b/x"))), ("left", f"{held()} {s.size()}"), ("get missing", "none" if s.get("b/x.json") is None else "some"), ("move missing", yes(s.move("b/x.json", "d")))]
    try:
        s.delete_prefix("")
        out.append(("empty prefix", "done"))
    except ValueError:
        out.append(("empty prefix", "refused"))
    return spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(out, 1)], "step int, called string, result string")


@query("object_listing", rows_sql("name VARCHAR, length BIGINT, head VARCHAR", [("a.txt", 3, "abc"), ("b.txt", 4, "defg")]))
def object_listing(spark, sf):
    """Objects below a folder with their size and content, as a set."""
    s, at = scratch(spark)
    for name, data in (("x/a.txt", b"abc"), ("x/y/b.txt", b"defg"), ("x/c.pdf", b"%PDF")):
        s.put(name, data)
    listed = files.listing(spark, at, "*.txt").select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(at).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.decode("content", "UTF-8").alias("head"))
    return listed.join(content, "name")


@query("restored_objects", rows_sql("name VARCHAR, held VARCHAR", [("bronze/a.pdf", "A"), ("quarantine/small/b.pdf", "B")]))
def restored_objects(spark, sf):
    """Objects after one of two is put back out of quarantine, as the records say."""
    s, at = scratch(spark)
    for name, data in (("quarantine/error/bronze/a.pdf", b"A"), ("quarantine/small/b.pdf", b"B")):
        s.put(name, data)
    schema = "record_id string, object_path string, quarantine_path string, status string"
    records = spark.createDataFrame([("1", "bronze/a.pdf", "quarantine/error/bronze/a.pdf", "pending"), ("2", "b.pdf", "quarantine/small/b.pdf", "pending"), ("3", "c.pdf", "quarantine/x/c.pdf", "pending")], schema)
    decided = R.resolved(records, spark.createDataFrame([("1", "restore"), ("2", "look"), ("3", "restore")], "record_id string, action string"))
    for r in decided.where("copy_back IS NOT NULL").toLocalIterator():  # objects are moved one call each
        s.move(r["copy_back"], r["object_path"])
    return spark.createDataFrame([(n, s.get(n).decode()) for n, _ in s.listing()], "name string, held string")


@query("csv_tasks", rows_sql("source VARCHAR, code VARCHAR, name VARCHAR, year INT, quarter VARCHAR", [
    ("reports", "000001", "平安银行", 2023, "Q4"), ("reports", "600519", "Kweichow", 2022, "Q2"), ("offers", "000001", "平安银行", None, None), ("offers", "600519", "Kweichow", None, None), ("offers", "688001", "No year", None, None),
]))
def csv_tasks(spark, sf):
    """Task lists of two kinds in several encodings; rows without what their kind needs are dropped."""
    s, at = scratch(spark)
    s.put("t/gbk.csv", "code,name,year,quarter\n1,平安银行,2023,\n".encode("gbk"))
    s.put("t/utf.csv", "code,name,year,quarter\n600519,Kweichow,2022,q2\n,Nobody,2022,Q1\n688001,No year,,Q1\n".encode("utf-8-sig"))
    r, o = files.task_list(spark, f"{at}/t"), files.offer_list(spark, f"{at}/t")
    none = lambda kind: F.lit(None).cast(kind)
    return r.select(F.lit("reports").alias("source"), "code", "name", "year", "quarter").union(o.select(F.lit("offers"), "code", "name", none("int"), none("string")))


@query("failed_tasks", rows_sql("code VARCHAR, year INT", [("000002", 2023)]))
def failed_tasks(spark, sf):
    """Tasks that are not among those that failed before, written as CSV and read again."""
    s, at = scratch(spark)
    files.write_csv(spark.createDataFrame([("000001", 2023, 'a "quoted", name'), ("000003", 2022, None)], "code string, year int, name string"), f"{at}/failed")
    failed = spark.read.csv(f"{at}/failed", header=True, schema="code string, year int, name string", escape='"')
    return spark.createDataFrame([("000001", 2023), ("000002", 2023)], "code string, year int").join(failed, ["code", "year"], "left_anti")


@query("exported_companies", "SELECT DISTINCT code, name, coalesce(industry, '') AS industry FROM companies WHERE code IS NOT NULL")
def exported_companies(spark, sf):
    """Companies written as CSV and read again."""
    _, at = scratch(spark)
    c = table(spark, sf, "companies", "code", "name", "industry").where("code IS NOT NULL").distinct()
    files.write_csv(c, f"{at}/companies")
    back = spark.read.csv(f"{at}/companies", header=True, schema="code string, name string, industry string", escape='"')
    return back.select("code", "name", F.coalesce("industry", F.lit("")).alias("industry"))


@query("json_files", rows_sql("id INT, tags VARCHAR[]", [(1, ["a", "b"]), (2, [])]))
def json_files(spark, sf):
    """Rows written as JSON and read again."""
    _, at = scratch(spark)
    files.write_json(spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id int, tags array<string>"), f"{at}/j")
    return spark.read.schema("id int, tags array<string>").json(f"{at}/j")


@query("report_cache", rows_sql("code VARCHAR, year INT, quarter VARCHAR, cached BOOLEAN", [("000001", 2023, "Q4", True), ("000001", 2023, "Q1", False), ("000002", 2022, "Q2", True)]))
def report_cache(spark, sf):
    """Which tasks have their report among the files that are there."""
    s, at = scratch(spark)
    for n in ("SZ/000001_2023_Q4_20240301.pdf", "SZ/000002_2022_Q2_20220830.pdf", "SZ/bad_name.pdf", "SZ/000001_2023_Q9_x.pdf"):
        s.put(n, b"x")
    have = files.existing_reports(files.listing(spark, at, "*.pdf"))
    return files.cached(spark.createDataFrame([("000001", 2023, "Q4"), ("000001", 2023, "Q1"), ("000002", 2022, "Q2")], "code string, year int, quarter string"), have)


PDF = b"%PDF-1.4" + b"x" * 2000 + b"%%EOF\n"


@query("pdf_checks", rows_sql("name VARCHAR, whole BOOLEAN, md5 VARCHAR", [("good.pdf", True, hashlib.md5(PDF).hexdigest()), ("short.pdf", False, None), ("cut.pdf", False, None), ("null.pdf", False, None)]))
def pdf_checks(spark, sf):
    """Whether bytes are whole PDFs, and the digest of those that are."""
    d = spark.createDataFrame([("good.pdf", bytearray(PDF)), ("short.pdf", bytearray(b"%PDF-%%EOF")), ("cut.pdf", bytearray(PDF[:-8])), ("null.pdf", None)], "name string, content binary")
    whole = files.complete_pdf(F.col("content"))
    return d.select("name", whole.alias("whole"), F.when(whole, files.digest(F.col("content"))).alias("md5"))


@query("filled_hashes", rows_sql("path VARCHAR, file_hash VARCHAR", [("a", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"), ("b", "old"), ("c", None), ("d", None)]))
def filled_hashes(spark, sf):
    """Missing digests filled from the objects that there are."""
    rows = spark.createDataFrame([("a", None), ("b", "old"), ("c", None), ("d", None)], "path string, file_hash string")
    objects = spark.createDataFrame([("a", bytearray(b"abc")), ("b", bytearray(b"x")), ("d", bytearray(b""))], "path string, content binary")
    return files.filled_hashes(rows, objects, "path")


SUBMISSION = [("0000320193", "0926", (["0001-24-1", "0001-24-2", "0001-24-3", "0001-24-4"], ["10-K", "10-Q/A", "8-K", "10-K"], ["2024-11-01", "2024-05-03", "2024-05-04", "bad"], ["2024-09-28", "2024-03-30", "", "2023-09-30"], ["k.htm", "", "e.htm", "z.htm"]))]


@query("parsed_filings", rows_sql("form VARCHAR, filed DATE, reported DATE, is_amendment BOOLEAN, url VARCHAR", [("10-K", "2024-11-01", "2024-09-28", False, "320193/0001241/k.htm"), ("10-Q/A", "2024-05-03", "2024-03-30", True, "320193/0001242/index.html")]))
def parsed_filings(spark, sf):
    """Filings of some forms and days out of parallel arrays."""
    d = spark.createDataFrame([(c, f, (r,)) for c, f, r in SUBMISSION], files.FILINGS)
    return files.filings(d, ["10-K", "10-Q", "10-Q/A"], "2024-01-01", "2024-12-31").select("form", "filed", "reported", "is_amendment", "url")


@query("submission_fields", rows_sql("cik VARCHAR, name VARCHAR, exchanges VARCHAR, tickers VARCHAR[]", [("1", "Alpha", "NYSE,Nasdaq", ["A", "B"]), ("2", None, None, [])]))
def submission_fields(spark, sf):
    """Fields of registrants with blanks as none, exchanges as a list in text, tickers each once in order."""
    d = spark.createDataFrame([("1", " Alpha ", ["NYSE", "Nasdaq"], ["A", "B", "A"]), ("2", " ", [], [])], "cik string, name string, exchanges array<string>, tickers array<string>")
    return files.submission(d)


@query("linked_documents", rows_sql("title VARCHAR, href VARCHAR, released TIMESTAMP", [("Annual Report", "/a.pdf", "2024-04-02 16:30:00"), ("Interim", "/b.pdf", "2024-08-03 00:00:00")]))
def linked_documents(spark, sf):
    """Rows of tables in pages that have a link and a time."""
    html = "<table><tr><th>time</th></tr><tr><td>02/04/2024 16:30</td><td>1</td><td><a href='/a.pdf'>Annual Report</a></td></tr><tr><td>03/08/2024</td><td>2</td><td><a href='/b.pdf'>Interim</a></td></tr><tr><td>soon</td><td>3</td><td><a href='/c.pdf'>X</a></td></tr><tr><td>04/08/2024</td><td>none</td></tr></table>"
    return files.table_links(spark.createDataFrame([(1, html), (2, None)], "doc int, html string")).select("title", "href", F.col("released").cast("timestamp_ntz").alias("released"))


@query("primary_documents", rows_sql("id INT, href VARCHAR", [(1, "form10k_main.htm"), (2, None)]))
def primary_documents(spark, sf):
    """The main document of index pages: the longest relative link to a page that is no index, the first of equal ones."""
    d = spark.createDataFrame([(1, '<a href="index.htm">i</a><a href="a.htm">a</a><a href="form10k_main.htm">m</a><a href="form10k_copy.htm">c</a><a href="/abs/very_long_name_of_page.htm">x</a><a href="https://e.example/long_long_long.htm">y</a>'), (2, "<a href='x.pdf'>x</a>")], "id int, html string")
    return d.select("id", files.primary_document(F.col("html")).alias("href"))


@query("archive_members", rows_sql("path VARCHAR, member VARCHAR, kind VARCHAR, size BIGINT", [("a.zip", "doc.md", "markdown", 6), ("a.zip", "images/1.png", "image", 3), ("a.zip", "list.json", "json", 2), ("b.zip", None, "broken", 3)]))
def archive_members(spark, sf):
    """Members of archives by kind."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("doc.md", "# Head")
        z.writestr("images/1.png", b"png")
        z.writestr("list.json", "[]")
    d = spark.createDataFrame([("a.zip", bytearray(buffer.getvalue())), ("b.zip", bytearray(b"zip"))], "path string, content binary")
    return files.archive_members(d).select("path", "member", "kind", "size")


PARSED = {"markdown": "# Head", "pages": [{"tables": [{"html": "<t/>"}], "images": [{"path": "1.png"}, {"path": "2.png"}]}, {"tables": [], "images": []}]}


@query("parser_outputs", rows_sql("id VARCHAR, text_length INT, pages_count INT, tables_count INT, images_count INT, images VARCHAR[]", [("a", 6, 2, 1, 2, ["0:1.png", "0:2.png"]), ("b", None, 0, 0, 0, [])]))
def parser_outputs(spark, sf):
    """What a parser's JSON holds: text, pages, tables and images."""
    d = spark.createDataFrame([("a", json.dumps(PARSED)), ("b", "not json")], "id string, body string")
    return files.parser_output(d)


# ---- catalogue

@query("table_inventory", "SELECT 'companies' AS table_name, TRUE AS present, count(*) AS n FROM companies UNION ALL SELECT 'document_chunks', TRUE, count(*) FROM document_chunks UNION ALL SELECT 'documents', TRUE, count(*) FROM documents UNION ALL SELECT 'validation_logs', FALSE, 0")
def table_inventory(spark, sf):
    """Tables that exist, with their numbers of rows."""
    return catalog.inventory(spark, sf, ["companies", "document_chunks", "documents", "validation_logs"])


@query("parameterised_sql", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 AND o_orderpriority = '1-URGENT' GROUP BY o_orderstatus")
def parameterised_sql(spark, sf):
    """A statement with named parameters over a view of its own."""
    orders = table(spark, sf, "orders", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return catalog.run_sql(spark, "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_totalprice > :least AND o_orderpriority = :priority GROUP BY o_orderstatus", {"least": 1000, "priority": "1-URGENT"}, orders=orders)


@query("table_statistics", "SELECT 'l_shipdate' AS column_name, CAST(count(l_shipdate) AS BIGINT) AS filled, count(DISTINCT l_shipdate) AS distinct_values FROM lineitem UNION ALL SELECT 'l_quantity', count(l_quantity), count(DISTINCT l_quantity) FROM lineitem UNION ALL SELECT 'l_partkey', count(l_partkey), count(DISTINCT l_partkey) FROM lineitem")
def table_statistics(spark, sf):
    """Filled and distinct values of columns."""
    return catalog.statistics(table(spark, sf, "lineitem", "l_shipdate", "l_quantity", "l_partkey"), "l_shipdate", "l_quantity", "l_partkey")


@query("created_tables", rows_sql("table_name VARCHAR, present BOOLEAN, n BIGINT, made BOOLEAN", [("image_annotations", True, 0, True), ("images", True, 0, True), ("quarantine_records", True, 0, True), ("validation_logs", True, 0, True), ("vectors", True, 0, True)]))
def created_tables(spark, sf):
    """Tables made where there are none, and found by a second call."""
    _, at = scratch(spark)
    made = catalog.create_tables(spark, at)
    again = catalog.create_tables(spark, at)
    found = catalog.inventory(spark, at, sorted(catalog.SCHEMAS))
    return found.withColumn("made", F.col("table_name").isin(made) & F.lit(not again))


@query("vector_faults", """
SELECT coalesce(CASE WHEN embedding IS NULL OR len(embedding) = 0 THEN 'missing' WHEN len(embedding) <> 64 THEN 'dimension' WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'value' END, 'fits') AS fault, count(*) AS n FROM chunk_vectors GROUP BY 1""")
def vector_faults(spark, sf):
    """How many vectors fit a collection of 64 dimensions, and what keeps the others out."""
    v = table(spark, sf, "chunk_vectors", "embedding")
    return v.groupBy(F.coalesce(catalog.fits(F.col("embedding"), 64), F.lit("fits")).alias("fault")).agg(F.count("*").alias("n"))


@query("key_violations", """
SELECT t AS table_name, CAST(count(*) FILTER (k IS NOT NULL AND n > 1) AS BIGINT) AS duplicate_keys, CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS null_keys FROM (
  SELECT 'companies' AS t, code AS k, count(*) AS n FROM companies GROUP BY code UNION ALL SELECT 'source_documents', id, count(*) FROM source_documents GROUP BY id UNION ALL SELECT 'chunks', lower(trim(id)), count(*) FROM document_chunks GROUP BY 2) GROUP BY t""")
def key_violations(spark, sf):
    """How tables break the uniqueness of their keys."""
    c = table(spark, sf, "document_chunks", F.lower(F.trim("id")).alias("k"))
    return catalog.key_violations({"companies": (table(spark, sf, "companies", "code"), "code"), "source_documents": (table(spark, sf, "source_documents", "id"), "id"), "chunks": (c, "k")})


@query("upload_metadata", rows_sql("id INT, code VARCHAR, url VARCHAR, ipo_year INT", [(1, "000001", "new", 2023), (2, "000002", "kept", 2021), (3, "000003", None, 2026)]))
def upload_metadata(spark, sf):
    """Metadata of downloaded files: what is there wins, but for the address; a year out of the file's name, else this one."""
    d = spark.createDataFrame([(1, {"code": "000001", "url": "old"}, {"code": "9", "url": "new"}, "p_2023.pdf"), (2, {"code": "000002", "url": "kept"}, {}, "2021-p.pdf"), (3, None, {"code": "000003"}, "p.pdf")], "id int, own map<string,string>, more map<string,string>, file string")
    m = files.merged_metadata(F.col("own"), F.col("more"), "url")
    return d.select("id", m["code"].alias("code"), m["url"].alias("url"), files.year_of_name(F.col("file"), F.lit(2026)).alias("ipo_year"))


@query("offer_tasks", "SELECT DISTINCT code, 'ipo_prospectus' AS doc_type FROM companies WHERE market = 'hs_stock' AND code IS NOT NULL AND code NOT IN (SELECT stock_code FROM source_documents WHERE doc_type = 'ipo_prospectus')")
def offer_tasks(spark, sf):
    """One task for the prospectus of every company of a market that has none."""
    c = table(spark, sf, "companies", "code", "market").where("market = 'hs_stock' AND code IS NOT NULL").select("code").distinct()
    have = table(spark, sf, "source_documents", "stock_code", "doc_type").where("doc_type = 'ipo_prospectus'")
    return L.orphans(c, have, "code", "stock_code").withColumn("doc_type", F.lit("ipo_prospectus"))


@query("crawl_fold", """
SELECT id, outcome FROM (SELECT id, CASE WHEN by_url > 1 THEN 'same address' WHEN by_key > 1 THEN 'same period' ELSE 'new' END AS outcome FROM (
  SELECT id, row_number() OVER (PARTITION BY coalesce(nullif(trim(source_url, ' '), ''), id) ORDER BY created_at NULLS FIRST, id) AS by_url, row_number() OVER (PARTITION BY stock_code, doc_type, year, CASE WHEN doc_type IN ('annual_reports', '10k') THEN coalesce(quarter, 4) ELSE quarter END ORDER BY created_at NULLS FIRST, id) AS by_key
  FROM (SELECT DISTINCT id, source_url, stock_code, doc_type, year, quarter, created_at FROM source_documents)))""")
def crawl_fold(spark, sf):
    """What becomes of every filing as it comes in: new, or skipped as its address or its period is there."""
    from graniteflow.functions.period import annual_quarter

    d = table(spark, sf, "source_documents", "id", "source_url", "stock_code", "doc_type", "year", "quarter", "created_at").distinct()
    keyed = d.withColumns({"url": F.coalesce(F.nullif(F.trim("source_url"), F.lit("")), "id"), "period": annual_quarter(F.col("doc_type"), F.col("quarter"))})
    order = [F.col("created_at").asc_nulls_first(), F.col("id")]
    one = R.numbered(keyed, "url", order).withColumnRenamed("place", "by_url")
    two = R.numbered(one.withColumn("slot", F.struct("stock_code", "doc_type", "year", "period")), "slot", order)
    return two.select("id", F.when(F.col("by_url") > 0, "same address").when(F.col("place") > 0, "same period").otherwise("new").alias("outcome"))


@query("padded_code_list", rows_sql("code VARCHAR, name VARCHAR", [("000001", "A"), ("000002", "B"), ("600519", "K")]))
def padded_code_list(spark, sf):
    """A list of companies out of three lists, the first that has a code counts; blank codes are dropped."""
    lists = [[("1", "A"), (None, "x")], [("2", "B"), ("000001", "late")], [("600519", "K"), (" ", "y")]]
    rows = [(c, n, k) for k, part in enumerate(lists) for c, n in part]
    d = spark.createDataFrame(rows, "code string, name string, place int").where("trim(code) <> ''").withColumn("code", names.padded_code(F.trim("code")))
    return d.groupBy("code").agg(F.min_by("name", "place").alias("name"))


@query("stock_list", rows_sql("code VARCHAR, active BOOLEAN, kind VARCHAR, org_id VARCHAR", [("00001", True, "Main Board", "7"), ("00005", False, "GEM", "9")]))
def stock_list(spark, sf):
    """Active companies, then inactive ones with other codes, of the kind in brackets, with their identifiers."""
    active = spark.createDataFrame([("1", "Equity Securities (Main Board)"), ("3", "Debt Securities (x)")], "code string, category string")
    gone = spark.createDataFrame([("00001", "Equity Securities (GEM)"), ("5", "Equity Securities (GEM)")], "code string, category string")
    ids = spark.createDataFrame([("00001", "7"), ("00005", "9"), ("00003", "8")], "code string, org_id string")
    return files.stock_list(active, gone, ids, "Equity")


def queries():
    return query.queries


def oracle_sql():
    return query.sql
