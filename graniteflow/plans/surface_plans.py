"""Functions of text, names, periods and announcements on made-up rows whose results are known, and on the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.functions import markup, names, paths, period, text
from graniteflow.operators import announcements as A
from graniteflow.operators import retrieval, search
from graniteflow.plans.fixture import Registry, rows_sql
from graniteflow.sources import files
from graniteflow.sources.tables import table

query = Registry()
VARCHARS = lambda *n: ", ".join(f"{x} VARCHAR" for x in n)


# ---- periods

@query("period_helpers", rows_sql("id INT, last VARCHAR, number INT, day VARCHAR, year VARCHAR, kind VARCHAR, folder VARCHAR, date DATE", [
    (1, "2023-Q4", 3, "02-01-2024", "2024", "annual_report", "FY", "2024-02-29"), (2, "2024-Q1", 1, "NA", "2026", "interim_report", "Q2", "2024-03-05"),
    (3, "2024-Q3", None, "31-12-1969", "1969", "quarterly_report", None, "2024-12-01"), (4, "2024-Q2", 4, "NA", "2026", "unknown", "FY", None),
]))
def period_helpers(spark, sf):
    """Quarters before, out of text and of kinds; days and years of milliseconds; folders of forms; dates in several spellings."""
    rows = [(1, "2024-02-10", "Q3", 1704153600000, "Q4", "10-K", 4, "2024-02-29"), (2, "2024-05-01", " q1", 0, "Q2", "10-Q", 2, "2024/3/5 10:00"), (3, "2024-11-30", "5", -1, "Q3", "10-Q", 4, "20241201"), (4, "2024-07-01", "4", None, None, "6-K", None, "soon")]
    d = spark.createDataFrame(rows, "id int, today string, q string, ms bigint, kind string, form string, n int, d string")
    y, q = period.quarter_before(*period.quarter_of(F.to_date("today")))
    return d.select(
        "id", F.concat_ws("-", y.cast("string"), period.quarter_name(q)).alias("last"), period.quarter_number(F.col("q")).alias("number"), period.day_of_ms(F.col("ms")).alias("day"), period.year_of_ms(F.when(F.col("ms") != 0, F.col("ms")), F.lit("2026-05-05").cast("date")).alias("year"),
        period.doc_type_of_quarter(F.col("kind")).alias("kind"), period.filing_folder(F.col("form"), F.col("n")).alias("folder"), period.any_date(F.col("d")).alias("date"),
    )


@query("search_windows", rows_sql("id INT, first DATE, last DATE", [(1, "2023-01-01", "2023-12-31"), (2, "2023-10-01", "2023-12-31"), (2, "2024-01-01", "2024-06-30"), (3, "2006-01-01", "2026-12-31"), (4, "1986-01-01", "2026-12-31")]))
def search_windows(spark, sf):
    """Spans of days in which reports and prospectuses are looked for."""
    d = spark.createDataFrame([(1, 2023, 2), (2, 2023, 4)], "id int, year int, quarter int").select("id", F.explode(period.search_windows(F.col("year"), F.col("quarter"))).alias("w"))
    today = F.lit("2026-03-03").cast("date")
    ipo = spark.createDataFrame([(3, 20), (4, 40)], "id int, back int").select("id", F.when(F.col("id") == 3, period.years_back(today, 20)).otherwise(period.years_back(today, 40)).alias("w"))
    return d.union(ipo).select("id", "w.first", "w.last")


@query("report_kinds", rows_sql(VARCHARS("doc_type", "kind", "quarter"), [("annual_reports", "annual", "Q4"), ("interim_reports", "interim", "Q2"), ("quarterly_reports", "quarterly", "Q3"), ("other", "annual", "Q4")]))
def report_kinds(spark, sf):
    """What a task looks for, by document type."""
    d = spark.createDataFrame([("annual_reports", None), ("interim_reports", None), ("quarterly_reports", "Q3"), ("other", None)], "doc_type string, q string")
    kind, quarter = period.report_kind(F.col("doc_type"), F.col("q"))
    return d.select("doc_type", kind.alias("kind"), quarter.alias("quarter"))


@query("title_period_ends", rows_sql("title VARCHAR, last DATE, year INT", [("截至2024年2月止", "2024-02-28", 2024), ("截至2023年6月30日止六個月", "2023-06-30", 2023), ("截至2023年3月31日止年度年報", "2023-03-31", 2022), ("截至2023年11月止", "2023-11-30", 2023), ("Circular", None, 2022)]))
def title_period_ends(spark, sf):
    """The last day and fiscal year of the period that titles report on; the year of release, less one up to April, where they name none."""
    d = spark.createDataFrame([("截至2024年2月止",), ("截至2023年6月30日止六個月",), ("截至2023年3月31日止年度年報",), ("截至2023年11月止",), ("Circular",)], "title string")
    return d.select("title", period.title_period_end(F.col("title")).alias("last"), period.title_year(F.col("title"), F.lit("2023-04-02").cast("date")).alias("year"))


@query("annual_quarters", "SELECT DISTINCT id, CASE WHEN doc_type IN ('annual_reports', '10k') THEN coalesce(quarter, 4) ELSE quarter END AS quarter FROM source_documents")
def annual_quarters(spark, sf):
    """Filings with both spellings of an annual report as one."""
    d = table(spark, sf, "source_documents", "id", "doc_type", "quarter")
    return d.select("id", period.annual_quarter(F.col("doc_type"), F.col("quarter")).alias("quarter")).distinct()


@query("silver_paths", "SELECT DISTINCT id, concat_ws('/', 'silver', market, doc_type, stock_code, CAST(year AS VARCHAR), CASE WHEN quarter IN (1, 2, 3) THEN 'Q' || quarter ELSE 'FY' END, 'document.md') AS path, concat_ws('/', 'gold', 'chunks', market, stock_code) AS gold, concat_ws('/', 'application', 'reports', 'a.json') AS application FROM source_documents")
def silver_paths(spark, sf):
    """Places of products of filings in the later layers; parts that are null are left out."""
    d, c, none = table(spark, sf, "source_documents", "id", "market", "doc_type", "stock_code", "year", "quarter"), F.col, F.lit(None).cast("string")
    path = paths.silver_period(c("market"), c("doc_type"), c("stock_code"), c("year"), c("quarter"), none, F.lit("document.md"))
    return d.select("id", path.alias("path"), paths.gold(F.lit("chunks"), c("market"), c("stock_code"), none).alias("gold"), paths.application(F.lit("reports"), none, F.lit("a.json")).alias("application")).distinct()


# ---- names and identifiers

@query("org_ids", rows_sql(VARCHARS("code", "org"), [("600519", "gssh0600519"), ("1", "gssz0000001"), ("830799", "gsbj0830799"), ("688001", "gssh0688001"), (None, None)]))
def org_ids(spark, sf):
    """Identifiers built from codes."""
    return spark.createDataFrame([("600519",), ("1",), ("830799",), ("688001",), (None,)], "code string").select("code", names.org_id(F.col("code")).alias("org"))


@query("resolved_ids", rows_sql(VARCHARS("code", "org"), [("600519", "a1"), ("000001", "b2"), ("688001", "gssh0688001")]))
def resolved_ids(spark, sf):
    """Identifiers from the first look-up table that has them, else built."""
    one, two = spark.createDataFrame([("600519", "a1")], "code string, org string"), spark.createDataFrame([("600519", "b1"), ("000001", "b2")], "code string, org string")
    return A.resolved(spark.createDataFrame([("600519",), ("000001",), ("688001",)], "code string"), [one, two], "code", "org", names.org_id(F.col("code")))


@query("hk_search", """
SELECT q AS query, code, CAST(row_number() OVER (PARTITION BY q ORDER BY code) AS INTEGER) AS place FROM (
  SELECT DISTINCT q, code FROM (SELECT unnest(['torka', 'Limited', '7']) AS q), companies c WHERE c.market = 'hk_stock' AND code IS NOT NULL AND CASE WHEN regexp_matches(q, '^[0-9]+$') THEN code = lpad(q, 5, '0') ELSE contains(lower(c.name), lower(q)) OR contains(lower(c.org_name_en), lower(q)) OR contains(lower(c.org_short_name_en), lower(q)) END)""")
def hk_search(spark, sf):
    """Companies of one market by code or by part of any name."""
    c = table(spark, sf, "companies", "code", "name", "org_name_en", "org_short_name_en", "market").where("market = 'hk_stock' AND code IS NOT NULL")
    q = spark.createDataFrame([("torka",), ("Limited",), ("7",)], "query string")
    return names.search_listed(c.select("code", F.array("name", "org_name_en", "org_short_name_en").alias("names")), q, 1_000_000)


@query("company_code_answers", rows_sql("query VARCHAR, code VARCHAR, candidates VARCHAR[], said VARCHAR", [("Alpha One", "000001", None, "found"), ("Beta", None, ["000002", "000003"], "choose"), ("Gam", None, None, "too many"), ("zz", None, None, "none")]))
def company_code_answers(spark, sf):
    """What a search for a company's code says, by the number of hits."""
    rows = [("000001", "Alpha One"), ("000002", "Beta East"), ("000003", "Beta West")] + [(f"{k:06d}", f"Gam {k}") for k in range(10, 17)]
    c = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], "code string, name string, org_name_en string, org_short_name_en string, pre_name string")
    return retrieval.company_code(c, spark.createDataFrame([("Alpha One",), ("Beta",), ("Gam",), ("zz",)], "query string"))


@query("loose_values", rows_sql("raw VARCHAR, n BIGINT", [("12", 12), (" 7.0 ", 7), ("1e3", 1000), ("nan", None), ("inf", None), ("x", None), (None, None), ("-3.9", -3)]))
def loose_values(spark, sf):
    """Whole numbers out of loose text."""
    return spark.createDataFrame([("12",), (" 7.0 ",), ("1e3",), ("nan",), ("inf",), ("x",), (None,), ("-3.9",)], "raw string").select("raw", text.loose_int(F.col("raw")).alias("n"))


@query("info_maps", rows_sql("id INT, name VARCHAR, staff VARCHAR, n INT", [(1, "Alpha", "12", 2), (2, None, "7", 1)]))
def info_maps(spark, sf):
    """Rows of item and value as one map an id; the texts None and nan are no values."""
    d = spark.createDataFrame([(1, "name", " Alpha "), (1, "staff", "12"), (1, "web", "None"), (2, "name", "nan"), (2, "staff", "7"), (2, " ", "x"), (2, None, "y")], "id int, item string, value string")
    m = d.groupBy("id").agg(text.info(F.col("item"), F.col("value")).alias("m"))
    return m.select("id", F.col("m")["name"].alias("name"), F.col("m")["staff"].alias("staff"), F.size("m").alias("n"))


@query("affiliate_industries", rows_sql(VARCHARS("raw", "code", "name"), [("{'ind_code': 'C39', 'ind_name': '制造'}", "C39", "制造"), ('{"ind_code": "J66"}', "J66", None), ("Mining", None, "Mining"), ("", None, None), (None, None, None)]))
def affiliate_industries(spark, sf):
    """Industry code and name out of JSON, of text like it, or of plain text."""
    d = spark.createDataFrame([("{'ind_code': 'C39', 'ind_name': '制造'}",), ('{"ind_code": "J66"}',), ("Mining",), ("",), (None,)], "raw string")
    code, name = text.code_and_name(F.col("raw"))
    return d.select("raw", code.alias("code"), name.alias("name"))


# ---- texts and pages

@query("folded_texts", rows_sql(VARCHARS("raw", "folded"), [("Ａ Ｂ　ｃ", "abc"), ("ﬁne １２", "fine12"), ("", ""), (None, None), ("Straße\n X", "straßex")]))
def folded_texts(spark, sf):
    """Texts in the form in which titles are compared."""
    return spark.createDataFrame([("Ａ Ｂ　ｃ",), ("ﬁne １２",), ("",), (None,), ("Straße\n X",)], "raw string").select("raw", text.folded("raw").alias("folded"))


@query("attachment_urls", rows_sql(VARCHARS("raw", "url"), [("/a/b.pdf", "https://files.example/a/b.pdf"), ("c.pdf", "https://files.example/c.pdf"), (" ", None), (None, None)]))
def attachment_urls(spark, sf):
    """Addresses of attachments."""
    return spark.createDataFrame([("/a/b.pdf",), ("c.pdf",), (" ",), (None,)], "raw string").select("raw", text.object_url("https://files.example/", F.col("raw")).alias("url"))


@query("token_counts", "SELECT doc_id, CAST(length(text) // 4 AS INTEGER) AS tokens FROM documents")
def token_counts(spark, sf):
    """About how many tokens each text has."""
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", text.tokens(F.col("text")).alias("tokens"))


@query("markdown_texts", rows_sql("id INT, plain VARCHAR", [(1, "Head\n\nSome bold and it, a link."), (2, "x   y"), (3, "code stays"), (4, None)]))
def markdown_texts(spark, sf):
    """Plain text of markdown."""
    d = spark.createDataFrame([(1, "# Head\n\n\n\nSome **bold** and *it*, a [link](http://x). ![p](a.png)"), (2, "x | y"), (3, "`code` stays```\ngone\n```"), (4, None)], "id int, md string")
    return d.select("id", text.markdown_text(F.col("md")).alias("plain"))


@query("html_texts", rows_sql("id INT, lines VARCHAR[]", [(1, ["Title", "First line", "Second"]), (2, ["one two"]), (3, None)]))
def html_texts(spark, sf):
    """Lines of pages without scripts, rules and repeats."""
    d = spark.createDataFrame([(1, "<head><title>no</title></head><h1>Title</h1><script>x()</script><p>First&nbsp;line</p>".replace("&nbsp;", " ") + "<p>First line</p><div>-----</div><p>Second</p>"), (2, "one<b> two</b>"), (3, None)], "id int, html string")
    return d.select("id", text.html_lines(F.col("html")).alias("lines"))


@query("loose_json", rows_sql("id INT, found VARCHAR", [(1, '[{"a": 1}]'), (2, '{"b": null}'), (3, '["x"]'), (4, "[]"), (5, "[]")]))
def loose_json(spark, sf):
    """JSON out of answers of a model."""
    d = spark.createDataFrame([(1, 'Here:\n```json\n[{"a": 1},]\n```'), (2, "so {'b': None}"), (3, "['x']"), (4, "no json"), (5, None)], "id int, answer string")
    return d.select("id", markup.json_of("answer").alias("found"))


@query("page_encodings", rows_sql("id INT, body VARCHAR, n INT", [(1, '<meta charset="gbk">中文', 24), (2, "<p>plain</p>", 12), (3, None, None)]))
def page_encodings(spark, sf):
    """Pages decoded in the encoding that they declare."""
    d = spark.createDataFrame([(1, bytearray('<meta charset="gbk">中文'.encode("gbk"))), (2, bytearray(b"<p>plain</p>")), (3, None)], "id int, content binary")
    return d.select("id", markup.page_text("content").alias("body"), F.octet_length("content").alias("n"))


@query("redeclared_pages", rows_sql("id INT, html VARCHAR", [(1, '<meta charset="utf-8"><p>charset=gbk</p>'), (2, '<?xml encoding="utf-8"?>'), (3, "<p>none</p>")]))
def redeclared_pages(spark, sf):
    """Pages whose first declaration names another encoding."""
    d = spark.createDataFrame([(1, '<meta charset="gbk"><p>charset=gbk</p>'), (2, '<?xml encoding="big5"?>'), (3, "<p>none</p>")], "id int, html string")
    return d.select("id", markup.redeclared(F.col("html"), "utf-8").alias("html"))


@query("rewritten_pages", rows_sql(VARCHARS("case_name", "outcome"), [("same", None), ("declaration", "declaration"), ("broken", "broken"), ("grown", "grown")]))
def rewritten_pages(spark, sf):
    """What rewriting pages did to their encoding."""
    page = lambda enc, body: f'<meta charset="{enc}">{body}'.encode(enc)
    good = page("utf-8", 'it’s <img src="a.png">')
    rows = [("same", good, markup.rewritten(good, {"a.png": "img/a.png"})), ("declaration", page("gbk", "x"), page("utf-8", "x")), ("broken", page("utf-8", "it’s"), page("utf-8", "itâ€™s")), ("grown", page("utf-8", "x" * 9), page("utf-8", "x" * 30000))]
    d = spark.createDataFrame([(n, bytearray(a), bytearray(b)) for n, a, b in rows], "case_name string, a binary, b binary")
    check = F.udf(lambda a, b: markup.kept_encoding(bytes(a), bytes(b)), "string", useArrow=True)
    return d.select("case_name", check("a", "b").alias("outcome"))


@query("image_keys", rows_sql(VARCHARS("key", "place"), [("https://h.example/f/a.png", "img/1.png"), ("a.png", "img/1.png"), ("/f/a.png", "img/1.png"), ("https://o.example/x/b.gif", "img/2.gif"), ("b.gif", "img/2.gif"), ("/x/b.gif", "img/2.gif")]))
def image_keys(spark, sf):
    """The names under which a page may refer to its images, and where they are now."""
    d = spark.createDataFrame([("https://h.example/f/p.htm", "a.png", "img/1.png"), ("https://h.example/f/p.htm", "https://o.example/x/b.gif", "img/2.gif")], "url string, src string, to string")
    return d.select(F.explode(markup.image_keys(F.col("url"), F.col("src"), F.col("to"))).alias("k")).select("k.key", "k.place")


@query("release_texts", rows_sql("id INT, said VARCHAR, at TIMESTAMP", [(1, "02/05/2024 16:30", "2024-05-02 16:30:00"), (2, "03/05/2024", "2024-05-03 00:00:00"), (3, "發放", None)]))
def release_texts(spark, sf):
    """Texts of releases without their labels, repaired, and as times."""
    d = spark.createDataFrame([(1, "Release Time: 02/05/2024 16:30"), (2, "發放時間:03/05/2024"), (3, "發放".encode("big5").decode("latin-1"))], "id int, raw string")
    said = d.select("id", markup.release_text(F.col("raw")).alias("said"))
    return said.select("id", "said", period.release_time(F.col("said")).cast("timestamp_ntz").alias("at"))


@query("document_urls", rows_sql(VARCHARS("cik", "name", "url"), [("0000320193", "a.htm", "320193/000032019324000001/a.htm"), ("0000320193", "", "320193/000032019324000001/index.html"), ("0000320193", None, "320193/000032019324000001/index.html")]))
def document_urls(spark, sf):
    """Paths of documents of filings; the index where no document is named."""
    d = spark.createDataFrame([("0000320193", "a.htm"), ("0000320193", ""), ("0000320193", None)], "cik string, name string")
    return d.select("cik", "name", files.document_url(F.col("cik"), F.lit("0000320193-24-000001"), F.col("name")).alias("url"))


@query("outlines", rows_sql("doc VARCHAR, text VARCHAR", [("a", "- One\n  - Two\n- Three"), ("b", "- Only")]))
def outlines(spark, sf):
    """Headings of documents as outlines."""
    d = spark.createDataFrame([("a", 2, 1, "Three"), ("a", 0, 1, "One"), ("a", 1, 2, "Two"), ("b", 0, 1, "Only")], "doc string, heading_index int, level int, title string")
    return retrieval.outline(d)


@query("text_faults", "SELECT doc_id, CASE WHEN coalesce(length(text), 0) <= 100 THEN 'short' WHEN length(text) - length(replace(text, chr(65533), '')) >= 0.01 * length(text) THEN 'garbled' END AS fault FROM documents")
def text_faults(spark, sf):
    """Texts that are too short or garbled."""
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", A.text_quality(F.col("text")).alias("fault"))


# ---- announcements

NEWS = [
    ("000001", "甲公司", "甲公司2023年年度报告", 300, "a1.pdf"), ("000001", "甲公司", "甲公司2023年年度报告摘要", 400, "a2.pdf"), ("000001", "甲公司", "甲公司2023年年度报告", 300, "a0.pdf"), ("000001", "甲公司", "甲公司2023年年度报告", 500, "a3.doc"),
    ("000009", "甲公司", "甲公司2023年第一季度报告", 100, "q1.PDF"), ("000002", "乙公司", "乙公司首次公开发行招股说明书", 50, "p1.pdf"), ("000002", "乙公司", "乙公司招股说明书附录", 60, "p2.pdf"), ("000002", "乙公司", "乙公司招股书", 70, "p3.html"), ("000002", "乙公司", None, 90, "p4.pdf"),
]


def news(spark):
    return spark.createDataFrame(NEWS, "code string, name string, title string, time_ms bigint, attachment string")


@query("latest_reports", rows_sql("task_code VARCHAR, quarter INT, code VARCHAR, attachment VARCHAR", [("000001", 4, "000001", "a0.pdf"), ("000001", 1, "000009", "q1.PDF")]))
def latest_reports(spark, sf):
    """The newest report of each task under any of the codes that the company has had."""
    t = spark.createDataFrame([("000001", 2023, 4, ["1", "000009"]), ("000001", 2023, 1, ["1", "9"]), ("000002", 2023, 4, ["2"])], "task_code string, year int, quarter int, codes array<string>")
    return A.latest_report(news(spark), t).select("task_code", "quarter", "code", "attachment")


@query("latest_prospectuses", rows_sql(VARCHARS("code", "attachment"), [("000002", "p3.html")]))
def latest_prospectuses(spark, sf):
    """The newest prospectus of each code."""
    return A.latest_prospectus(news(spark)).select("code", "attachment")


@query("best_reports", rows_sql(VARCHARS("code", "attachment"), [("1", "exact.pdf"), ("2", "year.pdf")]))
def best_reports(spark, sf):
    """For each code the report of the quarter, else of the year; exclusions by title."""
    rows = [("1", "Annual Report", 2023, "Q4", 10, "exact.pdf"), ("1", "Interim Report", 2023, "Q2", 99, "other.pdf"), ("1", "Clarification of annual report", 2023, "Q4", 50, "no.pdf"), ("2", "Results", 2023, None, 5, "year.pdf"), ("2", "Results", 2022, "Q4", 9, "old.pdf"), ("3", "通函 登記", 2023, "Q4", 9, "none.pdf")]
    d = spark.createDataFrame(rows, "code string, title string, fiscal_year int, fiscal_quarter string, time_ms bigint, attachment string")
    return A.best_report(d, 2023, "Q4").select("code", "attachment")


@query("report_titles", rows_sql("title VARCHAR, report BOOLEAN, prospectus BOOLEAN, annual BOOLEAN", [
    ("甲公司2023年年度报告", True, False, True), ("甲公司2023年年报摘要", True, False, False), ("补充公告 年报", False, False, False), ("乙公司招股说明书", False, True, False), ("招股书 更正", False, False, False), (None, False, False, False),
]))
def report_titles(spark, sf):
    """What titles say that an announcement is."""
    d = spark.createDataFrame([(x,) for x in ("甲公司2023年年度报告", "甲公司2023年年报摘要", "补充公告 年报", "乙公司招股说明书", "招股书 更正", None)], "title string")
    t = F.col("title")
    return d.select("title", A.is_report(t).alias("report"), A.is_prospectus(t).alias("prospectus"), A.of_period(t, F.lit(2023), F.lit(4)).alias("annual"))


@query("code_change_cases", rows_sql("org VARCHAR, requested_code VARCHAR, main_code VARCHAR, accepted BOOLEAN", [("a", "000001", "000001", True), ("b", "000002", "000003", True), ("c", "000004", "000005", False), ("d", "000006", "000007", True)]))
def code_change_cases(spark, sf):
    """Under which code companies announce, and whether it is the same company as the one asked for."""
    rows = [("a", "000001", "Alpha"), ("b", "000002", "Beta"), ("b", "000003", "Beta"), ("b", "000003", "Beta A"), ("c", "000004", "Gamma"), ("c", "000005", "Delta"), ("c", "000005", "Delta"), ("d", "000007", "Eta")]
    asked = spark.createDataFrame([("a", "000001"), ("b", "000002"), ("c", "000004"), ("d", "000006")], "org string, requested_code string")
    return A.code_change(spark.createDataFrame(rows, "org string, code string, name string"), asked)


@query("code_histories", rows_sql("id INT, codes VARCHAR[]", [(1, ["3", "1", "2"]), (2, ["5"])]))
def code_histories(spark, sf):
    """The codes that companies have had, each once, the current one first."""
    d = spark.createDataFrame([(1, "3", ["1", "2", "3", None]), (2, "5", None)], "id int, code string, former array<string>")
    return d.select("id", A.all_codes(F.col("code"), F.col("former")).alias("codes"))


@query("merged_codes", rows_sql("org VARCHAR, codes VARCHAR[]", [("a", ["000001", "000002", "000009"]), ("b", ["000005"])]))
def merged_codes(spark, sf):
    """Known codes of companies with new ones added: those known first, each once, padded."""
    old, new = spark.createDataFrame([("a", ["000001", "000002"])], "org string, codes array<string>"), spark.createDataFrame([("a", ["2", "9"]), ("b", ["5"])], "org string, more array<string>")
    met = old.join(new, "org", "full")
    none = F.array().cast("array<string>")
    return met.select("org", F.array_union(F.coalesce("codes", none), F.transform(F.coalesce("more", none), names.padded_code)).alias("codes"))


@query("registrants", rows_sql(VARCHARS("cik", "ticker", "name", "tickers"), [("0000000012", "BB", "Beta Inc", "AA,BB"), ("0000000034", "CC", "Gamma", "CC")]))
def registrants(spark, sf):
    """One row a registrant with its first and all its tickers."""
    d = spark.createDataFrame([(12, "BB", "Beta Inc", 1), (12, "AA", "Beta", 2), (34, "CC", "Gamma", 3)], "cik int, ticker string, name string, place int")
    return A.by_registrant(d)


# ---- retrieval surface

@query("filter_conditions", "SELECT DISTINCT id FROM source_documents WHERE stock_code IN (SELECT max(stock_code) FROM source_documents) OR (market IN ('hk_stock', 'us_stock') AND doc_type = 'annual_reports' AND year = 2023)")
def filter_conditions(spark, sf):
    """Filings by conditions built from values: lists, single values, and empty ones that do not filter."""
    d = table(spark, sf, "source_documents", "id", "stock_code", "market", "doc_type", "company_name", "year", "quarter")
    last = d.agg(F.max("stock_code").alias("stock_code"))
    one = d.join(F.broadcast(last), "stock_code", "left_semi").select("id")  # one row
    return one.union(d.where(retrieval.filter_by({"market": ["hk_stock", "us_stock"], "doc_type": "annual_reports", "year": 2023, "quarter": None, "stock_code": ""})).select("id")).distinct()


@query("request_checks", rows_sql("request VARCHAR, ok BOOLEAN", [("weights", True), ("weights range", False), ("weights key", False), ("type", True), ("type unknown", False), ("quarter", False), ("graph", True), ("graph unknown", False), ("column", False)]))
def request_checks(spark, sf):
    """Which requests are refused."""
    calls = {
        "weights": lambda: retrieval.check_weights({"vector": 0.3}), "weights range": lambda: retrieval.check_weights({"vector": 1.5}), "weights key": lambda: retrieval.check_weights({"graph": 0.5}),
        "type": lambda: retrieval.check_request(doc_types=["10k", "annual_reports"]), "type unknown": lambda: retrieval.check_request(doc_types=["novel"]), "quarter": lambda: retrieval.check_request(quarter=5),
        "graph": lambda: retrieval.check_request(graph="hierarchy"), "graph unknown": lambda: retrieval.check_request(graph="path"), "column": lambda: retrieval.filter_by({"color": "red"}),
    }
    rows = []
    for name, call in calls.items():
        try:
            call()
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "request string, ok boolean")


@query("formatted_passages", rows_sql("rank INT, passage VARCHAR", [(1, "[1] Alpha, 2023 Q2\nNotes\nBody one"), (2, "[2] Beta, 2022\nBody two")]))
def formatted_passages(spark, sf):
    """Passages as they stand in a context."""
    d = spark.createDataFrame([(1, "Alpha", 2023, 2, "Notes", "Body one"), (2, "Beta", 2022, None, "", "Body two")], "rank int, company string, year int, quarter int, title string, text string")
    c = F.col
    return d.select("rank", retrieval.passage(c("rank"), c("company"), retrieval.period_text(c("year"), c("quarter")), c("title"), c("text")).alias("passage"))


@query("source_lines", rows_sql("text VARCHAR", [("[1] Alpha, 2023 Q2\n[2] Beta, 2022",)]))
def source_lines(spark, sf):
    """The numbered sources that are put under a context."""
    d = spark.createDataFrame([(2, "Beta", 2022, None), (1, "Alpha", 2023, 2)], "rank int, company string, year int, quarter int")
    return retrieval.source_lines(d.select("rank", "company", retrieval.period_text(F.col("year"), F.col("quarter")).alias("period")))


@query("answers", rows_sql(VARCHARS("question", "said"), [("which?", "2 passages"), ("nothing?", "No passage was found for this question.")]))
def answers(spark, sf):
    """An answer by a stand-in for a model, with passages and without."""
    hits = spark.createDataFrame([(1, "first passage"), (2, "second one"), (3, "x" * 90)], "rank int, text string")
    model = lambda prompt: f"{prompt.count(chr(10) + chr(10))} passages"
    return spark.createDataFrame([(q, retrieval.answer(q, h, 60, model)) for q, h in (("which?", hits), ("nothing?", hits.limit(0)))], "question string, said string")


@query("response_rows", rows_sql("query VARCHAR, kind VARCHAR, total INT, id VARCHAR, score DOUBLE", [("q" * 100, "vector", 2, "a", 1.0), ("q" * 100, "vector", 2, "b", 0.5)]))
def response_rows(spark, sf):
    """Hits with what was asked, cut to 100 characters, and their number."""
    d = spark.createDataFrame([("a", 1.0, 1), ("b", 0.5, 2)], "id string, score double, rank int")
    return retrieval.response(d, "q" * 150, "vector", 10).select("query", "kind", "total", "id", "score")


@query("distance_scores", "SELECT vec_id, round(1 / (1 + sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)))), 6) AS score FROM embeddings")
def distance_scores(spark, sf):
    """The scores of vectors by their distance from the origin."""
    zero = F.array_repeat(F.lit(0.0), F.size("embedding"))
    return table(spark, sf, "embeddings", "vec_id", "embedding").select("vec_id", F.round(search.distance_score(search.l2(F.col("embedding"), zero)), 6).alias("score"))


def queries():
    return query.queries


def oracle_sql():
    return query.sql
