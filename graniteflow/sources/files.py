"""Sources and sinks beside the Parquet tables: task lists, object listings, JSON, nested filings, archives."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.functions import names


ENCODINGS = ("utf-8-sig", "gbk", "gb2312")


def raw_tasks(spark: SparkSession, path: str, encodings: tuple[str, ...]) -> DataFrame:
    """(code, name, year, quarter) of CSV files as they are but for blanks and padded codes.

    A file is read in the first encoding that fits all of it. Task lists are small; each file is decoded by one task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for content in pdf["content"]:
                for encoding in encodings:
                    try:
                        body = bytes(content).decode(encoding)
                        break
                    except UnicodeDecodeError:
                        body = ""
                for r in csv.DictReader(io.StringIO(body)):
                    r = {(k or "").strip().lower(): v for k, v in r.items()}
                    rows.append(tuple(r.get(c) for c in ("code", "name", "year", "quarter")))
            yield pd.DataFrame(rows, columns=["code", "name", "year", "quarter"])

    raw = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "code string, name string, year string, quarter string")
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    return raw.select(names.padded_code(filled("code")).alias("code"), filled("name").alias("name"), filled("year").try_cast("int").alias("year"), F.upper(filled("quarter")).alias("quarter"))


def task_list(spark: SparkSession, path: str, encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """(code, name, year, quarter) of CSV files of tasks; rows without code, name or year are dropped, Q4 is the default."""
    rows = raw_tasks(spark, path, encodings).withColumn("quarter", F.coalesce("quarter", F.lit("Q4")))
    return rows.where("code IS NOT NULL AND name IS NOT NULL AND year IS NOT NULL")


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the objects below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", "length", "modificationTime")


def existing_reports(objects: DataFrame) -> DataFrame:
    """(code, year, quarter) out of object names code_year_quarter_date.pdf; other names give no row."""
    name = F.regexp_extract("path", r"([^/]+)\.pdf$", 1)
    part = F.split(name, "_")
    rows = objects.select(F.get(part, F.lit(0)).alias("code"), F.get(part, F.lit(1)).try_cast("int").alias("year"), F.get(part, F.lit(2)).alias("quarter"))
    return rows.where("code <> '' AND year IS NOT NULL AND quarter RLIKE '^Q[1-4]$'").distinct()


def complete_pdf(content: Column) -> Column:
    """Whether bytes are a whole PDF: at least 1,024, the right start, and the end mark within the last 1,024."""
    n = F.octet_length(content)
    head = F.decode(F.substring(content, 1, 5), "ISO-8859-1")
    tail = F.decode(F.substring(content, F.greatest(n - 1023, F.lit(1)), F.lit(1024)), "ISO-8859-1")
    return F.coalesce((n >= 1024) & (head == "%PDF-") & tail.contains("%%EOF"), F.lit(False))


def digest(content: Column, algorithm: str = "md5") -> Column:
    """The digest of bytes as lower-case hex digits; null for null."""
    if algorithm not in ("md5", "sha256"):
        raise ValueError(f"unknown algorithm {algorithm}")
    return F.md5(content) if algorithm == "md5" else F.sha2(content, 256)


def filled_hashes(rows: DataFrame, objects: DataFrame, path: str, column: str = "file_hash") -> DataFrame:
    """Rows whose null hashes are the SHA-256 of their object (path, content); missing and empty objects leave null.

    Bytes are not moved, only digests; rows without a hash meet those. Paths are compared as they are.
    """
    wanted = rows.where(F.col(column).isNull()).select(F.col(path).alias("path")).distinct()
    hashed = objects.where(F.octet_length("content") > 0).select("path", digest(F.col("content"), "sha256").alias("__hash"))
    found = hashed.join(wanted, "path", "left_semi").groupBy("path").agg(F.min("__hash").alias("__hash")).withColumnRenamed("path", "__path")
    met = rows.join(found, F.col(column).isNull() & (F.col(path) == F.col("__path")), "left")
    return met.select(*(F.coalesce(c, "__hash").alias(c) if c == column else F.col(c) for c in rows.columns))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with a header each: quotes doubled, null and empty texts empty."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a row."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, each a file or a line."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


FILINGS = "cik string, fiscalYearEnd string, filings struct<recent: struct<accessionNumber: array<string>, form: array<string>, filingDate: array<string>, reportDate: array<string>, primaryDocument: array<string>>>"


def filings(submissions: DataFrame, forms: list[str], start: str, end: str) -> DataFrame:
    """One row a filing out of parallel arrays; of the given forms, filed between two days; undated ones are dropped."""
    names_ = ("accessionNumber", "form", "filingDate", "reportDate", "primaryDocument")
    zipped = F.arrays_zip(*(F.col(f"filings.recent.{n}").alias(n) for n in names_))
    f = submissions.select("cik", "fiscalYearEnd", F.explode(zipped).alias("f")).select("cik", "fiscalYearEnd", "f.*")
    day = lambda c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")
    rows = f.withColumns({"filed": day("filingDate"), "reported": day("reportDate"), "is_amendment": F.endswith("form", F.lit("/A"))})
    rows = rows.where(F.col("form").isin(forms) & F.col("filed").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return rows.select("cik", "form", "filed", "reported", "is_amendment", F.col("accessionNumber").alias("accession"), document_url(F.col("cik"), F.col("accessionNumber"), F.col("primaryDocument")).alias("url"))


def document_url(cik: Column, accession: Column, name: Column) -> Column:
    """The path of a filing's document; the index page where it has no name."""
    return F.concat_ws("/", F.regexp_replace(cik, "^0+", ""), F.regexp_replace(accession, "-", ""), F.coalesce(F.nullif(name, F.lit("")), F.lit("index.html")))


class LinkRows(HTMLParser):
    """Rows of tables with the text of their cells and their first link."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[str | None, list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append((None, []))
        elif tag in ("td", "th"):
            self.cell = []
        elif tag == "a" and self.rows and self.rows[-1][0] is None:
            self.rows[-1] = (dict(attrs).get("href"), self.rows[-1][1])

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1][1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_links(pages: DataFrame) -> DataFrame:
    """(doc, title, href, released) of the rows of tables in pages (doc, html) that have a link and a time dd/MM/yyyy [HH:mm]."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, html in zip(pdf["doc"], pdf["html"]):
                parser = LinkRows()
                parser.feed(html or "")
                rows += [(doc, cells[-1] if cells else None, href, cells[0] if cells else None) for href, cells in parser.rows if href]
            yield pd.DataFrame(rows, columns=["doc", "title", "href", "released"])

    found = pages.select(F.col("doc").cast("string").alias("doc"), "html").mapInPandas(run, "doc string, title string, href string, released string")
    time = F.coalesce(F.try_to_timestamp("released", F.lit("dd/MM/yyyy HH:mm")), F.try_to_timestamp("released", F.lit("dd/MM/yyyy")))
    return found.withColumn("released", time).where("released IS NOT NULL AND href <> ''")


def archive_members(archives: DataFrame) -> DataFrame:
    """(path, member, kind, size, text) of zip archives (path, content); text only of markdown and JSON members."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        for i in z.infolist():
                            if not i.is_dir():
                                ext = i.filename.rsplit(".", 1)[-1].lower()
                                kind = {"md": "markdown", "json": "json"}.get(ext, "image" if ext in ("png", "jpg", "jpeg") else "other")
                                rows.append((path, i.filename, kind, i.file_size, z.read(i).decode("utf-8", "replace") if kind in ("markdown", "json") else None))
                except zipfile.BadZipFile:
                    rows.append((path, None, "broken", len(content or b""), None))
            yield pd.DataFrame(rows, columns=["path", "member", "kind", "size", "text"])

    return archives.select("path", "content").mapInPandas(run, "path string, member string, kind string, size bigint, text string")


def offer_list(spark: SparkSession, path: str) -> DataFrame:
    """(code, name) of CSV files of tasks for prospectuses, which have no period; rows without code or name are dropped."""
    return raw_tasks(spark, path, ENCODINGS).select("code", "name").where("code IS NOT NULL AND name IS NOT NULL")


def cached(tasks: DataFrame, reports: DataFrame) -> DataFrame:
    """Tasks (code, year, quarter) with ``cached``: whether their report is there."""
    keys = ["code", "year", "quarter"]
    return tasks.join(reports.select(*keys).distinct().withColumn("cached", F.lit(True)), keys, "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


def submission(rows: DataFrame) -> DataFrame:
    """(cik, name, exchanges, tickers): blank names as none, exchanges joined, tickers each once in order."""
    joined = F.nullif(F.array_join("exchanges", ","), F.lit(""))
    return rows.select("cik", F.nullif(F.trim("name"), F.lit("")).alias("name"), joined.alias("exchanges"), F.array_distinct("tickers").alias("tickers"))


def primary_document(html: Column) -> Column:
    """The longest relative link to a page that is no index, the first of equally long ones; null if there is none."""
    links = F.filter(F.regexp_extract_all(html, F.lit("(?i)href\\s*=\\s*[\"']([^\"']+[.]html?)[\"']"), F.lit(1)), lambda h: ~h.contains("/") & ~F.lower(h).contains("index"))
    longest = F.array_max(F.transform(links, lambda h: F.length(h)))
    return F.get(F.filter(links, lambda h: F.length(h) == longest), F.lit(0))


PARSER_OUTPUT = "markdown string, pages array<struct<tables: array<struct<html: string>>, images: array<struct<path: string>>>>"


def parser_output(rows: DataFrame) -> DataFrame:
    """(id, text_length, pages_count, tables_count, images_count, images) out of a parser's JSON (id, body); images as page:path.

    A body that is no such JSON has no text and no pages.
    """
    p = rows.select("id", F.from_json("body", PARSER_OUTPUT).alias("p"))
    pages = F.coalesce("p.pages", F.array().cast("array<struct<tables: array<struct<html: string>>, images: array<struct<path: string>>>>"))
    total = lambda field: F.aggregate(pages, F.lit(0), lambda s, x: s + F.coalesce(F.size(x[field]), F.lit(0)))
    images = F.flatten(F.transform(pages, lambda x, i: F.transform(F.coalesce(x["images"], F.array().cast("array<struct<path: string>>")), lambda m: F.concat_ws(":", i.cast("string"), m["path"]))))
    return p.select("id", F.length("p.markdown").alias("text_length"), F.size(pages).alias("pages_count"), total("tables").alias("tables_count"), total("images").alias("images_count"), images.alias("images"))


def merged_metadata(own: Column, more: Column, replaced: str) -> Column:
    """Two maps as one: keys of ``own`` win, but the value under ``replaced`` is that of ``more`` where it has one."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(own, none), F.coalesce(more, none)
    kept = F.map_filter(a, lambda k, v: ~((k == replaced) & F.map_contains_key(b, replaced)))
    return F.map_concat(kept, F.map_filter(b, lambda k, v: ~F.map_contains_key(kept, k)))


def year_of_name(name: Column, otherwise: Column) -> Column:
    """The first year of this or the last century in a file name, else another one."""
    return F.coalesce(F.regexp_extract(name, "(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1).try_cast("int"), otherwise)


def stock_list(active: DataFrame, inactive: DataFrame, ids: DataFrame, kind: str, width: int = 5) -> DataFrame:
    """(code, active, kind, org_id): active rows (code, category), then inactive ones of other codes, of one kind, that have an identifier.

    The kind is how a category begins; what it has in brackets comes out. Codes are filled up with zeros.
    """
    padded = lambda c: F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(F.col(c))
    a = active.select(padded("code").alias("code"), "category", F.lit(True).alias("active"))
    b = inactive.select(padded("code").alias("code"), "category", F.lit(False).alias("active")).join(a.select("code"), "code", "left_anti")
    fit = a.unionByName(b).where(F.col("category").startswith(kind))
    return fit.join(ids, "code").select("code", "active", F.regexp_extract("category", r"\(([^)]*)\)", 1).alias("kind"), "org_id")
