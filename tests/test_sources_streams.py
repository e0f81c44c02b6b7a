import io
import zipfile

from pyspark.sql import functions as F

from graniteflow.sources import files
from graniteflow.streaming import incremental as inc


def test_task_list_in_two_encodings(spark, tmp_path):
    for name, encoding in (("a.csv", "utf-8-sig"), ("b.csv", "gbk")):
        (tmp_path / name).write_bytes("code,name,year,quarter\n1,平安银行,2023,\n600000,浦发银行,2022,q2\n,无,2022,Q1\n5,缺,x,Q1\n".encode(encoding))
        got = sorted(tuple(r) for r in files.task_list(spark, str(tmp_path / name)).collect())
        assert got == [("000001", "平安银行", 2023, "Q4"), ("600000", "浦发银行", 2022, "Q2")]


def test_listing_and_reports(spark, tmp_path):
    (tmp_path / "SH").mkdir()
    for n in ("600000_2023_Q4_20240301.pdf", "600000_2023_Q9_x.pdf", "note.txt"):
        (tmp_path / "SH" / n).write_bytes(b"x")
    found = files.listing(spark, str(tmp_path))
    assert found.count() == 3
    assert [tuple(r) for r in files.existing_reports(found).collect()] == [("600000", 2023, "Q4")]


def test_hashes_of_bytes_fill_what_is_missing(spark, tmp_path):
    import hashlib

    for n, b in (("a.png", b"abc"), ("b.png", b"\x00\xff"), ("c.png", b"")):
        (tmp_path / n).write_bytes(b)
    objects = spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    rows = spark.createDataFrame([(1, "a.png", None), (2, "a.png", "kept"), (3, "b.png", None), (4, "c.png", None), (5, "gone", None), (6, None, None)], "id int, file string, file_hash string")
    got = {r["id"]: r["file_hash"] for r in files.filled_hashes(rows, objects, "file").collect()}
    assert got == {1: hashlib.sha256(b"abc").hexdigest(), 2: "kept", 3: hashlib.sha256(b"\x00\xff").hexdigest(), 4: None, 5: None, 6: None}
    md5 = objects.where("path = 'b.png'").select(files.digest(F.col("content"))).first()[0]
    assert md5 == hashlib.md5(b"\x00\xff").hexdigest()


def test_csv_is_read_back_by_others(spark, tmp_path):
    import csv

    d = spark.createDataFrame([("1", 'a "b", c', None), ("2", "", "两\n行")], "code string, name string, note string").coalesce(1)
    files.write_csv(d, f"{tmp_path}/out")
    (name,) = (tmp_path / "out").glob("*.csv")
    with open(name, encoding="utf-8", newline="") as f:
        assert list(csv.reader(f)) == [["code", "name", "note"], ["1", 'a "b", c', ""], ["2", "", "两\n行"]]


def test_whole_pdf(spark):
    good = b"%PDF-1.4" + b"0" * 1100 + b"%%EOF\n"
    d = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(good[:900])), (3, bytearray(b"x" + good)), (4, bytearray(good + b"0" * 1100)), (5, None)], "id int, content binary")
    assert [r["id"] for r in d.where(files.complete_pdf(F.col("content"))).collect()] == [1]


def test_filings_out_of_parallel_arrays(spark, tmp_path):
    body = '{"cik":"0000320193","fiscalYearEnd":"0926","filings":{"recent":{"accessionNumber":["0-1-2","0-1-3","0-1-4"],"form":["10-K","10-K/A","8-K"],"filingDate":["2024-11-01","bad","2024-11-02"],"reportDate":["2024-09-28","",""],"primaryDocument":["a.htm","",""]}}}'
    (tmp_path / "s.json").write_text(body)
    raw = files.read_json(spark, str(tmp_path / "s.json"), files.FILINGS)
    got = files.filings(raw, ["10-K", "10-K/A"], "2024-01-01", "2024-12-31").collect()
    assert [(r["form"], r["is_amendment"], r["url"]) for r in got] == [("10-K", False, "320193/012/a.htm")]


def test_links_and_archives(spark):
    html = "<table><tr><td>01/02/2024 09:30</td><td><a href='/x.pdf'>Annual <b>Report</b></a></td></tr><tr><td>soon</td><td><a href='/y'>Z</a></td></tr><tr><td>03/02/2024</td><td>none</td></tr></table>"
    got = files.table_links(spark.createDataFrame([("d", html), ("e", None)], "doc string, html string")).collect()
    assert [(r["title"], r["href"]) for r in got] == [("Annual Report", "/x.pdf")]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("out/full.md", "# T")
        z.writestr("out/images/1.png", b"1")
    a = spark.createDataFrame([("p", bytearray(data.getvalue())), ("q", bytearray(b"no zip"))], "path string, content binary")
    assert sorted((r["path"], r["kind"], r["text"]) for r in files.archive_members(a).collect()) == sorted([("p", "markdown", "# T"), ("p", "image", None), ("q", "broken", None)], key=str)


def test_windows_and_versions_of_a_stream(spark, sf, tmp_path):
    source = tmp_path / "in"
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.limit(300).coalesce(1).write.parquet(str(source))
    stream = inc.arrivals(spark, str(source), events.schema)
    q = inc.append_now(inc.windowed_counts(stream, "ts", "event_type"), str(tmp_path / "w"), str(tmp_path / "c1"))
    q.awaitTermination(120)
    assert 0 < spark.read.parquet(str(tmp_path / "w")).agg(F.sum("n")).first()[0] <= 300
    target = str(tmp_path / "t")
    inc.upsert_now(inc.arrivals(spark, str(source), events.schema), ["user_id"], "ts", target, str(tmp_path / "c2")).awaitTermination(120)
    users = inc.upserted(spark, target)
    assert users.count() == users.select("user_id").distinct().count() == events.limit(300).select("user_id").distinct().count()
    events.where("event_id >= 300").limit(50).coalesce(1).write.mode("append").parquet(str(source))
    inc.upsert_now(inc.arrivals(spark, str(source), events.schema), ["user_id"], "ts", target, str(tmp_path / "c2")).awaitTermination(120)
    newest = spark.read.parquet(str(source)).groupBy("user_id").agg(F.max("ts").alias("ts"))
    now = inc.upserted(spark, target)
    assert now.select("user_id", "ts").exceptAll(newest).isEmpty() and now.count() == newest.count()
    for k in range(3):  # versions that no manifest needs go
        events.where(f"event_id >= {400 + k}").limit(500).coalesce(1).write.mode("append").parquet(str(source))
        inc.upsert_now(inc.arrivals(spark, str(source), events.schema), ["user_id"], "ts", target, str(tmp_path / "c2")).awaitTermination(120)
    newest = spark.read.parquet(str(source)).groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert inc.upserted(spark, target).select("user_id", "ts").exceptAll(newest).isEmpty()
    assert not (tmp_path / "t" / "v0").exists() or any("0" in p.read_text() for p in (tmp_path / "t" / "manifests").glob("*.json"))


def test_what_is_to_do(spark):
    d = spark.sql("SELECT * FROM VALUES (1, NULL, 5), (2, 4, 3), (3, 4, 6) t(id, done, changed)")
    assert sorted(r["id"] for r in inc.to_do(d, "done", "changed").collect()) == [1, 3]


def test_a_cluster_needs_a_shared_folder(spark):
    import pytest

    from graniteflow import session

    class Context:
        master = "spark://host:7077"
        _jsc = property(lambda self: self)
        sc = lambda self: self
        getCheckpointDir = lambda self: self
        isDefined = lambda self: False

    class Session:
        sparkContext = Context()
        conf = property(lambda self: self)
        get = lambda self, name, default: default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
