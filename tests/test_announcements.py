import datetime as dt

from pyspark.sql import functions as F

from graniteflow.functions import period
from graniteflow.operators import announcements as A

ROWS = [
    ("000001", "平安银行", "平安银行：2023年年度报告", 5, "a.PDF"),
    ("1", "平安银行", "平安银行：2023年年度报告（更新后）", 9, "b.pdf"),
    ("000001", "平安银行", "2023年年度报告摘要", 20, "c.pdf"),
    ("000001", "平安银行", "2023年年度报告（英文版）", 21, "d.pdf"),
    ("000001", "平安银行", "2023年年度报告", 30, "e.doc"),
    ("000009", "平安银行", "2023年第一季度报告", None, "f.pdf"),
    ("000009", "平安银行", None, 40, "g.pdf"),
    ("300001", "某", "招股说明书", 1, "h.html"),
    ("300001", "某", "招股说明书（注册稿）", 2, "i.pdf"),
]
SCHEMA = "code string, name string, title string, time_ms bigint, attachment string"


def test_latest_report_and_prospectus(spark):
    a = spark.createDataFrame(ROWS, SCHEMA)
    t = spark.createDataFrame([("000001", 2023, 4, ["1"]), ("000001", 2023, 1, ["000001", "000009"]), ("000001", 2022, 4, ["1"])], "task_code string, year int, quarter int, codes array<string>")
    got = {(r["task_code"], r["quarter"]): r["attachment"] for r in A.latest_report(a, t).collect()}
    assert got == {("000001", 4): "b.pdf", ("000001", 1): "f.pdf"}
    assert [r["attachment"] for r in A.latest_prospectus(a).collect()] == ["h.html"]
    assert A.latest_report(a.limit(0), t).count() == 0


def test_best_report(spark):
    rows = [("1", "Annual Report", 5, "a", 2023, "Q4"), ("1", "Interim results", 9, "b", 2023, "Q2"), ("1", "澄清公告 annual", 99, "c", 2023, "Q4"), ("2", "業績", 3, "d", 2023, "Q2"), ("2", "通知信函", 9, "e", 2023, "Q4"), ("3", "Annual", 1, "f", 2022, "Q4")]
    a = spark.createDataFrame(rows, "code string, title string, time_ms bigint, attachment string, fiscal_year int, fiscal_quarter string")
    assert sorted((r["code"], r["attachment"]) for r in A.best_report(a, 2023, "Q4").collect()) == [("1", "a"), ("2", "d")]


def test_code_changes_and_registrants(spark):
    rows = [("o", "2", "新名"), ("o", "2", "新名"), ("o", "1", "新名A"), ("p", "8", "甲"), ("p", "8", "甲"), ("p", "7", "乙"), ("q", "5", "丙")]
    a = spark.createDataFrame(rows, "org string, code string, name string")
    asked = spark.createDataFrame([("o", "1"), ("p", "7"), ("q", "4")], "org string, requested_code string")
    assert {(r["org"], r["main_code"], r["accepted"]) for r in A.code_change(a, asked).collect()} == {("o", "2", True), ("p", "8", False), ("q", "5", True)}
    t = spark.createDataFrame([(7, "B", "x", 2), (7, "A", "y", 1)], "cik int, ticker string, name string, place int")
    assert [tuple(r) for r in A.by_registrant(t).collect()] == [("0000000007", "A", "y", "A,B")]
    c = spark.createDataFrame([("2", ["1", "2", None]), ("3", None)], "a string, b array<string>")
    assert [r[0] for r in c.select(A.all_codes(F.col("a"), F.col("b"))).collect()] == [["2", "1"], ["3"]]
    k = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    one, two = spark.createDataFrame([("a", "1")], "code string, org string"), spark.createDataFrame([("a", "9"), ("b", "2")], "code string, org string")
    assert sorted((r["code"], r["org"]) for r in A.resolved(k, [one, two], "code", "org", F.concat(F.lit("gs"), F.col("code"))).collect()) == [("a", "1"), ("b", "2"), ("c", "gsc")]


def test_years_and_windows(spark):
    rows = [("截至2023年3月31日止年度年報", 2022, dt.date(2023, 3, 31)), ("截至2023年2月止三個月", 2023, dt.date(2023, 2, 28)), ("2022/23 annual report", 2022, None), ("二零二一年年報", 2021, None), ("results", 2019, None), (None, 2019, None)]
    d = spark.createDataFrame(rows, "t string, y int, e date")
    released = F.lit("2020-03-01").cast("date")
    assert all(r["a"] == r["y"] and r["b"] == r["e"] for r in d.select("y", "e", period.title_year(F.col("t"), released).alias("a"), period.title_period_end(F.col("t")).alias("b")).collect())
    w = spark.createDataFrame([(2023, 2), (2023, 4)], "y int, q int").select(period.search_windows(F.col("y"), F.col("q")).alias("w")).collect()
    assert [[(str(x["first"]), str(x["last"])) for x in r["w"]] for r in w] == [[("2023-01-01", "2023-12-31")], [("2023-10-01", "2023-12-31"), ("2024-01-01", "2024-06-30")]]


def test_text_quality(spark):
    d = spark.createDataFrame([("x" * 200,), ("x" * 50,), ("x" * 95 + "\ufffd" * 8,), (None,)], "t string")
    assert [r[0] for r in d.select(A.text_quality(F.col("t"))).collect()] == [None, "short", "garbled", "short"]
