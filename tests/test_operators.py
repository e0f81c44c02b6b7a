import datetime as dt

from pyspark.sql import functions as F

from graniteflow.functions import names, period, text
from graniteflow.operators import lifecycle, search, stats, structure


def one(df):
    return [tuple(r) for r in df.collect()]


def test_fusion_of_two_lists(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2)], "id string, rank int")
    t = spark.createDataFrame([("b", 1), ("c", 2)], "id string, rank int")
    got = {r["id"]: round(r["score"], 9) for r in search.fuse([(v, 0.6), (t, 0.4)], "id", 5).collect()}
    assert got == {"b": 0.016234796, "a": 0.009836066, "c": 0.006451613}
    even = one(search.fuse([(v, 0.0), (t.where("rank > 5"), 0.0)], "id", 5))
    assert [r[0] for r in even] == ["a", "b"]


def test_vector_search_ignores_bad_vectors(spark):
    v = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [1.0]), (5, [3.0, 1.0])], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(9, [0.0, 1.0])], "query int, q array<float>")
    assert [(r["vec_id"], r["distance"]) for r in search.nearest(v, q, "vec_id", 2).collect()] == [(1, 0.0), (2, 0.0)]


def test_blocks_give_what_one_scan_gives(spark):
    import random

    rng = random.Random(4)
    rows = [(k, [float(rng.randrange(4)) for _ in range(3)]) for k in range(90)] + [(900, None), (901, [1.0]), (902, [1.0, None, 2.0])]
    v = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    q = v.where("vec_id % 10 = 0 AND vec_id < 900").selectExpr("vec_id AS query", "embedding AS q")
    one, two = search.nearest(v.where("vec_id < 900"), q, "vec_id", 4), search.nearest_in_blocks(v, q, "vec_id", 4, 20, 3)
    key = lambda df: sorted(tuple(r) for r in df.select("query", "vec_id", "distance", "rank").collect())
    assert key(one) == key(two)
    assert search.nearest_in_blocks(v.limit(0), q, "vec_id", 4).count() == 0


def test_context_stops_at_the_first_that_does_not_fit(spark):
    hits = spark.createDataFrame([(1, "aaaa"), (2, "bbbbbbbb"), (3, "c")], "rank int, text string")
    assert [r["rank"] for r in search.pack_context(hits, "text", 6).collect()] == [1]


def test_scan_of_pending_filings_is_whole(spark, tmp_path):
    from graniteflow.plans.lifecycle_plans import scan_pending

    start = dt.datetime(2024, 1, 1)
    rows = [(f"d{k:03d}", f"a/{k}.{'PDF' if k % 5 else 'zip'}", start + dt.timedelta(hours=k) if k else None, "crawled" if k % 2 else "parsed") for k in range(300)]
    rows += [rows[7], ("done", "a/x.pdf", start, "graphed")]
    spark.createDataFrame(rows, "id string, object_path string, crawled_at timestamp, status string").write.parquet(f"{tmp_path}/source_documents.parquet")
    assert [r["id"] for r in scan_pending(spark, str(tmp_path)).collect()] == [f"d{k:03d}" for k in range(300) if k % 5]


def test_limit_counts_rows_that_are_filtered_later(spark):
    d = spark.createDataFrame([(1, "pdf"), (2, "zip"), (3, "pdf"), (4, "pdf")], "id int, kind string")
    kept = lambda n: one(lifecycle.limit_then_filter(d.where("id < 9"), F.col("id") != 1, n, [F.col("id")], F.col("kind") == "pdf").select("id"))
    assert kept(2) == [(3,)] and kept(0) == [(3,), (4,)]


def test_fold_and_upsert(spark):
    e = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, 5), (1, 3, "b", None), (2, 1, None, None)], "k int, t int, x string, y int")
    assert sorted(one(lifecycle.fold(e, ["k"], [F.col("t")], ["x", "y"]))) == [(1, "b", 5), (2, None, None)]
    old = spark.createDataFrame([(1, "p", "q")], "k int, x string, y string")
    new = spark.createDataFrame([(1, None, "z"), (3, "n", None)], "k int, x string, y string")
    assert sorted(one(lifecycle.upsert(old, new, ["k"], ["x", "y"]))) == [(1, "p", "z"), (3, "n", None)]


def test_rows_without_a_key_stay(spark):
    d = spark.createDataFrame([(1, "u"), (2, "u"), (3, None), (4, None)], "id int, url string")
    assert sorted(r["id"] for r in lifecycle.unique_by(d, F.col("url"), F.col("id")).collect()) == [1, 3, 4]


def test_gates(spark):
    d = spark.createDataFrame([(0, 0), (100, 79), (100, 80), (100, 89), (100, 90)], "total int, ok int")
    got = one(d.select(stats.gate(F.col("total"), F.col("ok"), 0.8, True), stats.gate(F.col("total"), F.col("ok"), 0.9, False)))
    assert got == [(True, False), (False, False), (True, False), (True, False), (True, True)]


def test_fiscal_periods_of_filings(spark):
    rows = [("10-K", "2025-09-27", 9, 2025, None), ("10-K", "2025-01-26", 1, 2024, None), ("10-Q", "2025-12-27", 9, 2026, 1), ("10-Q", "2025-03-29", 9, 2025, 2), ("10-Q", "2025-04-27", 1, 2025, 1), ("10-Q", "2025-03-31", 12, 2025, 1), ("10-Q", "2025-04-02", 12, 2025, 1), ("10-Q", None, 12, 2025, 1), ("6-K", "2025-06-30", 12, 2025, None)]
    d = spark.createDataFrame(rows, "form string, r string, fye int, y int, q int")
    year, quarter = period.fiscal_period(F.col("form"), F.to_date("r"), F.lit("2025-05-01").cast("date"), F.col("fye"))
    assert all(r["a"] == r["y"] and r["b"] == r["q"] for r in d.select("y", "q", year.alias("a"), quarter.alias("b")).collect())


def test_small_parsers(spark):
    d = spark.createDataFrame([("q3 ",), ("4",), ("Q5",), (None,)], "s string")
    assert [r[0] for r in d.select(period.quarter_number(F.col("s"))).collect()] == [3, 4, None, None]
    d = spark.createDataFrame([("2024-01-02 03:04",), ("soon",), (None,)], "s string")
    assert [r[0] for r in d.select(period.to_ms(F.col("s"))).collect()] == [1704164640000, 0, 0]
    d = spark.createDataFrame([("2024/3/5 x",), ("20240305",), ("none",)], "s string")
    assert [r[0] for r in d.select(period.any_date(F.col("s"))).collect()] == [dt.date(2024, 3, 5), dt.date(2024, 3, 5), None]
    d = spark.createDataFrame([("*ST 深 振业Ａ",), ("中国某股份有限公司",), ("公司",), (None,)], "s string")
    assert [r[0] for r in d.select(names.bare_name(F.col("s"))).collect()] == ["深振业", "中国某", "", None]
    page = "<head><style>p {}</style></head><p>One</p><p>One</p><script>x</script><p>---</p><br>Two &"
    assert spark.range(1).select(text.html_lines(F.lit(page))).first()[0] == ["One", "Two &"]
    table_html = "<table><tr><td>收入</td><td>1000万元</td><td>2024年</td></tr></table>"
    assert spark.range(1).select(text.table_text(F.lit(table_html)), text.table_text(F.lit(table_html), True)).first()[:] == ("收入 万元", "收入 1000万元 2024年")


CHINESE = """# 第一节 重要提示
一、提示
# 第二节 公司概况
## 一、基本情况
文字
## 二、股本
### 1、普通股
### 2、优先股
## 三、其他
（一）甲
（二）乙
## 九、断号
第三节 财务报告. .. 31
<table>
# not a heading
</table>
# 第三节 财务报告
"""


def test_levels_follow_the_numbers():
    assert structure.mode_of("hs_stock", CHINESE) == "chinese"
    got = structure.headings(CHINESE, "chinese")
    assert [h.title[:3] for h in got] == ["第一节", "第二节", "一、基", "二、股", "1、普", "2、优", "三、其", "（一）", "（二）", "第三节"]
    assert [h.level for h in got] == [1, 1, 2, 2, 3, 3, 2, 3, 3, 1]
    assert [h.parent for h in got] == [-1, -1, 1, 1, 3, 3, 1, 6, 6, -1]
    us = "# PART I\n## Item 1. Business\n### Overview\n## Item 2. Properties\n## Item 3 (continued)\n"
    assert structure.mode_of("us_stock", us) == "english"
    assert [(h.title[:6], h.level, h.parent) for h in structure.headings(us, "english")] == [("PART I", 1, -1), ("Item 1", 2, 0), ("Overvi", 3, 1), ("Item 2", 2, 0)]
    flat = structure.headings("# A\nshort line\nlong, line, with, too, many\n## B\n", "simple")
    assert [(h.title, h.level) for h in flat] == [("A", 1), ("short line", 1), ("B", 1)]


def test_numbers_of_headings():
    forms = {"一、x": ("numeral", 1), "一、 x": ("numeral then space", 1), "十二、x": ("numeral", 12), "二十一、x": ("numeral", 21), "1.2.3 x": ("dotted 3", 3), "3. x": ("arabic.", 3), "（四）x": ("bracket numeral", 4), "(5)x": ("bracket arabic", 5), "b) x": ("small letter", 2), "(iv) x": ("bracket small roman", 4), "XII. x": ("roman", 12), "x": ("", 0)}
    assert {t: structure.numbered(t)[:2] for t in forms} == forms


def test_chunks_cover_every_line_once():
    body = "preface, a, b, c, d\n\n# A\n" + "\n".join(f"line, {k}, a, b, c, " + "x" * (k % 90) for k in range(60)) + "\n## B\n<table>\n" + "<tr><td>y</td></tr>\n" * 60 + "</table>\nend, of, it, at, last\n# C\n"
    got = structure.chunks(body, "simple")
    lines = body.split("\n")
    seen = [n for c in got for n in range(c["start_line"], c["end_line"] + 1)]
    assert len(seen) == len(set(seen)) and all(not lines[n - 1].strip() for n in set(range(1, len(lines) + 1)) - set(seen))
    assert [c["chunk_index"] for c in got] == list(range(len(got)))
    assert all(len(c["chunk_text"]) <= 500 or c["is_table"] for c in got)
    assert all(c["parent_index"] is None or c["parent_index"] < c["chunk_index"] for c in got)
    assert got[0]["heading_index"] == -1
    assert structure.chunks(None, "simple") == [] and structure.chunks("  \n", "chinese") == []


def test_exact_quantiles_of_bounded_sketches(spark):
    import random

    import numpy as np

    rng = random.Random(2)
    rows = [("a", rng.random()) for _ in range(3000)] + [("b", float(rng.randrange(5))) for _ in range(700)] + [("c", 4.0), ("c", 9.0), ("d", 1.5), ("e", None)]
    d = spark.createDataFrame(rows, "g string, x double")
    points = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: r for r in stats.exact_quantiles(d, ["g"], "x", 30, **points).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    for g, r in got.items():
        own = [x for k, x in rows if k == g]
        assert r["n"] == len(own) and all(abs(r[n] - np.quantile(own, p)) < 1e-9 for n, p in points.items())


def test_full_text_index_is_kept_and_filtered(spark, tmp_path):
    from graniteflow.operators import fulltext

    rows = [(f"d{k}", "lithium mine " * (k + 1) + "other words here", "lithium" if k == 3 else None, "ab"[k % 2]) for k in range(6)] + [("cn", "锂矿开采公司", None, "a")]
    fulltext.build(spark.createDataFrame(rows, "id string, text string, title string, kind string"), "id", ["text", "title"], ["kind"]).save(str(tmp_path / "i"), 2)
    index = fulltext.load(spark, str(tmp_path / "i"))
    hits = fulltext.search(index, "Lithium mine?", {"text": 2.0, "title": 9.0}, 3).orderBy("rank").collect()
    assert hits[0]["key"] == "d3" and hits[0]["relative"] == 1.0 and [h["rank"] for h in hits] == [1, 2, 3]
    assert {h["key"] for h in fulltext.search(index, "lithium", {"text": 1.0}, 9, F.col("kind") == "a").collect()} == {"d0", "d2", "d4"}
    assert [h["key"] for h in fulltext.search(index, "锂矿", {"text": 1.0}, 9).collect()] == ["cn"]
    assert [h["rank"] for h in fulltext.search(index, "lithium", {"text": 1.0}, 2, offset=2).orderBy("rank").collect()] == [3, 4]
