import pytest
from pyspark.sql import functions as F

from graniteflow.functions import markup
from graniteflow.operators import retrieval as R


def test_filters(spark):
    d = spark.createDataFrame([(1, "a", 2023, 4), (2, "b", 2023, None), (3, "a", 2022, 4)], "id int, stock_code string, year int, quarter int")
    ids = lambda f: sorted(r["id"] for r in d.where(R.filter_by(f)).collect())
    assert ids(None) == ids({"year": 0, "stock_code": ""}) == [1, 2, 3]
    assert ids({"stock_code": ["a", "c"], "year": 2023}) == [1]
    with pytest.raises(ValueError):
        R.filter_by({"price": 1})
    with pytest.raises(ValueError):
        R.check_weights({"graph": 0.5})


def test_hits_context_and_answer(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0], 2023), ("b", [0.0, 1.0], 2023), ("c", [0.9, 0.1], 2020)], "id string, embedding array<float>, year int")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query int, q array<float>")
    assert [r["id"] for r in R.vector_hits(v, "id", q, 2, {"year": 2023}).orderBy("rank").collect()] == ["a", "b"]
    t = spark.createDataFrame([("b", "solar wind wind"), ("c", "wind farm"), ("d", None)], "id string, text string")
    got = [r["id"] for r in R.hybrid_hits(v, q, t, ["wind"], "id", 3, {"vector": 0.5, "fulltext": 0.5}).collect()]
    assert set(got) == {"a", "b", "c"}
    chunks = spark.createDataFrame([("a", "D"), ("c", "gone")], "id string, document_id string")
    docs = spark.createDataFrame([("D", "X")], "document_id string, company_name string")
    hits = R.vector_hits(v, "id", q, 3)
    assert [(r["id"], r["company_name"]) for r in R.hydrated(hits, chunks, docs).collect()] == [("a", "X")]
    p = spark.createDataFrame([(1, "X", 2023, 2, "T", "body"), (2, "Y", 2022, None, "", "y" * 300)], "rank int, c string, y int, q int, t string, b string")
    texts = p.select("rank", R.passage(F.col("rank"), F.col("c"), R.period_text(F.col("y"), F.col("q")), F.col("t"), F.col("b")).alias("text"))
    assert R.context(texts, 100) == "[1] X, 2023 Q2\nT\nbody"
    assert R.answer("why?", texts, 100, lambda prompt: prompt[-4:]) == "why?"
    assert R.answer("why?", texts, 3, lambda prompt: "x").startswith("No passage")
    assert len(R.sources(texts).where("rank = 2").first()["snippet"]) == 203


def test_titles_are_searched_and_the_best_field_counts(spark):
    from graniteflow.operators import search

    rows = [("a", "wind wind farm", "Notes"), ("b", "notes on rates", "Wind"), ("c", "rain", None), ("d", None, "wind wind"), ("e", "wind here", "wind")]
    d = spark.createDataFrame(rows, "id string, body string, title string")
    score = lambda df: {r["id"]: r["score"] for r in df.collect()}
    body, title = (score(search.bm25(d, "id", f, ["wind", "gale"], 9)) for f in ("body", "title"))
    both = score(search.bm25(d, "id", {"body": 2.0, "title": 1.5}, ["wind", "gale"], 9))
    assert set(body) == {"a", "e"} and set(title) == {"b", "d", "e"}
    assert both == pytest.approx({k: max(2 * body.get(k, 0), 1.5 * title.get(k, 0)) for k in "abde"}, abs=3e-6)
    v = spark.createDataFrame([("a", [1.0, 0.0])], "id string, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query int, q array<float>")
    got = R.hybrid_hits(v, q, d, ["wind"], "id", 9, None, {"body": 2.0, "title": 1.5})
    assert {r["id"] for r in got.collect()} == set("abde")


def test_company_code(spark):
    rows = [(f"{k}", f"Alpha {k}", None, None, None) for k in range(7)] + [("90", "Beta", None, None, "Old Beta"), ("91", "Gamma One", None, None, None), ("92", "Gamma Two", None, None, None)]
    c = spark.createDataFrame(rows, "code string, name string, org_name_en string, org_short_name_en string, pre_name string")
    asked = spark.createDataFrame([("Beta",), ("Gamma",), ("Alpha",), ("none",)], "query string")
    got = {r["query"]: (r["code"], r["candidates"], r["said"]) for r in R.company_code(c, asked).collect()}
    assert got == {"Beta": ("90", None, "found"), "Gamma": (None, ["91", "92"], "choose"), "Alpha": (None, None, "too many"), "none": (None, None, "none")}


def test_outline(spark):
    h = spark.createDataFrame([("d", 1, "B", 2), ("d", 0, "A", 1)], "doc string, heading_index int, title string, level int")
    assert R.outline(h).first()["text"] == "- A\n  - B"


def test_pages_in_other_encodings(spark):
    body = '<meta charset="gb2312">年度报告'
    rows = [(1, bytearray(body.encode("gb18030"))), (2, bytearray("plain é".encode())), (3, bytearray("年度".encode("gb18030"))), (4, None)]
    d = spark.createDataFrame(rows, "id int, content binary").select("id", markup.page_text("content").alias("t"))
    assert {r["id"]: r["t"] for r in d.collect()} == {1: body, 2: "plain é", 3: "年度", 4: None}
    assert markup.repaired("é¾".encode().decode("latin-1")) == "é¾" and markup.repaired("ok") == "ok"


def test_loose_json(spark):
    d = spark.createDataFrame([("x ```json\n[{'a': None,},]\n``` y",), ('{"b": 1}',), ("none",), (None,)], "s string")
    assert [r[0] for r in d.select(markup.json_of("s")).collect()] == ['[{"a": null}]', '{"b": 1}', "[]", "[]"]
    page = spark.range(1).select(markup.image_links(F.lit('<img src="a.png">'), {"a.png": "images/1.png"})).first()[0]
    assert page == '<img src="images/1.png">'
