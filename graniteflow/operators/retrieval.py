"""The retrieval surface: filters, hydrated hits, sources and context for an answer, search for a company's code.

Everything returns a DataFrame; the model that would write an answer is not part of the engine, ``answer`` takes it as a
function.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.functions import names
from graniteflow.operators import search

FILTER_COLUMNS = ("stock_code", "market", "doc_type", "company_name", "year", "quarter")


def filter_by(filters: dict[str, Any] | None) -> Column:
    """One condition out of column: value or list of values; empty values (none, 0, "") do not filter, unknown columns raise."""
    out = F.lit(True)
    for name, value in (filters or {}).items():
        if name not in FILTER_COLUMNS:
            raise ValueError(f"no filter on {name}")
        if value:
            out = out & (F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    return out


def check_weights(weights: dict[str, float] | None) -> dict[str, float]:
    """Weights of the two lists of a hybrid search, each from 0 to 1; halves where none are given."""
    w = weights or {"vector": 0.5, "fulltext": 0.5}
    if set(w) - {"vector", "fulltext"} or not all(0 <= x <= 1 for x in w.values()):
        raise ValueError("weights are for vector and fulltext, from 0 to 1")
    return {"vector": 0.0, "fulltext": 0.0, **w}


def vector_hits(vectors: DataFrame, key: str, query: DataFrame, k: int, filters: dict[str, Any] | None = None) -> DataFrame:
    """(key, score, rank) of the nearest vectors to one vector; the filter runs below the ranking."""
    hits = search.nearest(vectors, query, key, k, filter_by(filters))
    return hits.select(key, F.round(search.distance_score(F.col("distance")), 6).alias("score"), "rank")


def hybrid_hits(vectors: DataFrame, query: DataFrame, texts: DataFrame, terms: list[str], key: str, k: int, weights: dict[str, float] | None = None, fields: str | dict[str, float] = "text") -> DataFrame:
    """(key, score) of both kinds of hits as one list; ``fields`` are the columns of the texts to search, as in ``search.bm25``."""
    w = check_weights(weights)
    lists = [(vector_hits(vectors, key, query, k), w["vector"]), (search.bm25(texts, key, fields, terms, k), w["fulltext"])]
    return search.fuse(lists, key, k)


def hydrated(hits: DataFrame, chunks: DataFrame, documents: DataFrame, key: str = "id") -> DataFrame:
    """Hits with the columns of their chunk and filing in the order of their rank; hits that name nothing are dropped."""
    return hits.join(chunks, key).join(documents, "document_id").orderBy("rank", key)


def period_text(year: Column, quarter: Column) -> Column:
    """A period to read: year and quarter, or the year."""
    return F.when(quarter.between(1, 4), F.concat(year.cast("string"), F.lit(" Q"), quarter.cast("string"))).otherwise(year.cast("string"))


def passage(rank: Column, company: Column, period: Column, title: Column, text: Column) -> Column:
    """A numbered passage of a context: where it comes from, its title if it has one, its text."""
    head = F.concat(F.lit("["), rank.cast("string"), F.lit("] "), F.concat_ws(", ", company, period))
    return F.concat_ws("\n", head, F.nullif(title, F.lit("")), text)


def sources(hits: DataFrame, length: int = 200) -> DataFrame:
    """Hits with a snippet of their text to cite."""
    text = F.col("text")
    return hits.withColumn("snippet", F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text))


def context(hits: DataFrame, limit: int) -> str:
    """Passages (rank, text) as one text within ``limit`` characters. Hits are a result list, so this may come to the driver."""
    return "\n\n".join(r["text"] for r in search.pack_context(hits, "text", limit).orderBy("rank").select("text").collect())


def answer(question: str, hits: DataFrame, limit: int, model: Callable[[str], str]) -> str:
    """What a model says to a question with the hits as its context; a fixed answer where there is no context."""
    found = context(hits, limit)
    return model(f"{found}\n\n{question}") if found else "No passage was found for this question."


def company_code(companies: DataFrame, queries: DataFrame, most: int = 30, few: int = 5) -> DataFrame:
    """(query, code, candidates, said): one hit gives its code, a few are listed, more are too many, none gives nothing."""
    found = names.search(companies, queries, most).groupBy("query").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("place", "code"))).alias("hits"))
    n = F.coalesce("n", F.lit(0))
    said = F.when(n == 0, "none").when(n == 1, "found").when(n <= few, "choose").otherwise("too many")
    listed = F.when(n.between(2, few), F.transform("hits", lambda h: h["code"]))
    return queries.join(found, "query", "left").select("query", F.when(n == 1, F.col("hits")[0]["code"]).alias("code"), listed.alias("candidates"), said.alias("said"))


def outline(headings: DataFrame) -> DataFrame:
    """(doc, text): the headings of each document as an indented outline."""
    line = F.concat(F.repeat(F.lit("  "), F.col("level") - 1), F.lit("- "), F.col("title"))
    rows = F.array_sort(F.collect_list(F.struct("heading_index", line.alias("line"))))
    return headings.groupBy("doc").agg(rows.alias("rows")).select("doc", F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("text"))


def versions(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """Rows with a number that counts the versions of their key from 1."""
    return rows.withColumn("version", F.row_number().over(Window.partitionBy(key).orderBy(order)))


# Types of documents and ways to walk the graph that a request may name.
DOC_TYPES = ("quarterly_reports", "interim_reports", "annual_reports", "ipo_prospectus", "announcements", "earnings_calls", "10k", "10q", "8k")
WALKS = ("document", "chunk", "hierarchy")


def check_request(doc_types: list[str] | str | None = None, quarter: int | None = None, graph: str | None = None) -> None:
    """Refuse a request that names an unknown type, a quarter outside 1 to 4 or an unknown walk."""
    for t in [doc_types] if isinstance(doc_types, str) else doc_types or []:
        if t not in DOC_TYPES:
            raise ValueError(f"no document type {t}")
    if quarter is not None and not 1 <= quarter <= 4:
        raise ValueError("quarters are 1 to 4")
    if graph is not None and graph not in WALKS:
        raise ValueError(f"no walk {graph}")


def source_lines(hits: DataFrame) -> DataFrame:
    """(text): the numbered sources of a result list (rank, company, period), one line each."""
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.concat_ws(", ", "company", "period"))
    rows = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return hits.agg(rows.alias("rows")).select(F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("text"))


def response(hits: DataFrame, question: str, kind: str, k: int) -> DataFrame:
    """The first k hits (rank, ...) with the question, cut to 100 characters, the kind of search and their number."""
    top = hits.orderBy("rank").limit(k)
    return top.withColumns({"query": F.lit(question[:100]), "kind": F.lit(kind), "total": F.count("*").over(Window.partitionBy(F.lit(1))).cast("int")})
