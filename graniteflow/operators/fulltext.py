"""A full-text index as tables, built once and asked often: postings by term, documents by key, and figures of the fields.

Text is split into lower-case words of letters and digits, characters of scripts without spaces into pairs; one rule for
texts and questions. A question reads only the postings of its terms, so its cost follows these and not the texts.
Postings are laid out by term, which makes a look-up a pruned scan. Null and blank texts have no postings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graniteflow.operators.search import B, K1, relative

WORD = regex.compile(r"(?V1)[\p{Han}\p{Hiragana}\p{Katakana}]+|[[\p{L}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}]]+")
WIDE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")


def words(text: str) -> list[str]:
    """The terms of a text in order."""
    out: list[str] = []
    for run in WORD.findall(text.lower()):
        if WIDE.match(run):
            out += [run[i : i + 2] for i in range(len(run) - 1)] or [run]
        else:
            out.append(run)
    return out


def accepted(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that can be indexed, rejects with a reason): a row needs a key; every reject is given."""
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    return rows.where(~blank), rows.where(blank).withColumn("reason", F.lit("no id"))


@dataclass
class Index:
    """postings (term, key, field, tf, len), figures (field, n, avg_len), frequencies (term, field, df), documents (key, filters ...)."""

    postings: DataFrame
    figures: DataFrame
    frequencies: DataFrame
    documents: DataFrame

    def save(self, folder: str, partitions: int = 0) -> None:
        """Write the tables; postings sorted by term, so that a question's scan skips nearly all row groups.

        The texts are read once: the other tables are made from the postings that were written.
        """
        spark = self.postings.sparkSession
        parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.postings.repartitionByRange(parts, "term", "key").sortWithinPartitions("term", "key").write.mode("overwrite").parquet(f"{folder}/postings")
        written = counted(spark.read.parquet(f"{folder}/postings"), self.documents)
        for name in ("figures", "frequencies", "documents"):
            getattr(written, name).write.mode("overwrite").parquet(f"{folder}/{name}")


def counted(postings: DataFrame, documents: DataFrame) -> Index:
    """An index with its figures and frequencies out of its postings."""
    per = postings.groupBy("field", "key").agg(F.first("len").alias("len"))
    figures = per.groupBy("field").agg(F.count("*").alias("n"), F.avg("len").alias("avg_len"))
    return Index(postings, figures, postings.groupBy("term", "field").agg(F.count("*").alias("df")), documents)


def load(spark: SparkSession, folder: str) -> Index:
    return Index(*(spark.read.parquet(f"{folder}/{name}") for name in ("postings", "figures", "frequencies", "documents")))


def build(rows: DataFrame, key: str, fields: list[str], filters: list[str]) -> Index:
    """The index of rows: one pass over the texts, counted within their row, so only (term, count) pairs move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            keys = batch.column(0).to_pylist()
            for f, name in enumerate(fields, 1):
                for k, text in zip(keys, batch.column(f).to_pylist()):
                    if text and (own := words(text)):
                        counts: dict[str, int] = {}
                        for w in own:
                            counts[w] = counts.get(w, 0) + 1
                        out += [(w, k, name, n, len(own)) for w, n in counts.items()]
            columns = zip(*out) if out else [()] * 5
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["term", "key", "field", "tf", "len"])

    texts = rows.select(F.col(key).cast("string").alias("key"), *fields)
    postings = texts.mapInArrow(run, "term string, key string, field string, tf int, len int")
    return counted(postings, rows.select(F.col(key).cast("string").alias("key"), *filters))


def search(index: Index, question: str, fields: dict[str, float], k: int, where: Column | None = None, least: float = 0.3, offset: int = 0) -> DataFrame:
    """(key, score, relative, rank) of the best documents: the best weighted field counts; a page of them after ``offset``.

    A field takes part where it has ``least`` of the question's terms, one at least. ``where`` is a condition on the
    documents' columns; figures are those of all documents, so a filter changes no score. ``relative`` is to the best hit.
    """
    spark = index.postings.sparkSession
    terms = list(dict.fromkeys(words(question)))
    weights = F.coalesce(*(F.when(F.col("field") == f, F.lit(float(w))) for f, w in fields.items()))
    need = max(1, int(least * len(terms)))
    hit = index.postings.where(F.col("term").isin(terms) & F.col("field").isin(*fields))
    df = index.frequencies.where(F.col("term").isin(terms))
    scored = hit.join(df, ["term", "field"]).join(F.broadcast(index.figures), "field")  # one row a field
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avg_len")))
    by_field = scored.groupBy("key", "field").agg(F.sum(part).alias("s"), F.count("*").alias("terms")).where(F.col("terms") >= need)
    best = by_field.groupBy("key").agg(F.round(F.max(F.col("s") * weights), 6).alias("score"))
    docs = index.documents.where(where) if where is not None else index.documents
    top = best.join(docs.select("key"), "key", "left_semi").orderBy(F.desc("score"), "key").limit(offset + k)

    if not terms:
        return spark.createDataFrame([], "key string, score double, relative double, rank int")
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "key")))  # of offset + k rows
    return ranked.withColumn("relative", F.round(relative("score"), 6)).where(F.col("rank") > offset).select("key", "score", "relative", "rank")
