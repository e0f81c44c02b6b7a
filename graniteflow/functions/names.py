"""Codes and names of companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.session import broadcast_if_small

# Suffixes are tried in this order and only the first that fits is dropped.
SUFFIXES = ["股份有限公司", "有限责任公司", "有限公司", "集团公司", "集团股份", "集团", "股份公司", "股份", "公司", "控股公司", "控股集团"]
# Exchange by code prefix, the first that fits; SZ where none does.
EXCHANGES = [("688", "SH"), ("6", "SH"), ("300", "SZ"), ("301", "SZ"), ("000", "SZ"), ("001", "SZ"), ("002", "SZ"), ("003", "SZ"), ("8", "BJ"), ("43", "BJ"), ("83", "BJ")]
# The form of a code by market.
CODE_FORMS = {"hs_stock": "^[0-9]{6}$", "hk_stock": "^[0-9]{5}$", "us_stock": "^[A-Z]{1,5}$"}


def valid_code(code: Column, market: Column) -> Column:
    """Whether a code has the form of its market; an unknown market has no valid codes."""
    tests = [F.when(market == m, F.upper(code).rlike(p)) for m, p in CODE_FORMS.items()]
    return F.coalesce(*tests, F.lit(False))


def padded_code(code: Column) -> Column:
    """A numeric code with six digits; others as they are."""
    n = code.try_cast("double")
    return F.when(n.isNotNull() & (n >= 0) & (n < 1e6), F.lpad(n.cast("bigint").cast("string"), 6, "0")).otherwise(code)


def exchange(code: Column) -> Column:
    """The exchange of a code."""
    return F.coalesce(*(F.when(code.startswith(p), e) for p, e in EXCHANGES), F.when(code.isNotNull(), "SZ"))


def bare_name(name: Column) -> Column:
    """A name without spaces, share class, special-treatment mark and one corporate suffix."""
    n = F.regexp_replace(name, "[ 　]", "")
    n = F.regexp_replace(F.regexp_replace(F.regexp_replace(n, "[ABＡＢab]$", ""), r"^\*+", ""), "^ST", "")
    fits = [F.when(n.endswith(s) & (F.length(n) >= len(s)), F.substring(n, 1, F.length(n) - len(s))) for s in SUFFIXES]
    return F.coalesce(*fits, n)


def search(companies: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, code, tier, place): up to k companies of each query, best tier first, then by code.

    Tiers: 1 one of the names is the query, 2 the bare names agree, 3 the bare name holds the query, 4 the query holds
    the bare name, 5 a former name agrees with it or one holds the other. Queries are broadcast where a count shows that they are few; companies are
    scanned once, and a company counts once however many rows it has.
    """
    q = broadcast_if_small(queries.select("query", bare_name(F.col("query")).alias("bare")))
    c = companies.select("code", "name", "org_name_en", "org_short_name_en", F.split("pre_name", ",").alias("former")).withColumn("own", bare_name(F.col("name")))
    has = lambda a, b: F.coalesce((b != "") & a.contains(b), F.lit(False))
    some = F.col("bare") != ""
    exact = F.coalesce(F.array_contains(F.array_compact(F.array("name", "org_name_en", "org_short_name_en")), F.col("query")), F.lit(False))
    old = F.coalesce(F.exists("former", lambda x: has(bare_name(x), F.col("bare")) | has(F.col("bare"), bare_name(x))), F.lit(False))
    tier = F.coalesce(F.when(exact, 1), F.when(some & (F.col("own") == F.col("bare")), 2), F.when(has(F.col("own"), F.col("bare")), 3), F.when(has(F.col("bare"), F.col("own")), 4), F.when(some & old, 5))
    hits = c.crossJoin(q).withColumn("tier", tier).where("tier IS NOT NULL").groupBy("query", "code").agg(F.min("tier").alias("tier"))
    w = Window.partitionBy("query").orderBy("tier", "code")
    return hits.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


# How an identifier starts by exchange.
ORG_PREFIXES = {"SH": "gssh", "SZ": "gssz", "BJ": "gsbj"}


def org_id(code: Column) -> Column:
    """An identifier built from a code where no look-up has one: prefix of its exchange, 0 and six digits."""
    six = padded_code(code)
    prefix = F.coalesce(*(F.when(exchange(six) == e, F.lit(p)) for e, p in ORG_PREFIXES.items()))
    return F.concat(prefix, F.lit("0"), six)


def search_listed(companies: DataFrame, queries: DataFrame, k: int, width: int = 5) -> DataFrame:
    """(query, code, place): a query of digits finds its code, filled up with zeros to ``width``; another one finds names that hold it.

    ``companies`` has code and names (an array). Each company counts once; hits come in order of code, at most k a query.
    Queries of digits meet codes by an equi-join; the others are few and broadcast where small by the planner's own measure.
    """
    q = queries.where(F.trim("query") != "").select("query", F.lower(F.trim("query")).alias("low"))
    digits = F.col("low").rlike("^[0-9]+$")
    coded = q.where(digits).select("query", F.when(F.length("low") < width, F.lpad("low", width, "0")).otherwise(F.col("low")).alias("code"))
    by_code = coded.join(companies.select("code").distinct(), "code").select("query", "code")
    named = companies.select("code", F.explode("names").alias("name")).where("name IS NOT NULL").select("code", F.lower("name").alias("name")).distinct()
    by_name = named.join(q.where(~digits), F.col("name").contains(F.col("low"))).select("query", "code").distinct()
    w = Window.partitionBy("query").orderBy("code")
    return by_code.union(by_name).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
