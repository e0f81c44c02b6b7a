"""Which of a company's announcements is the report that is looked for.

Announcements are rows (code, name, title, time_ms, attachment). All choices are one ranking per key: no lists are
walked, and ties go to the row that comes first by ``attachment``. Null titles match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.functions import names
from graniteflow.operators.latest import newest_per_key

# Words that rule a title out.
NOT_THE_REPORT = ("摘要", "英文", "英文版")
NOT_THE_PROSPECTUS = ("摘要", "英文", "英文版", "更正", "补充", "修订", "注册稿", "提示性公告", "意向书", "附录", "上市公告书")
PROSPECTUS = ("招股说明书", "招股书")
# Supplements, clarifications, notices by letter and corrections are no reports, whatever else they say.
NEVER = ("補充公告", "补充公告", "澄清公告", "澄清公布", "澄清公佈", "clarification", "通知信函", "通知信", "通知函", "更正公告", "更正公布", "更正公佈", "correction")
# Words of reports, and words that rule a title out where it has none of these.
REPORT = ("年报", "年報", "年度报告", "年度報告", "annual", "年度業績", "年度业绩", "中期", "中報", "interim", "half-year", "半年度", "季度", "季報", "quarter", "q1", "q2", "q3", "q4", "第一季", "第二季", "第三季", "第四季", "业绩", "業績", "results", "financial", "財務", "财务")
OTHER = ("通知", "通告", "公告", "信", "函", "申請", "申请", "表", "補充", "补充", "更正", "修正", "修訂", "修订", "說明", "说明", "回覆", "回复", "答覆", "答复", "登記", "登记", "註冊", "注册", "刊發", "刊发", "澄清")


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds one of some words."""
    return F.coalesce(text.rlike("|".join(words)), F.lit(False))


def of_period(title: Column, year: Column, quarter: Column) -> Column:
    """Whether a title is that of the report of a quarter of a year."""
    y = year.cast("string")
    forms = {1: "年(第?一|1)(季度报告|季报)", 2: "年(半年度|半年)报告", 3: "年(第?三|3)(季度报告|季报)", 4: "年?(年度报告|年报)"}
    tests = [F.when(quarter == q, F.regexp_like(title, F.concat(y, F.lit(form)))) for q, form in forms.items()]
    return F.coalesce(*tests, F.lit(False)) & ~any_of(title, NOT_THE_REPORT)


def is_prospectus(title: Column) -> Column:
    return any_of(title, PROSPECTUS) & ~any_of(title, NOT_THE_PROSPECTUS)


def is_report(title: Column) -> Column:
    """Whether an announcement is a report by its title; titles that say nothing either way are kept."""
    low = F.lower(F.regexp_replace(title, "<[^>]+>", ""))
    supplement = low.startswith("supplement")
    return title.isNotNull() & ~any_of(low, NEVER) & ~supplement & (any_of(low, REPORT) | ~any_of(low, OTHER))


def latest_report(announcements: DataFrame, tasks: DataFrame) -> DataFrame:
    """The newest attached PDF for each task (task_code, year, quarter, codes), where codes are those the company has had."""
    wanted = tasks.select("task_code", "year", "quarter", F.explode(F.array_distinct(F.transform("codes", names.padded_code))).alias("code"))
    a = announcements.withColumn("code", names.padded_code(F.col("code"))).where(F.lower("attachment").endswith(".pdf"))
    hits = a.join(wanted, "code").where(of_period(F.col("title"), F.col("year"), F.col("quarter")))
    return newest_per_key(hits, ["task_code", "year", "quarter"], F.coalesce("time_ms", F.lit(0)).desc(), F.col("attachment"))


def latest_prospectus(announcements: DataFrame) -> DataFrame:
    """The newest prospectus of every code, as PDF or page."""
    fit = is_prospectus(F.col("title")) & F.lower("attachment").rlike("[.](pdf|html?)$")
    return newest_per_key(announcements.where(fit), ["code"], F.coalesce("time_ms", F.lit(0)).desc(), F.col("attachment"))


def best_report(announcements: DataFrame, year: int, quarter: str) -> DataFrame:
    """For every code the report (with fiscal_year and fiscal_quarter) of the quarter, else of the year, the newest of these."""
    fit = announcements.where(is_report(F.col("title")) & (F.col("fiscal_year") == year))
    exact = F.coalesce(F.col("fiscal_quarter") == quarter, F.lit(False))
    return newest_per_key(fit.withColumn("exact", exact), ["code"], F.col("exact").desc(), F.coalesce("time_ms", F.lit(0)).desc(), F.col("attachment")).drop("exact")


def code_change(announcements: DataFrame, requested: DataFrame) -> DataFrame:
    """(org, requested_code, main_code, accepted): under which code a company announces most, and whether it is the same one.

    ``requested`` has (org, requested_code), ``announcements`` (org, code, name). Another code is accepted where the
    requested one has no announcements or both share a name; else it is another company.
    """
    per = announcements.groupBy("org", "code").agg(F.count("*").alias("n"), F.collect_set(names.bare_name(F.col("name"))).alias("names"))
    top = per.groupBy("org").agg(F.max_by(F.struct("code", "names"), F.struct(F.col("n"), F.expr("-coalesce(try_cast(code AS bigint), 0)"))).alias("top"))
    own = per.select("org", F.col("code").alias("requested_code"), F.col("names").alias("own_names"))
    met = requested.join(top, "org").join(own, ["org", "requested_code"], "left")
    same = F.col("own_names").isNull() | F.arrays_overlap("own_names", "top.names")
    accepted = (F.col("top.code") == F.col("requested_code")) | F.coalesce(same, F.lit(False))
    return met.select("org", "requested_code", F.col("top.code").alias("main_code"), accepted.alias("accepted"))


def all_codes(current: Column, former: Column) -> Column:
    """The current and former codes of a company in order, each once."""
    return F.array_distinct(F.array_compact(F.concat(F.array(current), F.coalesce(former, F.array().cast("array<string>")))))


def by_registrant(rows: DataFrame) -> DataFrame:
    """(cik, ticker, name, tickers): one row a registrant of rows (cik, ticker, name, place), the first and all tickers."""
    padded = F.lpad(F.col("cik").cast("string"), 10, "0")
    return rows.groupBy(padded.alias("cik")).agg(
        F.min_by("ticker", "place").alias("ticker"), F.min_by("name", "place").alias("name"), F.array_join(F.array_sort(F.collect_set("ticker")), ",").alias("tickers"),
    )


def resolved(rows: DataFrame, lookups: list[DataFrame], key: str, value: str, fallback: Column) -> DataFrame:
    """Rows with the value that the first look-up table that has it gives for their key, else the fallback."""
    out, found = rows, []
    for k, table in enumerate(lookups):
        out = out.join(table.select(key, F.col(value).alias(f"__{k}")).dropDuplicates([key]), key, "left")
        found.append(F.col(f"__{k}"))
    return out.withColumn(value, F.coalesce(*found, fallback)).drop(*(f"__{k}" for k in range(len(lookups))))


def text_quality(text: Column, least: int = 100) -> Column:
    """What is wrong with a text: "short", "garbled" (1 % or more of its characters are replacements), or null."""
    broken = F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))
    return F.when(F.length(F.coalesce(text, F.lit(""))) <= least, "short").when(broken >= 0.01 * F.length(text), "garbled")
