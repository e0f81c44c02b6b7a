"""Quarters, fiscal periods and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that name a quarter in a title, tried in this order.
QUARTER_WORDS = {
    "Q1": ["第一季", "首季", "一季", "1季", "q1", "1q", "first quarter", "1st quarter"],
    "Q2": ["第二季", "二季", "2季", "q2", "2q", "second quarter", "2nd quarter", "中期", "中報", "半年", "interim", "half-year", "half year", "六個月", "六个月"],
    "Q3": ["第三季", "三季", "3季", "q3", "3q", "third quarter", "3rd quarter", "九个月", "九個月", "nine-month", "nine month"],
    "Q4": ["第四季", "四季", "4季", "q4", "4q", "fourth quarter", "4th quarter", "年报", "年報", "年度", "annual", "十二個月", "十二个月", "twelve"],
}


def quarter_before(year: Column, quarter: Column) -> tuple[Column, Column]:
    """The year and quarter before."""
    return F.when(quarter == 1, year - 1).otherwise(year), F.when(quarter == 1, 4).otherwise(quarter - 1)


def quarter_number(text: Column) -> Column:
    """1 to 4 out of "Q3", "q3 " or "3"; null for anything else."""
    return F.regexp_extract(F.upper(F.trim(text)), "^Q?([1-4])$", 1).try_cast("int")


def annual_quarter(doc_type: Column, quarter: Column) -> Column:
    """The quarter of a report with both spellings of an annual one, 4 and none, as 4."""
    return F.when(doc_type.isin("annual_reports", "10k"), F.coalesce(quarter, F.lit(4))).otherwise(quarter)


def fiscal_period(form: Column, reported: Column, filed: Column, year_end_month: Column) -> tuple[Column, Column]:
    """(year, quarter) of a filing from its form, the end of its period, its filing date and the month that ends the year.

    Annual forms have no quarter and belong to the year before where the fiscal year ends by March. Quarterly forms
    count months from the start of the fiscal year: the quarter that ends in that month, else one month off, else the
    first. Without a period end the filing's year counts. Other forms have the year of their period and no quarter.
    """
    annual, quarterly = form.isin("10-K", "10-K/A", "20-F", "20-F/A", "40-F"), form.isin("10-Q", "10-Q/A")
    month = F.month(reported)
    nth = F.pmod(month - year_end_month - 1, F.lit(12)) + 1
    quarter = F.when(nth.isin(2, 3, 4), 1).when(nth.isin(5, 6, 7), 2).when(nth.isin(8, 9, 10), 3).otherwise(1)
    early = year_end_month <= 3
    year = F.year(reported)
    fiscal = F.when(annual & early, year - 1).when(quarterly & ~early & (month > year_end_month), year + 1).otherwise(year)
    return F.coalesce(fiscal, F.year(filed)), F.when(quarterly, F.when(reported.isNull(), 1).otherwise(quarter))


def title_quarter(title: Column) -> Column:
    """The quarter that a title names, by words or by the month up to which it reports."""
    bare = F.regexp_replace(title, "<[^>]+>", "")
    low = F.lower(bare)
    named = [F.when(low.rlike("|".join(words)), q) for q, words in QUARTER_WORDS.items()]
    month = F.regexp_extract(bare, "截至.*?([0-9]{4})年([0-9]{1,2})月", 2).try_cast("int")
    return F.coalesce(*named, F.when(month.between(1, 12), F.concat(F.lit("Q"), F.ceil(month / 3).cast("string"))))


def by_numeral(text: Column) -> Column:
    """Digits written as Chinese numerals, as digits."""
    return F.translate(text, "〇零一二三四五六七八九", "00123456789")


def fiscal_year_of(year: Column, month: Column, annual: Column) -> Column:
    """The fiscal year of a period that ends in a month: an annual one that ends by June belongs to the year before."""
    return F.when(annual & (month <= 6), year - 1).otherwise(year)


def title_year(title: Column, released: Column | None = None) -> Column:
    """The fiscal year that a title names, the first of: a period's end in digits, one in numerals, a span of years (its
    first), a year marked as such, one in numerals, any of this century; else that of the release, the year before up to April.
    """
    bare = F.regexp_replace(title, "<[^>]+>", "")
    found = lambda pattern, group=1: F.nullif(F.regexp_extract(bare, pattern, group), F.lit(""))
    annual = F.lower(bare).rlike("年报|年報|年度|annual")
    end = "截至.*?([0-9]{4})年([0-9]{1,2})月"
    ended = fiscal_year_of(found(end).cast("int"), found(end, 2).cast("int"), annual)
    spelled = F.concat(F.lit("20"), by_numeral(found("二[零〇]([零〇一二三四五六七八九]{2})")))
    marks = [found("([0-9]{4})[-/][0-9]{4}"), found("([0-9]{4})[-/][0-9]{2}(?![0-9])"), found("([0-9]{4})年"), spelled, found("(20[0-9]{2})")]
    out = F.coalesce(ended, *(m.cast("int") for m in marks))
    return out if released is None else F.coalesce(out, F.when(F.month(released) <= 4, F.year(released) - 1).otherwise(F.year(released)))


def title_period_end(title: Column) -> Column:
    """The last day of the period that a title reports on; the last of its month where it names none, 28 in February."""
    bare = F.regexp_replace(title, "<[^>]+>", "")
    part = lambda g: F.nullif(F.regexp_extract(bare, "截至.*?([0-9]{4})年([0-9]{1,2})月(?:([0-9]{1,2})日)?", g), F.lit(""))
    month = part(2).cast("int")
    last = F.when(month == 2, 28).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.try_to_timestamp(F.concat_ws("-", part(1), part(2), F.coalesce(part(3).cast("int"), last)), F.lit("yyyy-M-d")).cast("date")


def search_windows(year: Column, quarter: Column) -> Column:
    """Spans of days in which a report of a quarter is looked for: its year, or for the fourth its end and the half year after."""
    span = lambda a, b: F.struct(F.to_date(a).alias("first"), F.to_date(b).alias("last"))
    y, n = year.cast("string"), (year + 1).cast("string")
    late = F.array(span(F.concat(y, F.lit("-10-01")), F.concat(y, F.lit("-12-31"))), span(F.concat(n, F.lit("-01-01")), F.concat(n, F.lit("-06-30"))))
    return F.when(quarter == 4, late).otherwise(F.array(span(F.concat(y, F.lit("-01-01")), F.concat(y, F.lit("-12-31")))))


def to_ms(text: Column) -> Column:
    """Milliseconds of "yyyy-MM-dd HH:mm"; 0 for anything else."""
    return F.coalesce(F.unix_millis(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))), F.lit(0))


def any_date(text: Column) -> Column:
    """A date out of the first word, written with dashes, slashes, dots or none."""
    first = F.regexp_replace(F.substring_index(F.trim(text), " ", 1), "[/.]", "-")
    return F.coalesce(F.try_to_timestamp(first, F.lit("yyyy-M-d")), F.try_to_timestamp(first, F.lit("yyyyMMdd"))).cast("date")


def quarter_of(day: Column) -> tuple[Column, Column]:
    """The year and quarter of a day; of today for ``F.current_date()``."""
    return F.year(day), F.quarter(day)


def quarter_name(quarter: Column) -> Column:
    """ "Q3" for 3; null outside 1 to 4."""
    return F.when(quarter.between(1, 4), F.concat(F.lit("Q"), quarter.cast("string")))


def day_of_ms(ms: Column) -> Column:
    """dd-MM-yyyy of milliseconds since 1970, "NA" for none or 0."""
    return F.coalesce(F.when(ms != 0, F.date_format(F.timestamp_millis(ms), "dd-MM-yyyy")), F.lit("NA"))


def year_of_ms(ms: Column, today: Column | None = None) -> Column:
    """The year of milliseconds since 1970 as text; this year where there are none."""
    now = F.current_date() if today is None else today
    return F.coalesce(F.year(F.timestamp_millis(ms)), F.year(now)).cast("string")


def years_back(today: Column, years: int = 20) -> Column:
    """The span of days from the first of January ``years`` years ago to the end of this year."""
    return F.struct(F.make_date(F.year(today) - years, F.lit(1), F.lit(1)).alias("first"), F.make_date(F.year(today), F.lit(12), F.lit(31)).alias("last"))


def doc_type_of_quarter(quarter: Column) -> Column:
    """The kind of report that a quarter has."""
    return F.when(quarter == "Q4", "annual_report").when(quarter == "Q2", "interim_report").when(quarter.isin("Q1", "Q3"), "quarterly_report").otherwise("unknown")


def filing_folder(form: Column, quarter: Column) -> Column:
    """FY for annual and other forms, Q1 to Q3 for quarterly ones; null for a quarterly form without such a quarter."""
    quarterly = form.isin("10-Q", "10-Q/A")
    return F.when(quarterly, F.when(quarter.between(1, 3), F.concat(F.lit("Q"), quarter.cast("string")))).otherwise("FY")


# Kind of search and quarter of a task without one, by document type.
REPORT_KINDS = {"annual_reports": ("annual", "Q4"), "interim_reports": ("interim", "Q2"), "quarterly_reports": ("quarterly", "Q1")}


def report_kind(doc_type: Column, quarter: Column) -> tuple[Column, Column]:
    """(kind of search, quarter) of a task; annual and its quarter for an unknown type."""
    of = lambda i: F.coalesce(*(F.when(doc_type == t, v[i]) for t, v in REPORT_KINDS.items()), F.lit(REPORT_KINDS["annual_reports"][i]))
    return of(0), F.coalesce(quarter, of(1))


def release_time(text: Column) -> Column:
    """A time dd/MM/yyyy [HH:mm], midnight without one; null for anything else."""
    t = F.trim(text)
    return F.coalesce(F.try_to_timestamp(t, F.lit("dd/MM/yyyy HH:mm")), F.try_to_timestamp(t, F.lit("dd/MM/yyyy")))
