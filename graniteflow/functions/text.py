"""Column functions over text. Null in, null out; all but ``folded`` are expressions of the JVM, so scans stay in one stage."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as most text tools trim it; \s alone is ASCII only on the JVM.
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# The order and form of the number patterns that are taken out of table text.
TABLE_NUMBERS = [
    (r"[0-9]+[.,]?[0-9]*[BLANK]*[万千亿]?[元美元]?%?[年月日季度期倍次个项]", ""),
    (r"[+-]?[0-9]+\.?[0-9]*%", ""),
    (r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?", ""),
    (r"[+-]?[0-9]{4,}(?:\.[0-9]+)?", ""),
    (r"[+-]?[0-9]+\.[0-9]{2,}", ""),
    (r"[BLANK]*[,，][BLANK]*", " "),
    (r"[BLANK]*-[BLANK]*-", ""),
    (r"[BLANK]*%[BLANK]*", " "),
]


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, f"^[{BLANK}]+|[{BLANK}]+$", "")


def squeeze(c: Column) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{BLANK}]+", " "))


def clean(c: Column) -> Column:
    """Lines without spaces at their ends and doubled spaces, empty lines dropped, nothing blank at the ends.

    Three passes over the whole text; lines are not split.
    """
    inner = BLANK.replace(r"\t-\r", r"\t\x0b-\r")  # all but the line's end
    one = F.regexp_replace(F.regexp_replace(c, "\n{2,}", "\n"), " {2,}", " ")
    return strip(F.regexp_replace(one, f"[{inner}]*\n[{inner}]*", "\n"))


def table_text(c: Column, numbers: bool = False) -> Column:
    """The words of a table in markup; its figures are taken out unless ``numbers``."""
    out = F.regexp_replace(c, "<[^>]+>", " ")
    for pattern, by in [] if numbers else TABLE_NUMBERS:
        out = F.regexp_replace(out, pattern.replace("[BLANK]", f"[{BLANK}]"), by)
    return squeeze(out)


def cut(c: Column, length: int, suffix: str = "...") -> Column:
    """At most ``length`` characters, the suffix included where something was cut."""
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length - len(suffix)), F.lit(suffix))).otherwise(c)


def safe_name(c: Column) -> Column:
    """A file name without characters that file systems refuse."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r'[<>:"/\\|?*]', "_"), "_+", "_"), "^_+|_+$", "")


def file_size(c: Column) -> Column:
    """A size in bytes in the largest unit that leaves at least 1, with two decimals."""
    out = F.concat(F.format_string("%.2f", c / 1024.0**4), F.lit(" TB"))
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(c < 1024.0 ** (power + 1), F.concat(F.format_string("%.2f", c / 1024.0**power), F.lit(f" {unit}"))).otherwise(out)
    return F.when(c.isNotNull(), out)


def markdown_text(c: Column) -> Column:
    """Plain text of markdown: no images, links as their text, no marks of headings, emphasis, code and tables."""
    for pattern, by in [(r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"), ("```[^`]*```", ""), ("(?m)^#{1,6} +", ""), (r"\*\*([^*\n]+)\*\*", "$1"), (r"\*([^*\n]+)\*", "$1"), ("`([^`\n]*)`", "$1"), (r"\|", " "), ("\n{3,}", "\n\n")]:
        c = F.regexp_replace(c, pattern, by)
    return strip(c)


def without_repeats(lines: Column) -> Column:
    """Lines of an array that differ from the one before."""
    return F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1)))


def html_lines(c: Column) -> Column:
    """The lines of text of a page: scripts, styles and heads dropped, tags as breaks, blank and repeated lines dropped."""
    bare = F.regexp_replace(c, r"(?is)<(script|style|noscript|head)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(F.regexp_replace(bare, "(?i)<(br|/p|/div|/tr|/li|/h[1-6])[^>]*>", "\n"), "<[^>]+>", " ")
    lines = F.filter(F.transform(F.split(text, "\n"), squeeze), lambda x: ~x.rlike("^[-=_*]*$"))
    return without_repeats(lines)


@F.pandas_udf(T.StringType())
def folded(text: pd.Series) -> pd.Series:
    """Compatibility forms made plain (NFKC), white space dropped, lower case. The JVM has no such function, so Arrow batches go to Python."""
    return text.map(lambda t: None if t is None else "".join(unicodedata.normalize("NFKC", t).split()).lower())


def loose_int(c: Column) -> Column:
    """A whole number out of text that may be written as a decimal; null for what is none or not finite."""
    n = F.trim(c).try_cast("double")
    return F.when(n.isNotNull() & ~F.isnan(n) & (F.abs(n) < 2**53), n).cast("bigint")


def info(items: Column, values: Column) -> Column:
    """(aggregate) a map of item to value; blank items and the texts None and nan count as none, the last of equal items as they come sorted counts."""
    value = F.when(~F.lower(F.trim(values)).isin("none", "nan", ""), F.trim(values))
    pairs = F.array_sort(F.collect_set(F.when(F.trim(items) != "", F.struct(F.trim(items).alias("item"), value.alias("value")))))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def code_and_name(c: Column) -> tuple[Column, Column]:
    """(code, name) out of a text like {"ind_code": .., "ind_name": ..}, with single or double quotes; other text is the name alone."""
    plain = F.replace(F.trim(c), F.lit("'"), F.lit('"'))
    is_map = plain.startswith("{")
    get = lambda key: F.nullif(F.get_json_object(plain, f"$.{key}"), F.lit(""))
    return F.when(is_map, get("ind_code")), F.when(is_map, get("ind_name")).otherwise(F.nullif(F.trim(c), F.lit("")))


def object_url(base: str, path: Column) -> Column:
    """The address of an attachment from its path, with or without a leading slash; null for a blank one."""
    bare = F.regexp_replace(F.trim(path), "^/+", "")
    return F.when(bare != "", F.concat(F.lit(base.rstrip("/") + "/"), bare))


def tokens(c: Column) -> Column:
    """About how many tokens a text has: a quarter of its characters."""
    return F.floor(F.length(c) / 4).cast("int")
