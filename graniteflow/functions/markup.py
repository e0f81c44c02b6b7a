"""Encodings of pages and loose JSON.

Bytes in unknown encodings cannot be decoded by expressions of the JVM, so these run as Arrow batches in Python.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of encodings that stand for a wider one of the same family.
FAMILIES = {"gb2312": "gb18030", "gbk": "gb18030", "big5": "big5hkscs", "ascii": "utf-8", "us-ascii": "utf-8", "utf8": "utf-8", "iso-8859-1": "cp1252", "latin1": "cp1252"}
DECLARED = re.compile(rb"(?:charset|encoding)\s*=\s*[\"']?\s*([\w-]+)", re.I)


def declared(content: bytes) -> str:
    """The encoding that the first 500 bytes declare, UTF-8 where they declare none or an unknown one."""
    m = DECLARED.search(content[:500])
    name = m[1].decode("ascii").lower() if m else "utf-8"
    name = FAMILIES.get(name, name)
    try:
        "".encode(name)
    except LookupError:
        return "utf-8"
    return name


def decoded(content: bytes | None, others: tuple[str, ...] = ("utf-8", "gb18030", "big5hkscs", "cp1252")) -> str | None:
    """Text of a page: the declared encoding if it fits, else the first that does, else UTF-8 with replacements."""
    if content is None:
        return None
    for name in (declared(content), *others):
        try:
            return content.decode(name)
        except UnicodeDecodeError:
            continue
    return content.decode("utf-8", "replace")


@F.pandas_udf(T.StringType())
def page_text(content: pd.Series) -> pd.Series:
    """Decoded text of binary pages."""
    return content.map(lambda b: None if b is None else decoded(bytes(b)))


def repaired(text: str | None) -> str | None:
    """Text whose UTF-8 or Big5 bytes were read as Latin-1, put right; other text unchanged."""
    if not text or text.isascii():
        return text
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    for name in ("utf-8", "big5"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return text


@F.pandas_udf(T.StringType())
def repair(text: pd.Series) -> pd.Series:
    """Repaired texts."""
    return text.map(repaired)


def loose_json(text: str | None) -> str:
    """The JSON in an answer of a model as compact JSON: fenced or bare, with None, trailing commas or single quotes; [] if none."""
    body = text or ""
    if m := re.search(r"```(?:json)?\s*(.*?)```", body, re.S):
        body = m[1]
    starts = [i for i in (body.find("["), body.find("{")) if i >= 0]
    if not starts:
        return "[]"
    body = body[min(starts) : max(body.rfind("]"), body.rfind("}")) + 1]
    plain = re.sub(r",\s*([\]}])", r"\1", re.sub(r"\bNone\b", "null", body))
    for attempt in (body, plain, plain.replace("'", '"')):
        try:
            return json.dumps(json.loads(attempt), ensure_ascii=False)
        except ValueError:
            continue
    return "[]"


@F.pandas_udf(T.StringType())
def json_of(text: pd.Series) -> pd.Series:
    """JSON found in texts."""
    return text.map(loose_json)


def image_links(html: Column, replacements: dict[str, str]) -> Column:
    """A page whose images point to other places, by exact source."""
    for old, new in replacements.items():
        html = F.replace(html, F.lit(f'src="{old}"'), F.lit(f'src="{new}"'))
    return html


def redeclared(html: Column, encoding: str) -> Column:
    """A page whose first declaration of an encoding names another one; the rest of the page is as it was."""
    return F.regexp_replace(html, r"(?is)\A(.*?(?:charset|encoding)\s*=\s*[\"']?\s*)[\w-]+", f"$1{encoding}")


# What is left of dashes and quotes whose UTF-8 bytes were read as Latin-1.
BROKEN = ("â€™", "â€œ", "â€\x9d", "â€“", "â€”", "â€¦")


def kept_encoding(before: bytes | None, after: bytes | None) -> str | None:
    """What a rewrite of a page did to its encoding: "declaration", "broken" or "grown"; None if nothing.

    Growth is above 10 % and 10 kB.
    """
    a, b = before or b"", after or b""
    if declared(a) != declared(b):
        return "declaration"
    if any(x in decoded(b) and x not in decoded(a) for x in BROKEN):
        return "broken"
    return "grown" if len(b) > 1.1 * len(a) and len(b) - len(a) > 10_000 else None


def rewritten(content: bytes | None, replacements: dict[str, str]) -> bytes | None:
    """A page in its own encoding with image sources replaced; in UTF-8, declared as such, where that encoding lacks a character."""
    if content is None:
        return None
    name, text = declared(content), decoded(content)
    for old, new in replacements.items():
        for mark in "\"'":
            text = text.replace(f"src={mark}{old}{mark}", f"src={mark}{new}{mark}")
    try:
        return text.encode(name)
    except UnicodeEncodeError:
        return re.sub(r"((?:charset|encoding)\s*=\s*[\"']?\s*)[\w-]+", r"\1utf-8", text, count=1, flags=re.I).encode("utf-8")


def image_keys(page_url: Column, source: Column, place: Column) -> Column:
    """(key, place) of an image: its address, its file name, and the path of its address, as a page may name it."""
    whole = F.when(source.rlike("^https?://"), source).otherwise(F.concat(F.regexp_replace(page_url, "[^/]*$", ""), source))
    keys = F.array_distinct(F.array(whole, F.element_at(F.split(source, "/"), -1), F.parse_url(whole, F.lit("PATH"))))
    return F.transform(keys, lambda k: F.struct(k.alias("key"), place.alias("place")))


# Labels before the text of a release.
RELEASE_LABELS = ("Release Time:", "Stock Code:", "Stock Short Name:", "Document:", "發放時間:", "股份代號:", "股份簡稱:", "文件:", "发放时间:")


def release_text(text: Column) -> Column:
    """The text of a release, repaired, without its label."""
    return F.trim(F.regexp_replace(repair(text), "^\\s*(?:" + "|".join(RELEASE_LABELS) + ")\\s*", ""))
