"""Headings of a report, their levels and tree, and chunks along it.

The scan of a document is sequential by nature: the level of a heading depends on the headings before it. One document
is one call of a Python function inside an Arrow batch; documents are independent, so the work spreads over them, and
nothing is grouped or shuffled. A tree is kept as rows that point to their parent's row, never as nested structs.

Modes: ``chinese`` (numbered sections), ``english`` (PART and ITEM), ``simple`` (flat: every heading has level 1, and
every short line outside tables is one). Marks of markdown make a line a candidate; its level comes from its words.
Defined results: null and blank texts have no headings and no chunks; text before the first heading is a preface chunk
with heading_index -1; lines of tables are never headings; a table is never split; an unknown mode counts as simple.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.functions.text import html_lines

LIMIT, DEEPEST, LONGEST, LONGEST_NUMBERED, SEPARATORS = 500, 9, 200, 500, 3
# Forms of headings with their level, tried in this order.
CHINESE = [
    (r"^第[一二三四五六七八九十\d]+[节章]", 1, "section"),
    (r"^[一二三四五六七八九十百]+、", 2, ""),
    (r"^[（(][一二三四五六七八九十百]+[）)]", 3, ""),
    (r"^\d+[、．.]", 3, ""),
    (r"^[（(]\d+[）)]", 4, ""),
    (r"^\d+）", 4, ""),
    (r"^[（(][a-zA-Z][）)]", 5, ""),
    (r"^[（(][ivxlcdmIVXLCDM]+[）)]", 5, ""),
    (r"^[a-zA-Z][、.)]", 5, ""),
    (r"^[ivxlcdmIVXLCDM]+[、.)]", 5, ""),
    (r"\\textcircled\{\d+\}", 6, ""),
]
ENGLISH = [(r"(?i)^part\s+(?:i{1,3}|iv|vi*|ix|x+|\d+)\b", 1, "part"), (r"(?i)^item\s+\d+", 2, "item")]
# Words that make a line without a number a heading.
KEYWORDS = ("目录", "释义", "概述", "总结", "附录", "备查文件")
# Forms of numbers; two headings continue each other only if their numbers have the same form.
NUMBERS = [
    ("numeral then space", r"^([一二三四五六七八九十百]+)、(?=\s)"), ("numeral", r"^([一二三四五六七八九十百]+)、"),
    ("circled", r"^\$?\\textcircled\{(\d+)\}"), ("dotted", r"^(\d+(?:\.\d+)+)"),
    ("arabic、", r"^(\d+)、"), ("arabic．", r"^(\d+)．"), ("arabic.", r"^(\d+)\.(?=\s|$)"),
    ("bracket numeral", r"^[（(]([一二三四五六七八九十百]+)[）)]"), ("bracket arabic", r"^[（(](\d+)[）)]"), ("arabic bracket", r"^(\d+)[）)]"),
    ("bracket small letter", r"^[（(]([a-z])[）)]"), ("bracket capital", r"^[（(]([A-Z])[）)]"), ("small letter", r"^([a-z])[、.)]"), ("capital", r"^([A-Z])[、.)]"),
    ("bracket small roman", r"^[（(]([ivxlcdm]{2,})[）)]"), ("bracket roman", r"^[（(]([IVXLCDM]{2,})[）)]"), ("small roman", r"^([ivxlcdm]{2,})[、.)]"), ("roman", r"^([IVXLCDM]{2,})[、.)]"),
]
MARK = re.compile(r"^#+\s+(.+)$")
SECTION = re.compile(r"第[一二三四五六七八九十\d]+节")
CONTENTS = re.compile(r"\s\d+\s*$|\.\s*\d*\s*$|\.\.\s*\d")
COVER = re.compile(r"年年度报告|^公司$|^年度报告|^股份有限公司")
ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
DIGITS = {c: i for i, c in enumerate("一二三四五六七八九", 1)}


@dataclass
class Heading:
    index: int
    title: str
    level: int
    line: int  # 0-based
    parent: int
    kind: str
    number: int
    prefix: tuple[int, ...] = ()


def mode_of(market: str | None, text: str | None) -> str:
    """How the headings of a report are written, from its market and text."""
    if not text:
        return "simple"
    if market == "hs_stock" and re.search(r"(?m)^#+.*第[一二三四五六七八九十\d]+节", text):
        return "chinese"
    if market == "us_stock" and re.search(r"(?im)^#+\s*part\s+\w", text):
        return "english"
    return "simple"


def value_of(text: str, kind: str) -> int:
    """The value of a number in digits, Chinese numerals, a letter or roman numerals; 0 if it has none."""
    if text.isdigit():
        return int(text)
    if "numeral" in kind:
        total = 0
        for unit, size in (("百", 100), ("十", 10)):
            if unit in text:
                head, _, text = text.partition(unit)
                total += (DIGITS.get(head, 1 if not head else 0)) * size
        return total + DIGITS.get(text, 0)
    if "roman" in kind:
        v = [ROMAN[c] for c in text.lower()]
        return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0]))
    return ord(text.lower()) - 96


def numbered(title: str) -> tuple[str, int, tuple[int, ...]]:
    """(form, last number, numbers before it) of a heading; an empty form if it has no number."""
    for kind, pattern in NUMBERS:
        if m := re.match(pattern, title):
            if kind == "dotted":
                parts = tuple(int(p) for p in m[1].split("."))
                return f"dotted {len(parts)}", parts[-1], parts[:-1]
            return kind, value_of(m[1], kind), ()
    return "", 0, ()


def level_by_form(title: str, mode: str) -> int:
    """The level that the words of a line suggest; 0 if it is no heading."""
    for pattern, level, kind in CHINESE if mode == "chinese" else ENGLISH if mode == "english" else []:
        if re.search(pattern, title):
            listed = kind == "section" and CONTENTS.search(title) or mode == "english" and "(continued)" in title
            return 0 if listed or len(title) > LONGEST_NUMBERED else level
    if len(title) > LONGEST or sum(title.count(c) for c in "。；;.，,") > SEPARATORS:
        return 0
    if mode != "chinese":
        return 3 if mode == "english" else 1
    sections = len(SECTION.findall(title))
    if sections > 1 or not any(k in title for k in KEYWORDS) or "目录" in title and len(title) > 50:
        return 0
    return 1 if sections else 4


class Levels:
    """The headings accepted so far, and the choice of a level for the next one.

    Every earlier heading that the new one may stand beside, and every place that its form allows, is a candidate with a
    score; the best one wins. First come headings whose number it continues: the last one, its ancestors, then the nearest
    (a second number prefers the one nearest to the top). Then a section at the top; a first number one level below the last
    heading; last, headings at most four numbers behind of which at most two are met in between.
    """

    def __init__(self, mode: str):
        self.mode, self.seen = mode, []

    def above(self, h: Heading | None) -> list[Heading]:
        """The ancestors of a heading, the nearest first."""
        out = []
        while h and h.parent >= 0:
            h = self.seen[h.parent]
            out.append(h)
        return out

    @staticmethod
    def gap(new: Heading, old: Heading) -> int:
        """How many numbers a heading is ahead of another of the same form and prefix; 0 if it is not, or has another form."""
        return max(0, new.number - old.number) if new.kind and (new.kind, new.prefix) == (old.kind, old.prefix) else 0

    def candidates(self, new: Heading, base: int) -> Iterator[tuple[tuple, int]]:
        """(score, level) of the places that a heading may take; the least score is the best."""
        last = self.seen[-1] if self.seen else None
        if base == 1 and not new.kind:
            yield (1,), 1
        if new.kind and new.number == 1 and last:
            yield (2,), min(DEEPEST, last.level + 1)
        if not last:
            yield (9,), base
        above = {h.index: k for k, h in enumerate(self.above(last))}
        for h in self.seen:
            ahead = self.gap(new, h)
            if ahead == 1:
                relation = (0 if h is last else 1 if h.index in above else 2, -h.index)
                yield (0, h is not last, h.level if new.number == 2 else 0, *relation), h.level
            elif 1 < ahead <= 4 and (h.index in above or h.level == base):
                between = sum(x.kind == new.kind and h.number < x.number < new.number for x in self.seen)
                if between <= 2:
                    yield (3, h.index not in above, above.get(h.index, -h.index)), h.level

    def level(self, new: Heading, base: int) -> int:
        """The level of a heading, 0 if it is to be dropped."""
        last = self.seen[-1] if self.seen else None
        found = min(self.candidates(new, base), default=((), None))[1]
        parent = next(iter(self.above(last)), None)
        mixed = bool(last) and {last.kind[:6], new.kind[:6]} == {"arabic", "numera"}
        restarts = parent and new.kind and new.kind == parent.kind and new.number < parent.number and not (parent.number >= 5 and new.number <= 2)
        if restarts and not mixed and (found or base) <= parent.level:
            found = min(DEEPEST, parent.level + 1)
        if found is None:  # nothing to stand beside: what the mode says
            found = base if mixed else 0 if self.mode == "chinese" else min(base, last.level + 1)
        elif last:
            found = min(found, last.level + 1)
        if not found:
            return 0
        found = max(1, min(DEEPEST, found))
        before = next((h for h in reversed(self.seen) if h.level == found), None)
        leaves_gap = new.kind and not new.kind.startswith("dotted") and new.number != 1 and before and before.kind and self.gap(new, before) != 1
        return 0 if leaves_gap else found

    def add(self, title: str, line: int, base: int) -> None:
        kind, number, prefix = numbered(title)
        new = Heading(len(self.seen), title, 0, line, -1, kind, number, prefix)
        new.level = 1 if self.mode == "simple" else self.level(new, base)
        if not new.level:
            return
        up = next((h for h in reversed(self.seen) if h.level < new.level), None)
        if self.mode == "chinese" and up and up.title.startswith("第一节"):
            return  # nothing is looked for below the first section
        new.parent = up.index if up else -1
        self.seen.append(new)


def headings(text: str | None, mode: str) -> list[Heading]:
    """The headings of a text with levels and parents, in order."""
    levels, depth = Levels(mode), 0
    for at, raw in enumerate((text or "").split("\n")):
        line = raw.strip()
        if not line:
            continue
        depth = max(0, depth + raw.count("<table") - raw.count("</table>"))
        if depth > 0 or "</table>" in raw:
            continue
        m = MARK.match(line)
        title = m[1].strip() if m else line
        base = level_by_form(title, mode)
        if not m and not base or len(title) < 30 and COVER.search(title) or re.search(r"\. (?:[A-Z]|\.\.\s*\d*)\s*$", title):
            continue
        if base or mode == "simple":
            levels.add(title, at, base)
    return levels.seen


def packed(lines: list[str], limit: int) -> list[tuple[int, int]]:
    """(first, last + 1) of runs of lines up to ``limit`` characters; a table stays whole, as does a longer line."""
    blocks, i = [], 0
    while i < len(lines):
        j, depth = i + 1, lines[i].lower().count("<table") - lines[i].lower().count("</table>")
        while depth > 0 and j < len(lines):
            depth += lines[j].lower().count("<table") - lines[j].lower().count("</table>")
            j += 1
        blocks.append((i, j, sum(len(x) + 1 for x in lines[i:j])))
        i = j
    out, start, size = [], 0, 0
    for a, b, n in blocks:
        if size and size + n - 1 > limit:
            out.append((start, a))
            start, size = a, 0
        size += n
    if lines:
        out.append((start, len(lines)))
    return out


def tidied(body: str) -> str:
    """Text of a chunk: mostly tables, only these; with tables, the text beside them cleaned; else without blank ends."""
    tables = re.findall(r"<table.*?</table>", body, re.S)
    if not tables:
        return body.strip("\n")
    if sum(map(len, tables)) > 0.8 * len(body):
        return "\n".join(tables)
    parts = re.split(r"(<table.*?</table>)", body, flags=re.S)
    clean = lambda t: "\n".join(x for x in (re.sub(" +", " ", y).strip() for y in t.split("\n")) if x)
    return "\n".join(x for x in (p if p.startswith("<table") else clean(p) for p in parts) if x)


def chunks(text: str | None, mode: str, limit: int = LIMIT) -> list[dict]:
    """Chunks of a text along its headings, numbered from 0; a chunk's parent is the first piece of its heading's parent."""
    lines, tree = (text or "").split("\n"), headings(text, mode)
    spans = [(h.line, tree[k + 1].line if k + 1 < len(tree) else len(lines), h) for k, h in enumerate(tree)]
    first = tree[0].line if tree else len(lines)
    parts = ([(0, first, None)] if first else []) + spans
    out, first_piece = [], {}
    for a, b, h in parts:
        own = lines[a:b]
        pieces = [(x, y) for x, y in packed(own, limit) if "\n".join(own[x:y]).strip()]
        for n, (x, y) in enumerate(pieces, 1):
            body = tidied("\n".join(own[x:y]))
            name = h.title if h else None
            if h:
                first_piece.setdefault(h.index, len(out))
            out.append(
                {
                    "chunk_index": len(out), "title": f"{name} (Part {n})" if name and len(pieces) > 1 else name, "title_level": h.level if h else None,
                    "heading_index": h.index if h else -1, "parent_index": first_piece.get(h.parent) if h else None, "start_line": a + x + 1,
                    "end_line": a + y, "is_table": "<table" in body.lower(), "chunk_text": body,
                }
            )
    return out


HEADING_ROWS = "doc string, heading_index int, title string, level int, line int, parent_index int"
CHUNK_ROWS = "doc string, chunk_index int, title string, title_level int, heading_index int, parent_index int, start_line int, end_line int, is_table boolean, chunk_text string"


def heading_rows(docs: DataFrame) -> DataFrame:
    """Headings of documents (doc, market, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, h.index, h.title, h.level, h.line + 1, h.parent) for d, m, t in zip(pdf["doc"], pdf["market"], pdf["text"]) for h in headings(t, mode_of(m, t))]
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in HEADING_ROWS.split(", ")])

    return docs.select("doc", "market", "text").mapInPandas(run, HEADING_ROWS)


def chunk_rows(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Chunks of documents (doc, market, text)."""
    names = [f.split()[0] for f in CHUNK_ROWS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [{"doc": d, **c} for d, m, t in zip(pdf["doc"], pdf["market"], pdf["text"]) for c in chunks(t, mode_of(m, t), limit)]
            out = pd.DataFrame(rows, columns=names)
            for c in ("title_level", "parent_index"):
                out[c] = out[c].astype("Int32")
            yield out

    return docs.select("doc", "market", "text").mapInPandas(run, CHUNK_ROWS)


def modes(docs: DataFrame) -> DataFrame:
    """(doc, mode) of documents (doc, market, text), on the JVM."""
    t = F.coalesce("text", F.lit(""))
    chinese = (F.col("market") == "hs_stock") & t.rlike(r"(?m)^#+.*第[一二三四五六七八九十\d]+节")
    english = (F.col("market") == "us_stock") & t.rlike(r"(?im)^#+\s*part\s+\w")
    return docs.select("doc", F.when(chinese, "chinese").when(english, "english").otherwise("simple").alias("mode"))


def loaded(rows: DataFrame) -> DataFrame:
    """(id, place, title, level) out of JSON (id, body) that is a list of headings or an object with one under ``structure``."""
    kind = "array<struct<title: string, level: int>>"
    bare, wrapped = F.from_json("body", kind), F.from_json("body", f"structure {kind}")["structure"]
    body = F.when(F.ltrim("body").startswith("["), bare).otherwise(wrapped)
    return rows.select("id", F.posexplode(body).alias("place", "h")).select("id", "place", "h.title", "h.level").where("title IS NOT NULL")


def outcomes(docs: DataFrame, force: bool = False) -> DataFrame:
    """(doc, outcome, chunks): what chunking did with documents (doc, market, text, chunks_count): chunked, empty, or skipped as it had been."""
    again = F.lit(force) | (F.coalesce("chunks_count", F.lit(0)) == 0)
    n = chunk_rows(docs.where(again)).groupBy("doc").agg(F.count("*").alias("chunks"))
    met = docs.select("doc", again.alias("again")).join(n, "doc", "left")
    return met.select("doc", F.when(~F.col("again"), "skipped").when(F.col("chunks") > 0, "chunked").otherwise("empty").alias("outcome"), F.coalesce("chunks", F.lit(0)).alias("chunks"))


def page_faults(pages: DataFrame, words: tuple[str, ...] = ("招股说明书", "招股书"), least_bytes: int = 1024, least_text: int = 100) -> DataFrame:
    """(id, fault) of pages (id, content): too small, encoding, short text, no keyword, or null where nothing is wrong."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "size": [len(b or b"") for b in pdf["content"]], "text": [first_fitting(bytes(b or b"")) for b in pdf["content"]]})

    kind = pages.schema["id"].dataType.simpleString()
    read = pages.select("id", "content").mapInPandas(run, f"id {kind}, size int, text string")
    plain = F.array_join(html_lines(F.regexp_replace("text", "(?s)<!--.*?-->", "")), "\n")
    body = read.withColumn("plain", plain)
    fault = F.when(F.col("size") < least_bytes, "too small").when(F.col("text").isNull(), "encoding").when(F.length("plain") < least_text, "short text").when(~F.col("plain").rlike("|".join(words)), "no keyword")
    return body.select("id", fault.alias("fault"))


def first_fitting(content: bytes) -> str | None:
    """Bytes as text in the first of some encodings that fits, None if none does."""
    for name in ("utf-8", "gb2312", "gbk"):
        try:
            return content.decode(name)
        except UnicodeDecodeError:
            continue
    return None
