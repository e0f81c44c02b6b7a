"""Problem 4: noise in the text of scanned pages, and continuous paragraphs out of it.

Method: the words of all pages are the dictionary. Words look up candidates that were read much more often through an
inverted join on character q-grams, of which only the rarest of each word are needed. What scanners confuse is learned from
these pairs: the edits that turn a frequent word into a rare one are counted, and an edit that explains many rare words has
a high rate. A gradient-boosted ranker over rates and counts, trained on words of the dictionary that were misread on
purpose by the learned edits, chooses the replacement or none. Numbers take the same way; where no number of the dictionary
stands behind one, its characters are read by the learned rates of digits.

Running lines are found by a classifier of pairs of lines: how alike two lines of different pages are, whether a number in
them counts with the pages, how they stand. It is fitted on pairs of these pages: lines at the same edge of neighbouring
pages against lines inside of them; its threshold is what lines inside pages do not reach.

Scale: a file is worked on in blocks of ``BLOCK`` pages that also see ``AROUND`` pages on either side. A line is compared with
lines of pages up to ``AROUND`` away and with nothing else, so the result does not depend on the blocks. Dictionary, q-grams
and replacements stay distributed. The driver sees bounded things only: ``PAGES`` pages and ``WORDS`` words to fit the
models on, and the table of edits, whose number the characters of the script bound and not the pages.

Defined results: null and empty pages give no noise; a page number belongs to a line of its own, a header may hold it; running
lines stand among the first or last ``EDGE`` filled lines of a page; a broken word is also corrected if it was misread; a null
first line means that a page has no place in its file and is left out; repeated pages give each finding once; a file with a
single page has no running lines. Words of one or two characters are not looked up.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.session import cut

BLOCK, AROUND, EDGE, PAGES, WORDS, GRAM = 64, 8, 4, 1500, 4000, 3
KNOWN, RATIO, SUPPORT = 3, 4, 2  # readings that make a word evidence; how much more often it was read; words that make an edit
ENDS = ".,;:()%\"'"
HYPHENS = "-\xad¬‐‑"
# Shapes of digits, for a character of which the pages hold no evidence; learned rates go before it.
DIGITS = {"l": "1", "I": "1", "i": "1", "|": "1", "!": "1", "O": "0", "o": "0", "Q": "0", "Z": "2", "z": "2", "S": "5", "s": "5", "b": "6", "G": "6", "B": "8", "g": "9", "q": "9"}
# The forms in which a page's number stands alone.
NUMERAL = r"[\dlIiOoZzSsBbgq|!]{1,4}"
PAGE_FORMS = [rf"({NUMERAL})\s*/\s*{NUMERAL}", rf"[\[(]\s*({NUMERAL})\s*[\])]", rf"[-–—]\s*({NUMERAL})\s*[-–—]", rf"(?i:p\w{{2,4}})\.?\s+({NUMERAL})(?:\s+(?:of|o\w)\s+{NUMERAL})?", rf"({NUMERAL})"]
ALONE = [re.compile(x) for x in PAGE_FORMS]
ROMAN = re.compile("(?=[ivxlIVXL1!|])(?:x{0,3})(?:ix|iv|v?i{0,3})", re.I)
ROMAN_ONES = ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]
FOUND = "markdown_path string, line_no int, kind string, word string, other string, raw string"
FEATURES = 9


def to_roman(n: int) -> str:
    """A small number in roman numerals; empty outside 1 to 39."""
    return "x" * (n // 10) + ROMAN_ONES[n % 10] if 0 < n < 40 else ""


def alone(line: str) -> bool:
    """Whether a line holds nothing but what can be a page's number."""
    t = line.strip()
    return bool(t) and (any(p.fullmatch(t) for p in ALONE) or bool(ROMAN.fullmatch(re.sub("[1!|l]", "i", t.lower()))))


class Line:
    """A line at a page's edge and what the classifier of pairs looks at."""

    __slots__ = ("page", "at", "text", "side", "place", "masked", "pairs", "tokens", "short", "free", "open", "words")

    def __init__(self, page: int, at: int, text: str, side: str, place: int, width: int, free: bool):
        self.page, self.at, self.text, self.side, self.place, self.free = page, at, text, side, place, free
        bare = text.strip()
        self.tokens, self.masked = masked(bare)
        self.pairs = pairs_of(self.masked)
        self.short = 1 - min(1.0, len(bare) / max(1, width))
        self.open = not bare.endswith((".", ",", ";", "-"))
        self.words = any(c.isalpha() for c in self.masked)


@lru_cache(maxsize=8192)
def masked(text: str) -> tuple[tuple[str, ...], str]:
    """(tokens that may be numbers, the text in small letters with these as one mark)."""
    whole = re.sub("[1!|l]", "i", text.lower())
    if len(text) <= 6 and ROMAN.fullmatch(whole) or ALONE[-1].fullmatch(text):
        return (text,), "#"
    tokens: list[str] = []

    def mark(m: re.Match) -> str:
        tokens.append(m[0])
        return "#"

    plain = re.sub(r"(?<![\w|!.,])(?=[\w|!]*\d)[\w|!]{1,4}(?![\w|!%]|[.,]\d)", mark, text)
    return tuple(tokens), " ".join(plain.lower().split())


@lru_cache(maxsize=8192)
def pairs_of(text: str) -> frozenset[str]:
    """The neighbouring pairs of characters of a line."""
    return frozenset(map("".join, zip(f"^{text}", f"{text}$")))


def counts_with(token: str, other: str, ahead: int) -> float:
    """How well a token reads as the number of another one plus the pages between: 1 if it is that number, less for every
    character that is no digit; 0 if a digit differs, as then it is another number."""
    sure = 1.0
    if not other.isdigit() and (shaped := other.translate(SHAPES)).isdigit():
        other, sure = shaped, 0.8
    if other.isdigit():
        due = str(int(other) + ahead)
    elif not token.isdigit() and (low := other.lower()) in ROMANS:
        due = to_roman(ROMANS[low] + ahead)
    else:
        return 0.0
    seen = token.lower() if due and not due.isdigit() else token
    if not due or len(seen) != len(due) or any(a != b and a.isdigit() for a, b in zip(seen, due)):
        return 0.0
    return sure * sum(1.0 if a == b else 0.7 for a, b in zip(seen, due)) / len(due)


ROMANS = {to_roman(n): n for n in range(1, 40)}
SHAPES = str.maketrans(DIGITS)


def pair_features(a: Line, b: Line) -> tuple[float, ...]:
    """What the classifier knows about two lines of different pages."""
    both = len(a.pairs & b.pairs)
    like = 2 * both / (len(a.pairs) + len(b.pairs))
    counting, numbered = 0.0, 0.0
    if a.tokens and b.tokens and like > 0.8:
        numbered, ahead = 1.0, a.page - b.page
        counting = max(max(counts_with(x, y, ahead), counts_with(y, x, -ahead)) for x, y in zip(a.tokens, b.tokens))
    told = like * counting
    if not (a.words and b.words):  # two lone numbers are alike whatever they are
        like = 0.0
    return like, like**4, counting, numbered, told, min(a.short, b.short), float(a.free and b.free), float(a.place == b.place), like**4 * (a.open and b.open)


@lru_cache(maxsize=8192)
def signature(text: str) -> bytes:
    """Its pairs of characters as bits of a fixed width."""
    v = 0
    for g in pairs_of(text):
        v |= 1 << (zlib.crc32(g.encode()) & 255)
    return v.to_bytes(32, "little")


def alike(lines: list[Line], least: float = 0.5, step: int = 256) -> list[np.ndarray]:
    """For each line the places of those on other pages up to AROUND away, at the same edge, that may share ``least`` of their pairs."""
    if not lines:
        return []
    bits = np.frombuffer(b"".join(signature(x.masked) for x in lines), np.uint64).reshape(len(lines), 4)
    size = np.bitwise_count(bits).sum(axis=1, dtype=np.int32)
    page, side, out = np.array([x.page for x in lines]), np.array([x.side for x in lines]), []
    for at in range(0, len(lines), step):
        own = slice(at, at + step)
        both = np.bitwise_count(bits[own, None] & bits[None]).sum(axis=2, dtype=np.int32)
        gap = np.abs(page[own, None] - page[None])
        fit = (2 * both >= least * (size[own, None] + size[None])) & (gap > 0) & (gap <= AROUND) & (side[own, None] == side[None])
        out += [np.flatnonzero(r) for r in fit]
    return out


class Running:
    """The classifier of pairs of lines with its threshold, which holds for the sum of a line's three best pages."""

    def __init__(self, w: np.ndarray, bias: float, least: float):
        self.w, self.bias, self.least = tuple(map(float, w)), bias, least

    def score(self, a: Line, b: Line) -> float:
        return self.bias + sum(w * x for w, x in zip(self.w, pair_features(a, b)))

    def support(self, line: Line, others: list[Line]) -> float:
        """The scores of the three pages that speak most for a line; a page's best line counts."""
        best: dict[int, float] = {}
        for o in others:
            best[o.page] = max(best.get(o.page, -9.0), self.score(line, o))
        return sum(sorted((x for x in best.values() if x > 0), reverse=True)[:3]) or -9.0


def lines_of(pages: list[tuple[int, int, list[str]]], inner: bool = True) -> tuple[dict[int, list[Line]], dict[int, list[Line]]]:
    """(lines at the edges, lines inside if asked for) of pages (number, first line, lines), by page."""
    edge, inside = {}, {}
    for no, first, lines in pages:
        at = [k for k, x in enumerate(lines) if x.strip()]
        width = max((len(lines[k]) for k in at), default=0)
        blank = lambda k, lines=lines: k < 0 or k >= len(lines) or not lines[k].strip()
        make = lambda k, side, place, no=no, first=first, lines=lines, width=width: Line(no, first + k, lines[k], side, place, width, blank(k - 1) or blank(k + 1))
        top, low = at[:EDGE], at[-EDGE:]  # on a short page a line stands at both edges
        marked = lambda k, lines=lines: lines[k].lstrip().startswith("#")
        edge[no] = [make(k, "top", place) for place, k in enumerate(top) if not marked(k)] + [make(k, "low", len(low) - 1 - place) for place, k in enumerate(low) if not marked(k)]
        inside[no] = [make(k, "in", place % EDGE) for place, k in enumerate(at[EDGE:-EDGE]) if inner and not marked(k)]
    return edge, inside


# What the weights start from and are drawn to where pages are few.
PRIOR = np.array([1.0, 3.0, 2.0, -1.0, 3.0, 1.0, 0.5, 0.5, 0.5])


def fit_running(files: list[list[tuple[int, int, list[str]]]], rounds: int = 300) -> Running:
    """The classifier out of the pages of some files, given as (number, first line, lines) in order.

    A line at an edge with the most alike one at the same edge of the next page is a pair of the one kind, a line inside with
    the most alike one inside the next page one of the other. Many of the first kind are text, which keeps the classifier
    careful. The threshold lies a quarter of the way from what 995 of 1,000 lines inside reach, when they look for support as
lines at edges do, to what the best tenth of outermost lines reach, and at least at 4 (odds of about 50 to 1).
    """
    x, y, kept = [], [], []
    for pages in files:
        following = dict(zip([no for no, *_ in pages], [no for no, *_ in pages[1:]]))
        for kind, by in zip((1, 0), lines_of(pages)):
            lines = [a for own in by.values() for a in own]
            near = alike(lines)
            beside = {(a.page, a.side, a.place): a for a in lines}
            for a, found in zip(lines, near):
                on = [lines[k] for k in found if lines[k].page == following.get(a.page)] or [b for b in (beside.get((following.get(a.page), a.side, a.place)),) if b]
                if on:
                    best = max(on, key=lambda b: (2 * len(a.pairs & b.pairs) / (len(a.pairs) + len(b.pairs)), -abs(a.place - b.place)))
                    x.append(pair_features(a, best))
                    y.append(kind)
            kept.append((kind, lines, near))
    w, bias = PRIOR.copy(), -4.0
    if x and 0 < sum(y) < len(y):
        xs, ys = np.array(x), np.array(y, float)
        weight = np.where(ys > 0, 0.5 / ys.mean(), 0.5 / (1 - ys.mean()))
        for _ in range(rounds):
            error = (ys - 1 / (1 + np.exp(-np.clip(xs @ w + bias, -30, 30)))) * weight
            w += 0.5 * (xs.T @ error / len(xs) + 20 / len(xs) * (PRIOR - w))
            bias += 0.5 * (error.mean() + 20 / len(xs) * (-4.0 - bias))
    model, reached, ran = Running(w, bias, 4.0), [], []
    for kind, lines, near in kept:
        for k, (a, found) in enumerate(zip(lines, near)):
            if kind and a.place == 0:
                ran.append(model.support(a, [lines[i] for i in found]))
            elif not kind and k % 4 == 0:
                reached.append(model.support(a, [lines[i] for i in found]))
    if reached and ran:
        model.least = max(4.0, 0.75 * float(np.quantile(reached, 0.995)) + 0.25 * float(np.quantile(ran, 0.9)))
    return model


def furniture(pages: list[tuple[int, int, list[str]]], mine: set[int], model: Running) -> dict[int, str]:
    """kind by line number of the running lines of the pages in ``mine`` (page number, first line, lines)."""
    lines = [a for own in lines_of(pages, inner=False)[0].values() for a in own]
    out: dict[int, str] = {}
    for line, found in zip(lines, alike(lines)):
        if line.page in mine and model.support(line, [lines[k] for k in found]) > model.least:
            out[line.at] = "page_number" if alone(line.text) else "header"
    return out


def block_rows(own: pd.DataFrame, path: str, block: int, model: Running, size: int = BLOCK) -> list[tuple]:
    """Findings and words of the pages of a block; other pages given are context."""
    own = own.drop_duplicates(["page_no", "first_line"]).sort_values(["first_line", "page_no"])
    pages = [(int(n), int(f), t.split("\n")) for n, f, t in zip(own["page_no"], own["first_line"], own["page_text"])]
    mine = {n for n, *_ in pages if n // size == block}
    # the page after the last one is looked at too, as a word may be broken over both
    marks = furniture(pages, mine | {n + 1 for n in mine}, model)
    rows, content = [], []
    for no, first, lines in pages:
        for k, line in enumerate(lines):
            if mark := marks.get(first + k):
                if no in mine:
                    rows.append((path, first + k, mark, "", None, None))
            elif line.strip():
                content.append((no, first + k, line))
    skip_first = False
    for (no, at, line), following in zip(content, [*content[1:], (None, None, "")]):
        tokens = line.split()
        if skip_first:
            tokens = tokens[1:]
        skip_first = False
        tail = line.rstrip()
        if tokens and len(tail) > 2 and tail[-1] in HYPHENS and tail[-2].isalpha() and following[1] is not None:
            nxt = following[2].split()
            head = tokens[-1].rstrip(HYPHENS).lstrip("(\"'")
            if nxt and nxt[0][:1].isalpha() and nxt[0][:1].islower() and re.search(r"[^\W\d]", head):
                if no in mine:
                    rows.append((path, at, "hyphen", head.lower().strip(ENDS), nxt[0].lower().strip(ENDS), None))
                tokens, skip_first = tokens[:-1], True
        if no in mine:
            for t in tokens:
                bare = t.strip(ENDS)
                if t.startswith("(") and bare and not t.endswith(")") and t[1:2].isalpha() and t[1:2].islower():
                    rows.append((path, at, "token", bare.lower(), t.rstrip(ENDS).lower(), bare))
                elif bare:
                    rows.append((path, at, "token", bare.lower(), None, bare))
    return rows


def blocks_of(page: Column, size: int = BLOCK) -> Column:
    """The blocks that see a page: a block's last page is followed by one more whose running lines it looks for."""
    b = lambda n: F.floor((page + n) / size).cast("int")
    return F.array_distinct(F.array(b(0), b(-AROUND - 1), b(AROUND)))


def scanned_blocks(pages: DataFrame, size: int = BLOCK) -> DataFrame:
    """Pages with each block that sees them."""
    fit = pages.where("page_text IS NOT NULL AND first_line IS NOT NULL AND page_no IS NOT NULL AND markdown_path IS NOT NULL")
    return fit.select("markdown_path", "page_no", "first_line", "page_text", F.explode(blocks_of(F.col("page_no"), size)).alias("block"))


def training_files(pages: DataFrame, limit: int = PAGES) -> list[list[tuple[int, int, list[str]]]]:
    """At most ``limit`` pages of whole runs of files, in order of a hash of the file."""
    lot = F.xxhash64("markdown_path", F.floor(F.col("page_no") / BLOCK))
    fit = pages.where("page_text IS NOT NULL AND first_line IS NOT NULL AND page_no IS NOT NULL AND markdown_path IS NOT NULL")
    rows = fit.select("markdown_path", "page_no", "first_line", "page_text", lot.alias("lot")).orderBy("lot", "markdown_path", "page_no", "first_line").limit(limit).collect()
    files: dict[tuple, dict[int, tuple]] = {}
    for r in rows:
        files.setdefault((r["lot"], r["markdown_path"]), {}).setdefault(r["page_no"], (r["page_no"], r["first_line"], r["page_text"].split("\n")))
    return [[own[n] for n in sorted(own)] for own in files.values()]


def rows_of(pages: DataFrame, model: Running | None = None, size: int = BLOCK) -> DataFrame:
    """Furniture, broken words and words of all pages (markdown_path, page_no, first_line, page_text)."""
    fitted = model or fit_running(training_files(pages))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = block_rows(pdf, pdf["markdown_path"].iloc[0], int(pdf["block"].iloc[0]), fitted, size)
        return pd.DataFrame(rows, columns=[f.split()[0] for f in FOUND.split(", ")])

    return scanned_blocks(pages, size).groupBy("markdown_path", "block").applyInPandas(run, FOUND)


@lru_cache(maxsize=65536)
def edits(word: str, seen: str) -> tuple[tuple[str, str], ...]:
    """The one or two edits that turn a word into what was read, each of one or two characters for one or two; none if it takes more.

    Equal ends are set aside first; of several ways the one with fewest characters is taken.
    """
    i = 0
    while i < min(len(word), len(seen)) and word[i] == seen[i]:
        i += 1
    j = 0
    while j < min(len(word), len(seen)) - i and word[-1 - j] == seen[-1 - j]:
        j += 1
    x, y = word[i : len(word) - j], seen[i : len(seen) - j]
    if not x or not y:  # a character beside the gap belongs to the edit
        if i:
            x, y, i = word[i - 1] + x, seen[i - 1] + y, i - 1
        elif j:
            x, y = x + word[len(word) - j], y + seen[len(seen) - j]
    if not x or not y or x in y or y in x:  # something was added or dropped, not read as something else
        return ()
    if len(x) <= 2 and len(y) <= 2 and (len(x) == 1 or len(y) == 1):
        return ((x, y),)
    best: tuple = ()
    for a in (1, 2):
        for b in (1, 2):
            if a + b == 4 or a >= len(x) or b >= len(y):
                continue
            u, v = x[a:], y[b:]
            k = 0
            while k < min(len(u), len(v)) - 1 and u[k] == v[k]:
                k += 1
            u, v = u[k:], v[k:]
            if u and v and u not in v and v not in u and x[:a] not in y[:b] and y[:b] not in x[:a] and len(u) <= 2 and len(v) <= 2 and (len(u) == 1 or len(v) == 1):
                way = ((x[:a], y[:b]), (u, v))
                if not best or sum(map(len, way[0] + way[1])) < sum(map(len, best[0] + best[1])):
                    best = way
    return best


class Channel:
    """How often each edit is made, per place where it could be; ``floor`` for one that was never seen."""

    def __init__(self, rates: dict[tuple[str, str], float], floor: float = 1e-7):
        self.rates, self.floor = rates, floor

    def cost(self, word: str, seen: str) -> tuple[int, float, float]:
        """(number of edits or 9, log rate of all of them, log rate of the rarest)."""
        own = edits(word, seen)
        if not own:
            return 9, 2 * float(np.log(self.floor)), float(np.log(self.floor))
        logs = [float(np.log(self.rates.get(e, self.floor))) for e in own]
        return len(own), sum(logs), min(logs)

    def digit_map(self) -> tuple[str, str]:
        """Two texts for ``translate``: characters that digits were read as, and these digits; the shapes fill what is not learned."""
        best: dict[str, tuple[float, str]] = {c: (0.0, d) for c, d in DIGITS.items()}
        for (a, b), r in self.rates.items():
            if len(a) == len(b) == 1 and a.isdigit() and not b.isdigit() and b.isascii() and b not in ".,/%+-" and r > best.get(b, (0.0, ""))[0]:
                best[b] = (r, a)
        return "".join(best), "".join(d for _, d in best.values())


def grams_of(word: str) -> set[str]:
    """Character q-grams of a word with marked ends."""
    w = f"^{word}$"
    return {w[i : i + GRAM] for i in range(len(w) - GRAM + 1)} or {w}


def features(seen: str, n_seen: int, word: str, n_word: int, cap_seen: float, cap_word: float, channel: Channel) -> list[float]:
    """What the ranker knows about a candidate; ``cap`` is the share of readings with a capital."""
    n, rate, rarest = channel.cost(word, seen)
    a, b = grams_of(seen), grams_of(word)
    odd = sum(not (c.isalpha() or c in "-'’") for c in seen)
    ratio = float(np.log1p(n_word) - np.log1p(n_seen))
    return [n, rate, rarest, ratio, ratio + rate, odd, len(word), len(a & b) / len(a | b), abs(len(seen) - len(word)), float(seen[:1] == word[:1]), float(np.log1p(n_seen)), cap_seen, cap_word]


class Boosted:
    """Gradient-boosted regression trees of depth 2 on the logistic loss."""

    def __init__(self, trees: int = 60, rate: float = 0.3, cuts: int = 16):
        self.trees, self.rate, self.cuts, self.model, self.start, self.least = trees, rate, cuts, [], 0.0, 0.0

    def split(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
        best, out = -1.0, (0, np.inf)
        for f in range(x.shape[1]):
            for t in np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.cuts + 2)[1:-1])):
                left = x[:, f] <= t
                if not left.any() or left.all():
                    continue
                gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1)
                if gain > best:
                    best, out = gain, (f, float(t))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.start = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        score = np.full(len(x), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            f, t = self.split(x, g, h)
            tree = [(f, t)]
            for side in (x[:, f] <= t, x[:, f] > t):
                f2, t2 = self.split(x[side], g[side], h[side]) if side.sum() > 4 else (0, np.inf)
                leaves = []
                for own in (side & (x[:, f2] <= t2), side & (x[:, f2] > t2)):
                    leaves.append(self.rate * g[own].sum() / (h[own].sum() + 1) if own.any() else 0.0)
                    score[own] += leaves[-1]
                tree.append((f2, t2, *leaves))
            self.model.append(tree)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for (f, t), *sides in self.model:
            left = x[:, f] <= t
            for side, (f2, t2, a, b) in zip((left, ~left), sides):
                out += np.where(side, np.where(x[:, f2] <= t2, a, b), 0)
        return out


def train_ranker(words: list[tuple[str, int, float]], channel: Channel) -> Boosted:
    """A ranker from dictionary words (word, count, share of capitals): some misread on purpose by the edits learned, some right but unknown."""
    rng = np.random.default_rng(9)
    known, cap = {w: n for w, n, _ in words}, {w: c for w, _, c in words}
    frequent = [w for w, *_ in words if len(w) >= 3]
    index = defaultdict(set)
    for w in known:
        for g in grams_of(w):
            index[g].add(w)
    ways = defaultdict(list)
    for (a, b), r in channel.rates.items():
        ways[a].append((b, r))

    def near(seen: str) -> list[str]:
        hits = Counter(w for g in grams_of(seen) for w in index[g] if abs(len(w) - len(seen)) <= 2 and w != seen)
        return [w for w in sorted(hits, key=lambda w: (-hits[w], w))[:12] if edits(w, seen)][:6]

    def misread(word: str) -> str:
        for _ in range(1 + (rng.random() < 0.15)):
            fits = [(i, a, b, r) for i in range(len(word)) for a in (word[i], word[i : i + 2]) for b, r in ways.get(a, ())]
            if fits:
                p = np.array([f[3] for f in fits])
                i, a, b, _ = fits[rng.choice(len(fits), p=p / p.sum())]
                word = word[:i] + b + word[i + len(a) :]
        return word

    x, y = [], []
    for k in range(2400 if frequent else 0):
        word = frequent[rng.integers(len(frequent))]
        if k % 3:
            seen = misread(word)
            if seen == word or seen in known:
                continue
            n = max(1, int(known[word] * 10 ** rng.uniform(-3.5, -0.8)))
            options = sorted({word, *near(seen)})
        else:  # right though unknown: the word itself is not offered
            seen, n, options = word, 1 if k % 2 else max(1, int(known[word] * 10 ** rng.uniform(-1, 0))), near(word)
        for c in options:
            if known[c] >= RATIO * n:
                x.append(features(seen, n, c, known[c], cap[word], cap[c], channel))
                y.append(bool(k % 3) and c == word)
    if not x or not any(y) or all(y):
        return Boosted(0)
    xs, ys = np.array(x, float), np.array(y, float)
    model = Boosted().fit(xs, ys)
    score = model.score(xs)  # a candidate is taken between what nearly all right ones reach and nearly no wrong one does
    model.least = min(0.0, float(np.quantile(score[ys > 0], 0.01) + np.quantile(score[ys == 0], 0.97)) / 2)
    return model


def candidates(vocabulary: DataFrame, queries: DataFrame) -> DataFrame:
    """(seen, word, n_seen, n_word, cap_seen, cap_word): dictionary words (word, n, cap) that share one of the rarest q-grams of a query and were read more often.

    One edit touches at most GRAM + 1 q-grams, so of the 2 * (GRAM + 1) + 1 rarest of a word one survives two. Words of up to
    four characters also share their forms with one character open.
    """
    padded = lambda c: F.concat(F.lit("^"), F.col(c), F.lit("$"))
    places = lambda c: F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c)))
    grams = lambda c: F.transform(places(c), lambda i: padded(c).substr(i, F.lit(GRAM)))
    gaps = lambda c: F.transform(places(c), lambda i: F.concat(F.lit("?"), F.col(c).substr(F.lit(1), i - 1), F.lit("?"), F.col(c).substr(i + 1, F.lit(9))))
    every = lambda c: F.array_distinct(F.when(F.length(c) <= 4, F.concat(grams(c), gaps(c))).otherwise(grams(c)))
    postings = vocabulary.select(F.col("word"), F.col("n").alias("n_word"), F.col("cap").alias("cap_word"), F.explode(every("word")).alias("gram"))
    size = postings.groupBy("gram").agg(F.count("*").alias("size"))
    asked = queries.select(F.col("word").alias("seen"), F.col("n").alias("n_seen"), F.col("cap").alias("cap_seen"), F.explode(every("word")).alias("gram"))
    rarest = Window.partitionBy("seen").orderBy("size", "gram")
    kept = asked.join(size, "gram").withColumn("rn", F.row_number().over(rarest)).where((F.col("rn") <= 2 * (GRAM + 1) + 1) | F.col("gram").startswith("?"))
    # a gram meets many words, so the pairs are many times their inputs: partitions are not merged by the inputs' sizes
    parts = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = kept.repartition(parts, "gram").join(postings.repartition(parts, "gram"), "gram")
    fit = met.where((F.col("seen") != F.col("word")) & (F.abs(F.length("seen") - F.length("word")) <= 2) & (F.col("n_word") >= RATIO * F.col("n_seen")))
    near = fit.where(F.levenshtein("seen", "word", 4) >= 0)  # two edits are at most four changes
    return near.groupBy("seen", "word").agg(*(F.first(c).alias(c) for c in ("n_seen", "n_word", "cap_seen", "cap_word")))


PAIR = ["seen", "word", "n_seen", "n_word", "cap_seen", "cap_word"]


def explained(pairs: DataFrame) -> DataFrame:
    """(seen, word, n_seen, n_word, cap_seen, cap_word, one, two): candidates with the edits between; those that take more than two are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, word = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own = [edits(w, s) for s, w in zip(seen, word)]
            keep = [k for k, e in enumerate(own) if e]
            name = lambda e: f"{e[0]}\t{e[1]}"
            one = pa.array([name(own[k][0]) for k in keep], pa.string())
            two = pa.array([name(own[k][1]) if len(own[k]) > 1 else None for k in keep], pa.string())
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(keep, pa.int64())) for c in batch.columns), one, two], [*PAIR, "one", "two"])

    return pairs.select(*PAIR).mapInArrow(run, "seen string, word string, n_seen bigint, n_word bigint, cap_seen double, cap_word double, one string, two string")


def learned(pairs: DataFrame, counts: DataFrame) -> Channel:
    """The rates of edits: readings that an edit explains, over the places where it could have been made.

    Each reading speaks for the most frequent of its candidates at one edit, of numbers for those first that the shapes of digits
    allow. Readings that always have a capital are left out, as names differ from each other as misread words do. An edit counts
    once SUPPORT different readings speak for it.
    """
    shaped = F.translate("seen", "".join(DIGITS), "".join(DIGITS.values())) == F.col("word")
    best = Window.partitionBy("seen").orderBy(F.desc(shaped), F.desc("n_word"), "word")
    single = pairs.where("two IS NULL AND cap_seen < 0.9").withColumn("rn", F.row_number().over(best)).where("rn = 1")
    told = single.groupBy("one").agg(F.sum("n_seen").alias("n"), F.count("*").alias("words")).where(F.col("words") >= SUPPORT)
    piece = lambda k: F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.col("word").substr(i, F.lit(k)))
    places = counts.select("n", F.explode(F.concat(piece(1), piece(2))).alias("a")).groupBy("a").agg(F.sum("n").alias("places"))
    rows = told.withColumn("a", F.substring_index("one", "\t", 1)).join(places, "a").select("one", "n", "words", "places").collect()  # as many as pairs of one or two characters that occur
    return Channel({tuple(r["one"].split("\t")): min(0.5, max(1, r["n"]) / max(1, r["places"])) for r in rows})


def replacements(pairs: DataFrame, ranker: Boosted, channel: Channel) -> DataFrame:
    """(seen, right): the best candidate of each query, where the ranker prefers it to none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seen, word, n_seen, n_word, cap_seen, cap_word = (c.to_pylist() for c in batch.columns)
                score = ranker.score(np.array([features(*f, channel) for f in zip(seen, n_seen, word, n_word, cap_seen, cap_word)], float))
                made = np.array([all(e in channel.rates for e in edits(w, s)) for s, w in zip(seen, word)])  # an edit that was never learned has no rate
                good = np.flatnonzero((score > ranker.least) & made)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good)), batch.column(1).take(pa.array(good)), pa.array(score[good])], ["seen", "right", "score"])

    scored = pairs.select(*PAIR).mapInArrow(run, "seen string, right string, score double")
    best = cut(scored.groupBy("seen").agg(F.max_by("right", F.struct("score", "right")).alias("right")))
    # a replacement may itself be a frequent misreading
    onward = best.select(F.col("seen").alias("right"), F.col("right").alias("onward"))
    return best.join(onward, "right", "left").select("seen", F.coalesce("onward", "right").alias("right"))


def join_classifier(words: list[tuple[str, int]]) -> np.ndarray:
    """Weights of the classifier of two line ends: whether the word keeps its hyphen, from the log counts of both forms
    and of the two halves. It is fitted on dictionary words cut at random and on hyphenated ones cut at the hyphen.
    """
    known = dict(words)
    rng, x, y = np.random.default_rng(4), [], []
    for w, n in words:
        at = w.find("-", 2) if "-" in w else int(rng.integers(2, max(3, len(w) - 1)))
        if 1 < at < len(w) - 1:
            a, b = (w[:at], w[at + 1 :]) if "-" in w else (w[:at], w[at:])
            seen = n if rng.random() < 0.8 else 0  # the form itself may be missing from the dictionary
            x.append([np.log1p(0 if "-" in w else seen), np.log1p(seen if "-" in w else 0), np.log1p(min(known.get(a, 0), known.get(b, 0))), 1])
            y.append("-" in w)
    w8 = np.array([-2.0, 2.0, 0.3, -1.0])
    if x and 0 < sum(y) < len(y):
        xs, ys = np.array(x, float), np.array(y, float)
        for _ in range(600):
            w8 += xs.T @ (ys - 1 / (1 + np.exp(-np.clip(xs @ w8, -30, 30)))) / len(xs) * 0.3
    return w8


def is_number(raw: Column) -> Column:
    """Whether a token is a number or was one: at least half of it are digits."""
    return F.length(F.regexp_replace(raw, "[^0-9]", "")) * 2 >= F.length(F.regexp_replace(raw, "[.,/%+-]", ""))


def read_by_digit(raw: Column, channel: Channel) -> Column:
    """The number that a token stands for, character by character; null if it is not one with wrongly read digits."""
    seen, digits = channel.digit_map()
    out = F.translate(raw, seen, digits)
    count = lambda pattern: F.length(F.regexp_replace(raw, pattern, ""))
    n_digits, n_other = count("[^0-9]"), count("[0-9.,/]")
    sure = (n_digits > n_other) | ((n_digits == n_other) & out.rlike("^[0-9]{2,4}$")) | raw.contains(",")
    return F.when(raw.rlike("[0-9]") & (n_other > 0) & out.rlike("^[0-9]+([.,/][0-9]+)*$") & sure, out)


def noise(pages: DataFrame, running: Running | None = None, rank: bool = True, size: int = BLOCK) -> DataFrame:
    """(markdown_path, line_no, kind, word, raw): all noise; ``raw`` is what stands in the text for a misread word.

    A number is read digit by digit by the learned rates; anything else takes the candidate that the ranker chooses.
    ``running`` is a fitted classifier of lines, fitted here if none is given; without ``rank`` no candidate is accepted.
    """
    rows = cut(rows_of(pages, running, size))
    marks = rows.where("kind IN ('header', 'page_number')").select("markdown_path", "line_no", "kind", "word", "raw")
    key = F.when(is_number(F.col("raw")), F.coalesce("other", "raw")).otherwise(F.coalesce("other", "word"))
    words = rows.where("kind = 'token'").select("markdown_path", "line_no", key.alias("seen"), F.coalesce("other", "raw").alias("raw"))
    capital = F.avg(F.col("raw").rlike("^\\p{Lu}").cast("double"))
    counts = cut(words.groupBy("seen").agg(F.count("*").alias("n"), capital.alias("cap")).select(F.col("seen").alias("word"), "n", "cap"))
    known = counts.where((F.col("n") >= KNOWN) & F.col("word").rlike("^(\\p{L}[\\p{L}'’-]*|[0-9]+([.,/][0-9]+)*)$"))
    plain = known.where("word RLIKE '^\\\\p{L}'")
    sample = [(r["word"], r["n"], r["cap"]) for r in plain.orderBy(F.desc("n"), "word").limit(WORDS).collect()]

    broken = rows.where("kind = 'hyphen'").select("markdown_path", "line_no", F.col("word").alias("a"), F.col("other").alias("b"))
    forms = broken.select(F.concat("a", "b").alias("solid")).distinct()
    # a right number is not looked up: any number may stand in a report
    queries = counts.where((F.length("word") >= 3) & ~F.col("word").rlike("^[0-9.,/%+-]*$"))
    unknown = forms.select(F.col("solid").alias("word")).join(counts.select("word"), "word", "left_anti").withColumns({"n": F.lit(0).cast("bigint"), "cap": F.lit(0.0)})
    pairs = cut(explained(candidates(known.where("length(word) >= 2"), queries.union(unknown))))
    channel = learned(pairs, counts)
    ranker, keep_hyphen = train_ranker(sample, channel) if rank else Boosted(0), join_classifier([(w, n) for w, n, _ in sample])
    right = cut(replacements(pairs, ranker, channel))
    by_digit = read_by_digit(F.col("raw"), channel)
    met = words.where("seen RLIKE '[^0-9.,/%+-]'").join(right, "seen", "left").withColumn("right", F.coalesce(by_digit, "right"))
    misread = met.where("right IS NOT NULL AND right <> seen").select("markdown_path", "line_no", F.lit("misread").alias("kind"), F.col("right").alias("word"), "raw")

    n = lambda c: F.log1p(F.coalesce(F.col(c), F.lit(0)))
    of = lambda key, name: counts.select(F.col("word").alias(key), F.col("n").alias(name))
    known = broken.withColumn("solid", F.concat("a", "b")).withColumn("parted", F.concat_ws("-", "a", "b"))
    for key, name in (("solid", "n_solid"), ("parted", "n_parted"), ("a", "n_a"), ("b", "n_b")):
        known = known.join(of(key, name), key, "left")
    w = [F.lit(float(v)) for v in keep_hyphen]
    score = w[0] * n("n_solid") + w[1] * n("n_parted") + w[2] * F.least(n("n_a"), n("n_b")) + w[3]
    chosen = known.withColumn("form", F.when(score > 0, F.col("parted")).otherwise(F.col("solid")))
    mended = chosen.join(right.select(F.col("seen").alias("form"), "right"), "form", "left")
    hyphens = mended.select("markdown_path", "line_no", F.lit("hyphen").alias("kind"), F.coalesce("right", "form").alias("word"), F.concat_ws(" ", "a", "b").alias("raw"))
    return marks.union(hyphens).union(misread)


def paragraphs(pages: DataFrame) -> DataFrame:
    """(markdown_path, line_no, text): the repaired paragraphs, at the line where each starts.

    Furniture is dropped, broken words are joined, misread ones replaced; a paragraph goes on over a page break unless
    its last line ends a sentence. One that is longer than the pages around a block is cut there.
    """
    found = noise(pages).groupBy("markdown_path", "line_no").agg(F.collect_list(F.struct("kind", "word", "raw")).alias("marks"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        path, block = left["markdown_path"].iloc[0], int(left["block"].iloc[0])
        return pd.DataFrame(mend(left, right, block), columns=["line_no", "text"]).assign(markdown_path=path)[["markdown_path", "line_no", "text"]]

    blocks = scanned_blocks(pages).withColumn("lines", F.size(F.split("page_text", "\n")))
    lines = blocks.select("markdown_path", "block", F.explode(F.sequence(F.col("first_line"), F.col("first_line") + F.col("lines") - 1)).alias("line_no"))
    marked = lines.distinct().join(found, ["markdown_path", "line_no"]).select(F.col("markdown_path").alias("path"), F.col("block").alias("part"), "line_no", "marks")
    a, b = blocks.groupBy("markdown_path", "block"), marked.groupBy("path", "part")
    return a.cogroup(b).applyInPandas(run, "markdown_path string, line_no int, text string")


def mend(pages: pd.DataFrame, found: pd.DataFrame, block: int) -> list[tuple[int, str]]:
    """(line, text) of the paragraphs that start on the pages of a block."""
    pages = pages.drop_duplicates(["page_no", "first_line"]).sort_values(["first_line", "page_no"])
    marks = dict(zip(found["line_no"], found["marks"]))
    out, start, parts, own, gap, glue = [], 0, [], False, False, None

    def close() -> None:
        if parts and own:
            out.append((start, " ".join(parts)))
        parts.clear()

    for no, first, text in zip(pages["page_no"], pages["first_line"], pages["page_text"]):
        for k, line in enumerate(text.split("\n")):
            here = marks.get(first + k)
            here = [] if here is None else list(here)
            if any(m["kind"] in ("header", "page_number") for m in here):
                continue
            if not line.strip():
                gap = True
                continue
            tokens = line.split()
            if glue is not None:
                tokens = tokens[1:]
            for m in here:
                if m["kind"] == "misread":
                    tokens = [t.replace(m["raw"], m["word"]) if m["raw"].lower() in t.lower() and t.strip(ENDS).lower() == m["raw"].strip(ENDS).lower() else t for t in tokens]
            ends = bool(parts) and parts[-1].rstrip().endswith((".", "!", "?", ":"))
            if line.startswith("#") or (gap and ends) or (parts and parts[-1].startswith("#")):
                close()
            if not parts:
                start, own = first + k, int(no) // BLOCK == block
            gap, glue = False, None
            for m in here:
                if m["kind"] == "hyphen" and tokens:
                    tokens[-1] = m["word"]
                    glue = m["word"]
            if tokens:
                parts.append(" ".join(tokens))
    close()
    return out
