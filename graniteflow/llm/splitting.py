"""Problem 2: texts above a size limit into overlapping pieces cut at natural boundaries.

Method: lexical-cohesion segmentation. The stretches between natural boundaries are the units; the cosine of the word
counts of the units before and after a boundary is its cohesion, and the depth of a valley is how far both flanks rise
above it. The cut goes to the deepest valley in the window of sizes allowed, then the overlap is put in front of the
next piece.

Natural boundaries are line breaks and ends of sentences: ``.``, ``!`` or ``?`` before white space or the end of the
line, and any full-width one. A stretch that is longer than the limit after trimming has none inside and is cut by force,
at white space if there is any in the last tenth of the room, else at the limit.

Defined results: null, empty and short texts (up to the limit) give no row; a long text of white space has no piece, but its row
in ``forced_lines``, with 0; pieces end without white space and start
without it but for the overlap, and one of white space only is not given; where a stretch and the overlap together exceed the limit, the overlap is
shortened, never the stretch; a null start line gives null lines; repeated rows are each split. The work is linear in
the text, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP, FLANK = 500, 50, 3
BOUNDARY = re.compile(r"\n|[.!?](?=\s|$)|[。！？]", re.M)
WORD = re.compile(r"\w+")
SCHEMA = "id string, piece_no int, text string, start_line int, end_line int, n_chars int, forced boolean, forced_line int"


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches between neighbouring boundaries without white space at their ends; no empty ones."""
    out, at = [], 0
    for end in [m.end() for m in BOUNDARY.finditer(text)] + [len(text)]:
        raw = text[at:end]
        body = raw.strip()
        if body:
            start = at + len(raw) - len(raw.lstrip())
            out.append((start, start + len(body)))
        at = end
    return out


def depths(text: str, spans: list[tuple[int, int]], flank: int = FLANK) -> list[float]:
    """Depth of the valley at the end of each unit but the last."""
    counts = [Counter(WORD.findall(text[a:b].lower())) for a, b in spans]
    n, cohesion = len(counts), []
    for g in range(1, n):
        left, right = Counter(), Counter()
        for c in counts[max(0, g - flank) : g]:
            left.update(c)
        for c in counts[g : g + flank]:
            right.update(c)
        dot = sum(k * right[w] for w, k in left.items() if w in right)
        norm = sum(k * k for k in left.values()) * sum(k * k for k in right.values())
        cohesion.append(dot / norm**0.5 if norm else 0.0)
    left_peak, right_peak = [0.0] * len(cohesion), [0.0] * len(cohesion)
    for i, c in enumerate(cohesion):
        left_peak[i] = max(c, left_peak[i - 1]) if i and cohesion[i - 1] >= c else c
    for i in range(len(cohesion) - 1, -1, -1):
        c = cohesion[i]
        right_peak[i] = max(c, right_peak[i + 1]) if i + 1 < len(cohesion) and cohesion[i + 1] >= c else c
    return [a + b - 2 * c for a, b, c in zip(left_peak, right_peak, cohesion)]


def forced_cuts(text: str, start: int, end: int, limit: int, overlap: int, opens: bool) -> list[tuple[int, int]]:
    """(start, end) of the parts of a stretch without boundaries; each leaves room for the overlap, unless it opens the text."""
    out, at = [], start
    while at < end:
        room = limit if at == start and opens else limit - overlap
        if end - at <= room:
            stop = end
        else:
            stop = at + room
            for k in range(stop, stop - room // 10, -1):
                if text[k].isspace():
                    stop = k
                    break
        body = text[at:stop].strip()
        if body:
            first = at + (stop - at) - len(text[at:stop].lstrip())
            out.append((first, first + len(body)))
        at = stop
    return out


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[list[tuple[int, int, bool]], int]:
    """(start, end, whether its end was forced) of all pieces, and the place of the first stretch above the limit or -1."""
    spans = units(text)
    valley = [*depths(text, spans), 0.0]
    parts, first_forced = [], -1  # (start, end, depth at its end, forced)
    for (a, b), depth in zip(spans, valley):
        if b - a <= limit:
            parts.append((a, b, depth, False))
            continue
        first_forced = a if first_forced < 0 else first_forced
        own = forced_cuts(text, a, b, limit, overlap, not parts)
        parts += [(x, y, depth if y == b else -1.0, y != b) for x, y in own]
    out, i = [], 0
    while i < len(parts):
        begin = parts[i][0]
        if out:
            begin = max(out[-1][1] - overlap, parts[i][1] - limit)
            begin = min(max(begin, out[-1][0] + 1, 0), parts[i][0])
        last = i
        while last + 1 < len(parts) and parts[last + 1][1] - begin <= limit:
            last += 1
        cut = last
        if last + 1 < len(parts):  # the deepest valley in the upper half of the window, a later one on a tie
            half = begin + limit // 2
            window = [k for k in range(i, last + 1) if parts[k][1] >= half] or [last]
            cut = max(window, key=lambda k: (parts[k][2], k))
        out.append((begin, parts[cut][1], parts[cut][3]))
        i = cut + 1
    return out, first_forced


def forced_lines(texts: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id, forced_line): one row for every text (id, text, start_line) above ``limit`` characters, whatever pieces it has.

    0 where no cut is forced, null where one is and the start line is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for text, line in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                _, place = split_text(text, limit, overlap)
                lines.append(0 if place < 0 else None if line is None else line + text.count("\n", 0, place))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int32())], ["id", "forced_line"])

    return texts.where(F.length("text") > limit).select("id", "text", "start_line").mapInArrow(run, "id string, forced_line int")


def split_column(texts: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """All pieces of the texts (id, text, start_line) above ``limit`` characters (code points)."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, line in zip(*(c.to_pylist() for c in batch.columns)):
                pieces, place = split_text(text, limit, overlap)
                forced = 0 if place < 0 else None if line is None else line + text.count("\n", 0, place)
                done, seen = 0, 0
                for k, (a, b, hard) in enumerate(pieces):
                    seen += text.count("\n", done, a)
                    done = a
                    own = text[a:b]
                    ends = None if line is None else line + seen + own.count("\n")
                    rows.append((i, k, own, None if line is None else line + seen, ends, b - a, hard, forced))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return texts.where(F.length("text") > limit).select("id", "text", "start_line").mapInArrow(run, SCHEMA)
