"""Problem 6: token ids of whole texts by a byte-level pair-merge vocabulary.

Method: a segment tree over the ranks of adjacent pairs. Its root names the leftmost pair of lowest rank;
a merge changes at most three leaves, each repaired along one path to the root.

Defined results: null text and empty text both give an empty list. Text of blanks only has the ids of its blanks.
Repeated rows are encoded each on its own. Vocabularies are read from a path and never copied.
"""

from __future__ import annotations

import base64
import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BYTE_BPE_50K = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"

# White space is spelled out: the shorthand of Python also holds four control characters that the vocabulary's splitter does not.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
ASCII_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
CACHE_WORDS = 400_000


class PairMerger:
    """Encodes one word (the splitter's unit) into ids."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.words: dict[str, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of ``data`` by repeatedly merging the leftmost adjacent pair of lowest rank."""
        ranks, n = self.ranks, len(data)
        if (whole := ranks.get(data)) is not None:
            return [whole]
        get, none = ranks.get, 1 << 62
        width = 1 << max(1, (n - 1).bit_length())
        tree = [none] * (2 * width)
        part = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (r := get(part[i] + part[i + 1])) is not None:
                tree[width + i] = r * width + i
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def put(i: int, value: int) -> None:
            k = width + i
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1

        while (best := tree[1]) != none:
            i = best % width
            j = after[i]
            part[i] += part[j]
            k = after[i] = after[j]
            put(j, none)
            if k < n:
                before[k] = i
                r = get(part[i] + part[k])
                put(i, none if r is None else r * width + i)
            else:
                put(i, none)
            if (h := before[i]) >= 0:
                r = get(part[h] + part[i])
                put(h, none if r is None else r * width + h)
        out, i = [], 0
        while i < n:
            out.append(ranks[part[i]])
            i = after[i]
        return out

    def learn(self, word: str) -> list[int]:
        """Ids of a word not met before; the memory of words is emptied when it is full."""
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        ids = self.merge(word.encode("utf-8", "replace"))
        if len(word) <= 64:
            self.words[word] = ids
        return ids

    def pieces(self, text: str) -> list[list[int]]:
        """The id lists of the words of ``text``, in order."""
        split = ASCII_SPLIT if text.isascii() else SPLIT
        get, learn = self.words.get, self.learn
        return [get(w) or learn(w) for w in split.findall(text)]

    def encode(self, text: str | None) -> list[int]:
        """All ids of ``text``; none for null or empty text."""
        return list(itertools.chain.from_iterable(self.pieces(text))) if text else []

    def count(self, text: str | None) -> int:
        """The number of ids of ``text``."""
        return sum(map(len, self.pieces(text))) if text else 0


@lru_cache(maxsize=4)
def merger(path: str) -> PairMerger:
    """One merger per vocabulary and Python worker."""
    return PairMerger(path)


def encode_column(df: DataFrame, id_column: str, text_column: str, path: str = BYTE_BPE_50K, step: int = 512) -> DataFrame:
    """(id, ids) of every row of ``df``: one pass without a shuffle; ``step`` rows are held as Python objects at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = [m.pieces(t) if t else [] for t in part.column(1).to_pylist()]
                flat = itertools.chain.from_iterable(itertools.chain.from_iterable(lists))
                values = np.fromiter(flat, np.int32)
                sizes = np.fromiter((sum(map(len, x)) for x in lists), np.int64, len(lists))
                offsets = np.zeros(len(lists) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    schema = T.StructType([T.StructField("doc_id", df.schema[id_column].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return df.select(id_column, text_column).mapInArrow(run, schema)
