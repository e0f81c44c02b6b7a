"""Problem 1: groups of texts that are near copies of each other.

A text stands for the set of its words. Two sets A, B with a shared part of at least t of their union differ in at
most (1 - t) / (1 + t) * (|A| + |B|) words, and a bit fingerprint in which every word flips one bit differs in at
most as many bits. So every pair sought lies within that Hamming radius, and no pair is lost by searching it.

Method: vantage-point trees over the fingerprints. Distances of unrelated texts all lie in a narrow band, where one
tree over everything could prune nothing; the fingerprints are therefore first sharded by bands of minimum hashes,
and a record enters every shard whose region its neighbourhood overlaps: ``bands`` shards of ``rows`` minima each.
A pair at similarity J meets in no shard with probability (1 - J**rows)**bands: under 0.3 % at J = 0.7, under
0.0001 % at 0.8. Inside a shard a vantage-point tree finds the pairs within the radius, pruned by the triangle
bound, and the exact word sets decide at the end. Every shard is searched by a tree, from two members on: its first member
is the vantage point, and members meet only where no vantage point above them parts them by more than the radius.

Scale: equal word sets are one class and only classes are searched, so copies cost nothing; a shard above ``hot``
members is known from a sample of the classes before anything is shuffled and split into blocks, one task for each pair of
blocks, and none is dropped; one that the sample missed comes back from its search and is split then. Partitions hold
fixed-width rows. The copies of a class are paired in blocks of ``copies`` members.
Unrelated texts meet in a shard with a probability that ``rows`` fixes (about 1e-3 here for 32 shards of 5), so the comparisons of a
record grow with the collection, if slowly; ``rows`` and ``bands`` can be raised together (8 and 98 keep the same recall).

Defined results: texts with fewer than ``min_words`` words, null and empty texts and rows without id are in no pair; repeated rows of an
id were resolved before; equal texts of different ids are pairs. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.llm.fixed import column_of, rows_of
from graniteflow.session import broadcast_if_small, cut

WORD = re.compile("[a-z0-9]+")
ANY_WORD = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|[^\W_\u3040-\u30ff\u3400-\u9fff]+")
SHARE, MIN_WORDS = (7, 10), 50
BANDS, ROWS, BITS, HOT, LEAF = 32, 5, 192, 4096, 4
SAMPLED, COPIES = 64, 1000
LANES, BYTES = BITS // 64, 6
KEPT = (1 << 8 * BYTES) - 1
WORD_MEMORY = 60_000


def radius(sizes_a: np.ndarray, sizes_b: np.ndarray, share: tuple[int, int] = SHARE) -> np.ndarray:
    """The most words in which two sets of these sizes may differ if ``share`` of all their words is in both."""
    num, den = share
    return ((den - num) * (sizes_a + sizes_b)) // (den + num)


def distances(fps: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (n x LANES) to others, row by row or to one."""
    return np.bitwise_count(fps ^ one).sum(axis=1, dtype=np.int32)


class Sketcher:
    """Fingerprints and band keys of word sets; ``seed`` fixes the hash functions."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.mul = (rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.mix = (rng.integers(1, 1 << 63, rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.salt = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word under every hash function (words x functions), the upper half of a multiplied hash."""
        x = (hashes * np.uint64(0x9E3779B97F4A7C15))[:, None] * self.mul + self.add
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)

    def fingerprints(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Parity fingerprints of the sets flat[starts[i]:starts[i + 1]]."""
        bit = (flat >> np.uint64(17)) % np.uint64(BITS)
        one_hot = np.zeros((len(flat), LANES), np.uint64)
        one_hot[np.arange(len(flat)), (bit // np.uint64(64)).astype(np.int64)] = np.uint64(1) << (bit % np.uint64(64))
        return np.bitwise_xor.reduceat(one_hot, starts[:-1], axis=0)

    def keys(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Band keys (sets x bands)."""
        low = np.empty((len(starts) - 1, self.bands * self.rows), np.uint32)
        words, place = np.unique(flat, return_inverse=True)
        table = self.ranks(words)
        for i in range(len(starts) - 1):
            np.min(table[place[starts[i] : starts[i + 1]]], axis=0, out=low[i])
        grouped = low.reshape(-1, self.bands, self.rows).astype(np.uint64)
        key = (grouped * self.mix).sum(axis=2, dtype=np.uint64) + self.salt
        return (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def packed(hashes: list[int]) -> bytes:
    """Sorted word hashes in BYTES bytes each: the lower ones, of which the words of a collection share none by chance."""
    return np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """Word hashes out of their packed form."""
    out = np.zeros((len(data) // BYTES, 8), np.uint8)
    out[:, :BYTES] = np.frombuffer(data, np.uint8).reshape(-1, BYTES)
    return out.reshape(-1).view(np.uint64)


def tree_pairs(fps: np.ndarray, sizes: np.ndarray, count: Counter | None = None, share: tuple[int, int] = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs within their radius in one shard, by a vantage-point tree.

    A node takes its first member as vantage point and splits the others at their median distance. Two members can
    only be a pair if their distances to a vantage point differ by at most the radius. So of two that lie on different
    sides only those in the strips beside the boundary meet, and in a leaf, which keeps the distances to the vantage
    points above it, only those meet whom none of these bounds parts. ``count`` is given the pairs "met" and "pruned".
    """
    out_i, out_j = [], []

    def close(a: np.ndarray, b: np.ndarray, bounds: np.ndarray) -> None:
        most = radius(sizes[a], sizes[b], share)
        fit = np.ones(len(a), bool)
        for d in bounds:
            fit &= np.abs(d[a] - d[b]) <= most
        if count is not None:
            count.update(met=int(fit.sum()), pruned=int((~fit).sum()))
        a, b, most = a[fit], b[fit], most[fit]
        near = distances(fps[a], fps[b]) <= most
        out_i.append(a[near])
        out_j.append(b[near])

    todo = [(np.arange(len(fps)), ())]  # members, and for every vantage point above them the distances to it by place
    while todo:
        own, above = todo.pop()
        if len(own) <= LEAF:
            i, j = np.triu_indices(len(own), 1)
            close(own[i], own[j], above)
            continue
        vantage, rest = own[0], own[1:]
        d = np.zeros(len(fps), np.int32)
        d[rest] = distances(fps[rest], fps[vantage])
        close(np.full(len(rest), vantage), rest, above)
        rest = rest[np.argsort(d[rest], kind="stable")]
        middle = len(rest) // 2
        inner, outer = rest[:middle], rest[middle:]
        most = int(radius(sizes[rest].max(), sizes[rest].max(), share))
        until = np.searchsorted(d[outer], d[inner] + most, "right")
        if count is not None:
            count.update(pruned=int(len(inner) * len(outer) - until.sum()))
        for k in range(np.searchsorted(until, 1), middle):
            close(np.full(until[k], inner[k]), outer[: until[k]], (*above, d))
        todo += [(inner, (*above, d)), (outer, (*above, d))]
    return np.concatenate(out_i), np.concatenate(out_j)


def shard_pairs(key: np.ndarray, cls: np.ndarray, sizes: np.ndarray, fps: np.ndarray, hot: int, count: Counter | None = None, share: tuple[int, int] = SHARE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of classes over all shards of one partition, and the places of the members of hot shards.

    The root of every shard's tree is worked on for all shards together: its first member is the vantage point. Of shards
    up to LEAF + 1 members the rest is one leaf; these are searched together as well, by shifts of the sorted rows, under
    the bound of the vantage point. Larger ones go on as trees.
    """
    order = np.lexsort((cls, key))
    key, cls, sizes, fps = key[order], cls[order], sizes[order], fps[order]
    bounds = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    length = np.diff(bounds)
    small = np.repeat((length > 1) & (length <= LEAF + 1), length)
    left, right, held = [], [], []
    where = np.flatnonzero(small)
    vantage = np.repeat(bounds[:-1], length)[where]
    d = distances(fps[where], fps[vantage])
    near = (d <= radius(sizes[where], sizes[vantage], share)) & (where != vantage)
    left.append(cls[vantage[near]])
    right.append(cls[where[near]])
    if count is not None:
        count.update(met=int((where != vantage).sum()), shards=int((length > 1).sum()), trees=int((length > LEAF + 1).sum()))
    rest = where != vantage
    where, d = where[rest], d[rest]
    s_key, s = key[where], 1
    while len(where) > s:
        i = np.flatnonzero(s_key[s:] == s_key[:-s])
        if not len(i):
            break
        most = radius(sizes[where[i]], sizes[where[i + s]], share)
        fit = np.abs(d[i] - d[i + s]) <= most
        if count is not None:
            count.update(met=int(fit.sum()), pruned=int((~fit).sum()))
        a, b = where[i[fit]], where[i[fit] + s]
        near = distances(fps[a], fps[b]) <= most[fit]
        left.append(cls[a[near]])
        right.append(cls[b[near]])
        s += 1
    for g in np.flatnonzero(length > LEAF + 1):
        at = slice(bounds[g], bounds[g + 1])
        if length[g] > hot:
            held.append(order[at])
            continue
        i, j = tree_pairs(fps[at], sizes[at], count, share)
        left.append(cls[at][i])
        right.append(cls[at][j])
    none = np.zeros(0, np.int64)
    a, b = np.concatenate([none, *left]), np.concatenate([none, *right])
    pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    pair = pair[pair[:, 0] != pair[:, 1]]
    return pair[:, 0], pair[:, 1], np.concatenate([none, *held])


def gather(batches: Iterator[pa.RecordBatch], columns: int) -> list[pa.ChunkedArray] | None:
    """The columns of all batches of a partition."""
    rows = [b for b in batches if b.num_rows]
    return [pa.chunked_array([b.column(k) for b in rows]).combine_chunks() for k in range(columns)] if rows else None


MIX = np.random.default_rng(12).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct 48-bit hashes of the runs of ``size`` words, out of the hashes of the words in order; sorted."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    last = len(words) - size + 1
    h = np.zeros(last, np.uint64)
    for k in range(size):
        h += words[k : k + last] * MIX[k]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((h ^ (h >> np.uint64(32))) & np.uint64(KEPT))


def word_sets(texts: DataFrame, min_words: int = MIN_WORDS, size: int = 1) -> DataFrame:
    """(id, cls, words) of the texts (id, text) with enough words, or runs of ``size`` words; these are sorted 48-bit hashes, cls their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, int] = {}
        digest, find = xxhash.xxh3_64_intdigest, WORD.findall
        for batch in batches:
            ids, cls, sets = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(memory) > WORD_MEMORY:
                    memory.clear()
                words = (set(find(text.lower())) if size == 1 else ANY_WORD.findall(text.lower())) if text else ()
                hashes = [memory.get(w) or memory.setdefault(w, digest(w) & KEPT) for w in words] if len(words) >= min_words else ()
                if size > 1:
                    hashes = runs(np.array(hashes, np.uint64), size)
                if len(hashes) < min_words:
                    continue
                data = packed(sorted(hashes) if size == 1 else hashes)
                ids.append(i)
                sets.append(data)
                cls.append(xxhash.xxh3_64_intdigest(data) - (1 << 63))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], ["id", "cls", "words"])

    return texts.where("id IS NOT NULL").select("id", "text").mapInArrow(run, "id string, cls bigint, words binary")


def banded(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, cls, n, fp): a row for every shard that a class enters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(bands, rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                raw = part.column(1).to_pylist()
                sizes = np.fromiter((len(x) // BYTES for x in raw), np.int32, len(raw))
                starts = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
                flat = unpacked(b"".join(raw))
                fps, keys = sketch.fingerprints(flat, starts), sketch.keys(flat, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.reshape(-1).view(np.int64)),
                        pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), bands)),
                        pa.array(np.repeat(sizes, bands)),
                        column_of(np.repeat(fps, bands, axis=0)),
                    ],
                    ["key", "cls", "n", "fp"],
                )

    return classes.select("cls", "words").mapInArrow(run, "key bigint, cls bigint, n int, fp binary")


def search(rows: DataFrame, hot: int, share: tuple[int, int] = SHARE) -> DataFrame:
    """Pairs within the radius, shard by shard: (a, b, null, ...); members of hot shards come back as (null, null, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = gather(batches, 4)
        if got is None:
            return
        key, cls, n = (c.to_numpy(zero_copy_only=False) for c in got[:3])
        a, b, held = shard_pairs(key, cls, n, rows_of(got[3], np.uint64, LANES), hot, None, share)
        for k in range(0, len(a), 50_000):
            x, y = pa.array(a[k : k + 50_000]), pa.array(b[k : k + 50_000])
            yield pa.RecordBatch.from_arrays([x, y, pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.int32()), pa.nulls(len(x), pa.binary())], ["a", "b", "key", "cls", "n", "fp"])
        for k in range(0, len(held), 50_000):
            at = pa.array(held[k : k + 50_000])
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *(c.take(at) for c in got)], ["a", "b", "key", "cls", "n", "fp"])

    return rows.mapInArrow(run, "a bigint, b bigint, key bigint, cls bigint, n int, fp binary")


def in_blocks(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (key, cls, n, fp) with those of hot shards, counts (key, blocks), once for every two blocks that meet there.

    Members of equal hash fall into one block; every two blocks meet under one key, each block with itself as well. So no
    task sees more of a hot shard than two blocks. Rows of other shards keep their key.
    """
    placed = rows.join(counts, "key", "left").withColumn("own", F.pmod(F.xxhash64("cls", F.lit(11)), F.coalesce("blocks", F.lit(1))).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    paired = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return met.select(F.when(F.col("blocks").isNull(), F.col("key")).otherwise(paired).alias("key"), "cls", "n", "fp")


def hot_shards(sampled: DataFrame, hot: int) -> DataFrame:
    """(key, blocks) of the shards that the rows of one class in SAMPLED show to be above ``hot`` members.

    What a sample misses is found when the shard is searched and comes back from there (``search``).
    """
    counts = sampled.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * SAMPLED > hot)
    return counts.select("key", F.ceil(F.col("n") * SAMPLED / (hot / 4)).cast("int").alias("blocks"))


def sample_of(classes: DataFrame) -> DataFrame:
    """One class in SAMPLED."""
    return classes.where(F.pmod(F.xxhash64("cls", F.lit(23)), F.lit(SAMPLED)) == 0)


def hot_pairs(held: DataFrame, hot: int, share: tuple[int, int] = SHARE) -> DataFrame:
    """Pairs of shards that were met as too large for one task: blocks of about hot / 2 members, a task for two blocks."""
    counts = held.groupBy("key").agg(F.ceil(F.count("*") / (hot / 2)).cast("int").alias("blocks"))
    return search(in_blocks(held, counts).repartition("key"), 1 << 30, share).select("a", "b")


def exact(pairs: DataFrame, classes: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """The candidate pairs (a, b) whose word sets share enough, with the two sizes and the shared number."""
    pairs = pairs.distinct()
    # only the word sets of classes that are in a pair move
    met_at_all = cut(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct())
    wanted = classes.join(broadcast_if_small(met_at_all), "cls", "left_semi")
    left = wanted.select(F.col("cls").alias("a"), F.col("words").alias("words_a"))
    right = wanted.select(F.col("cls").alias("b"), F.col("words").alias("words_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            keep, shared = [], []
            for k in range(len(a)):
                u, v = unpacked(x[k]), unpacked(y[k])
                both = len(np.intersect1d(u, v, assume_unique=True))
                if share[1] * both >= share[0] * (len(u) + len(v) - both):
                    keep.append(k)
                    shared.append(both / (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[k] for k in keep], pa.int64()), pa.array([b[k] for k in keep], pa.int64()), pa.array(shared, pa.float64())],
                ["a", "b", "similarity"],
            )

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "words_a", "words_b")
    return met.mapInArrow(run, "a bigint, b bigint, similarity double")


def candidate_pairs(sharded: DataFrame, sampled: DataFrame, hot: int, share: tuple[int, int] = SHARE) -> DataFrame:
    """Pairs (a, b) of classes within the radius out of the rows of all shards, and of a sample of them."""
    known = cut(hot_shards(sampled, hot))
    if not known.isEmpty():
        sharded = in_blocks(sharded, known)
    found = cut(search(sharded.repartition("key"), hot, share))
    plain = found.where("a IS NOT NULL").select("a", "b")
    held = found.where("key IS NOT NULL").select("key", "cls", "n", "fp")
    return plain if held.isEmpty() else plain.union(hot_pairs(held, hot, share))


def class_pairs(classes: DataFrame, bands: int = BANDS, rows: int = ROWS, hot: int = HOT, share: tuple[int, int] = SHARE) -> DataFrame:
    """Near-copy pairs (a < b, similarity) of the classes (cls, words)."""
    return exact(candidate_pairs(banded(classes, bands, rows), banded(sample_of(classes), bands, rows), hot, share), classes, share)


def sketches(sets: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, cls, n, fp, keys) of word sets (id, cls, words): what a search needs of them, without the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(bands, rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                raw = part.column(2).to_pylist()
                sizes = np.fromiter((len(x) // BYTES for x in raw), np.int32, len(raw))
                starts = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
                flat = unpacked(b"".join(raw))
                fps, keys = sketch.fingerprints(flat, starts), sketch.keys(flat, starts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), column_of(fps), column_of(keys)], ["id", "cls", "n", "fp", "keys"])

    return sets.select("id", "cls", "words").mapInArrow(run, "id string, cls bigint, n int, fp binary, keys binary")


def unfolded(classes: DataFrame, bands: int) -> DataFrame:
    """(key, cls, n, fp): a row for every shard of classes (cls, n, fp, keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, fps = rows_of(batch.column(3), np.uint64, bands), rows_of(batch.column(2), np.uint64, LANES)
                cls, n = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), bands) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(cls), pa.array(n), column_of(np.repeat(fps, bands, axis=0))], ["key", "cls", "n", "fp"])

    return classes.select("cls", "n", "fp", "keys").mapInArrow(run, "key bigint, cls bigint, n int, fp binary")


def spread(members: DataFrame, copies: int = COPIES) -> tuple[DataFrame, DataFrame]:
    """The members (cls, id) with the block of their class that holds them, and (cls, blocks) of the classes with several."""
    large = members.groupBy("cls").agg(F.ceil(F.count("*") / copies).cast("int").alias("blocks")).where("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = members.join(large, "cls", "left").select("cls", "id", F.pmod(F.xxhash64("id", F.lit(31)), blocks).cast("int").alias("block"))
    return placed, large


def expanded(pairs: DataFrame, column: str, placed: DataFrame, large: DataFrame, name: str) -> DataFrame:
    """Pairs with every member of the class in ``column`` under ``name``; a class of many copies is met block by block."""
    of = pairs.join(large.withColumnRenamed("cls", column), column, "left")
    each = of.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
    return each.join(placed.select(F.col("cls").alias(column), "block", F.col("id").alias(name)), [column, "block"]).drop("block")


def near_copies(texts: DataFrame, min_words: int = MIN_WORDS, bands: int = BANDS, rows: int = ROWS, hot: int = HOT, copies: int = COPIES) -> DataFrame:
    """(id_a, id_b) of all near copies among the texts (id, text), id_a < id_b, each pair once."""
    members = cut(word_sets(texts, min_words))
    classes = cut(members.groupBy("cls").agg(F.first("words").alias("words"), F.count("*").alias("copies")))
    placed, large = spread(members.select("cls", "id"), copies)
    pairs = class_pairs(classes.select("cls", "words"), bands, rows, hot).select("a", "b")
    same = classes.where("copies > 1").select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    met = expanded(expanded(pairs.union(same), "a", placed, large, "x"), "b", placed, large, "y")
    return met.where("a <> b OR x < y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def groups(texts: DataFrame, min_words: int = MIN_WORDS, size: int = 1, share: tuple[int, int] = SHARE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, group_id, links): each text with the smallest id of its group of linked near copies and its number of links.

    Groups are the connected parts of the pairs between classes, found by repeatedly taking the smallest label of
    all neighbours and then the label of that label, so the rounds grow with the logarithm of a part's width. Word sets are
    not kept: a search needs their sketches, and the decision those of texts that it has brought together.
    """
    members = cut(sketches(word_sets(texts, min_words, size), bands, rows))
    same = (F.first(c).alias(c) for c in ("n", "fp", "keys"))
    classes = cut(members.groupBy("cls").agg(*same, F.min("id").alias("low"), F.count("*").alias("copies")))
    near = cut(candidate_pairs(unfolded(classes, bands), unfolded(sample_of(classes), bands), HOT, share).distinct())
    # words are made again, and only of texts that may be near copies
    met = near.select(F.col("a").alias("cls")).union(near.select("b")).distinct()
    wanted = cut(classes.join(met, "cls", "left_semi").select(F.col("low").alias("id")))
    again = texts.join(broadcast_if_small(wanted), "id", "left_semi")
    pairs = cut(exact(near, word_sets(again, min_words, size).groupBy("cls").agg(F.first("words").alias("words")), share))
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = both.join(classes.select(F.col("cls").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("outside"))
    label = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("cls"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(label.withColumnRenamed("cls", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = label.join(near, label["cls"] == near["a"]).select("cls", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("cls").alias("label"), F.col("label").alias("far"))
        new = cut(step.join(jump, "label").select("cls", "old", F.least("label", "far").alias("label")))
        if new.where("label <> old").isEmpty():
            break
        label = new.select("cls", "label")
    named = label.join(classes.select("cls", "low"), "cls").groupBy("label").agg(F.min("low").alias("group_id"))
    part = label.join(named, "label").select("cls", "group_id")
    out = members.select("cls", "id").join(classes.select("cls", "low", "copies"), "cls").join(part, "cls", "left").join(links, F.col("cls") == F.col("a"), "left")
    total = F.coalesce("outside", F.lit(0)) + F.col("copies") - 1
    return out.select("id", F.coalesce("group_id", "low").alias("group_id"), total.cast("bigint").alias("links"))
