"""Problem 5: the k most similar vectors of every vector, within groups that must not mix (the models).

Method: adaptive dimension scan. Vectors have length one and are rotated at random, then cut into column blocks; every
vector lies in the list of its nearest centre, and every vector scans the ``probes`` lists nearest to it. A scan adds
one column block at a time and abandons a candidate as soon as a hypothesis test on its partial distance says that
its distance is above the one still of interest: with d of D columns the distance is estimated as D/d times the
partial one, and it is given up where that exceeds the bound by more than (1 + EPSILON / sqrt(d)) squared.

Scale: centres come in two levels, so that a list stays small however many vectors there are. Coarse centres are fitted on
at most ``SAMPLE`` vectors. A coarse list above ``FINE`` members gets centres of its own, about one for every ``FINE / 4``
members, fitted in a task on at most ``FINE`` of them; a vector that visits such a list goes on to the finer ones nearest to
it. Every vector is indexed. Lists above ``BLOCK`` members or queries are split into blocks, each pair of which is one unit
of work, and the units are spread over as many partitions as their rows ask for. Equal vectors of a group are one class
that is searched once and offers only its k + 1 smallest ids, which are all that can be among anyone's first k, so copies
cannot heat a list, and the copies ask in blocks of ``COPIES``; a unit returns at most k + 1 rows a query.

Defined results: null, short, long, all-zero and non-finite vectors and those without a group or an id are not usable and come
out nowhere; of several rows of one id the caller passes the current one; ties of similarity go to the smaller id;
a group with fewer than k + 1 vectors gives what it has; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.llm.fixed import column_of, rows_of
from graniteflow.session import cut

DIM, K, PROBES, SAMPLE, BLOCK, COLUMNS, EPSILON, FLOOR = 64, 10, 8, 24_576, 4096, 16, 2.1, 0.85
FINE, UNIT_ROWS, COPIES, BROADCAST = 4096, 30_000, 1000, 100_000
ROTATION = np.linalg.qr(np.random.default_rng(5).standard_normal((DIM, DIM)))[0]


def usable(vector: Column) -> Column:
    """Whether an array of numbers has exactly DIM finite values that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == DIM) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(column: pa.Array) -> np.ndarray:
    """Vectors out of a binary column."""
    return rows_of(column, np.float32, DIM)


def rotated(vectors: DataFrame) -> DataFrame:
    """(id, grp, vec, cls): usable vectors at length one, rotated, with the hash of what the class is made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, DIM)
                x /= np.abs(x).max(axis=1, keepdims=True)  # sums of squares can neither vanish nor overflow
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ ROTATION
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column_of(x.astype(np.float32))], ["id", "grp", "vec"])

    plain = vectors.where(usable(F.col("embedding")) & F.col("grp").isNotNull() & F.col("id").isNotNull()).select("id", "grp", "embedding")
    return plain.mapInArrow(run, "id string, grp string, vec binary").withColumn("cls", F.xxhash64("grp", "vec"))


def centres(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; a centre that loses all its vectors stays where it was."""
    lists = max(1, min(lists, len(sample)))
    c = sample[np.random.default_rng(3).choice(len(sample), lists, replace=False)].copy() if len(sample) else np.zeros((1, DIM), np.float32)
    for _ in range(rounds if lists > 1 else 0):
        own = (sample @ c.T).argmax(axis=1)
        order = np.argsort(own, kind="stable")
        filled, first = np.unique(own[order], return_index=True)
        total = np.add.reduceat(sample[order], first, axis=0)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        c[filled] = np.where(length > 1e-6, total / np.maximum(length, 1e-6), c[filled])
    return c


def scan(members: np.ndarray, queries: np.ndarray, k: int, floor: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, member, similarity) of the k best members of every query, at least ``floor`` similar, by column blocks."""
    bound = np.full(len(queries), 4.0 if floor is None else max(2 - 2 * floor, 0) + 1e-5, np.float32)
    if floor is None and len(members) > k:
        first = 2 - 2 * queries @ members[: 16 * k].T  # the k-th of some members bounds the k-th of all
        bound = np.minimum(bound, np.partition(first, min(k, first.shape[1]) - 1, axis=1)[:, min(k, first.shape[1]) - 1] + 1e-5)
    qs, ms, ds = [], [], []
    step = max(1, (1 << 20) // max(1, len(members)))
    m_low = members[:, :COLUMNS]
    m_sq = (m_low * m_low).sum(axis=1)
    for at in range(0, len(queries), step):
        q_low = queries[at : at + step, :COLUMNS]
        part = (q_low * q_low).sum(axis=1)[:, None] + m_sq - 2 * q_low @ m_low.T
        limit = bound[at : at + step] * (COLUMNS / DIM) * (1 + EPSILON / COLUMNS**0.5) ** 2
        q, m = np.nonzero(part <= limit[:, None])
        d, q = part[q, m], q + at
        for done in range(COLUMNS, DIM, COLUMNS):
            gap = queries[q, done : done + COLUMNS] - members[m, done : done + COLUMNS]
            d = d + np.einsum("ij,ij->i", gap, gap)
            seen = done + COLUMNS
            slack = 1.0 if seen == DIM else (1 + EPSILON / seen**0.5) ** 2
            keep = d <= bound[q] * (seen / DIM) * slack
            q, m, d = q[keep], m[keep], d[keep]
        qs.append(q)
        ms.append(m)
        ds.append(d)
    q, m, d = np.concatenate(qs), np.concatenate(ms), np.concatenate(ds)
    order = np.lexsort((m, d, q))
    q, m, d = q[order], m[order], d[order]
    start = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1] if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    q, m = q[place < k], m[place < k]
    sim = np.einsum("ij,ij->i", queries[q].astype(np.float64), members[m].astype(np.float64))
    return q, m, sim


def indexed(classes: DataFrame, index: dict[str, np.ndarray], probes: int) -> DataFrame:
    """(grp, cls, vec, cells): the lists of each class, the nearest first, in which it is a member."""
    shared = classes.sparkSession.sparkContext.broadcast(index)  # at most SAMPLE centres in all

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.array(batch.column(0).to_pylist(), object)
            x, cells = vectors_of(batch.column(2)), [None] * batch.num_rows
            for g in dict.fromkeys(groups):
                c, rows = shared.value.get(g), np.flatnonzero(groups == g)
                n = 1 if c is None else min(probes, len(c))
                for at in range(0, len(rows), 2048):
                    own = rows[at : at + 2048]
                    if c is None:
                        near = np.zeros((len(own), 1), np.int32)
                    else:
                        sim = x[own] @ c.T
                        near = np.argpartition(-sim, n - 1, axis=1)[:, :n]
                        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable"), 1).astype(np.int32)
                    for r, cell in zip(own, near):
                        cells[r] = cell
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], ["grp", "cls", "vec", "cells"])

    return classes.select("grp", "cls", "vec").mapInArrow(run, "grp string, cls bigint, vec binary, cells array<int>")


def scanned(work: DataFrame, k: int, floor: float | None) -> DataFrame:
    """(grp, q, m, sim) of all units of work: rows (unit, role, grp, cls, vec) with the members and queries of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        unit, role, grp, cls, vec = (pa.chunked_array([b.column(c) for b in rows]).combine_chunks() for c in range(5))
        unit, role, cls, x = unit.to_numpy(), role.to_numpy(), cls.to_numpy(), vectors_of(vec)
        order = np.lexsort((cls, role, unit))
        bounds = np.flatnonzero(np.r_[True, unit[order][1:] != unit[order][:-1], True])
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = order[a:b]
            members, asking = own[role[own] == 0], own[role[own] == 1]
            if not len(members) or not len(asking):
                continue
            q, m, sim = scan(x[members], x[asking], k, floor)
            if len(q):
                names = pa.array([grp[int(own[0])].as_py()] * len(q), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(cls[asking[q]]), pa.array(cls[members[m]]), pa.array(sim)], ["grp", "q", "m", "sim"])

    return work.select("unit", "role", "grp", "cls", "vec").mapInArrow(run, "grp string, q bigint, m bigint, sim double")


def fine_centres(members: DataFrame, sizes: DataFrame, fine: int) -> DataFrame:
    """(grp, cell, centres): centres inside the coarse lists (grp, cell, members) that are above ``fine``, each fitted in a task.

    A list is represented by at most ``fine`` of its members, in order of a hash.
    """
    lot = Window.partitionBy("grp", "cell").orderBy(F.xxhash64("cls", F.lit(41)))
    some = members.join(sizes, ["grp", "cell"]).withColumn("rn", F.row_number().over(lot)).where(F.col("rn") <= fine)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        x = vectors_of(table["vec"].combine_chunks())
        own = centres(x, max(2, round(4 * int(table["members"][0].as_py()) / fine)))
        return pa.Table.from_arrays([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([own.astype(np.float32).tobytes()], pa.binary())], ["grp", "cell", "centres"])

    return some.select("grp", "cell", "vec", "members").groupBy("grp", "cell").applyInArrow(run, "grp string, cell int, centres binary")


def refined(visits: DataFrame, fine: DataFrame, probes: int) -> DataFrame:
    """(grp, cls, vec, cell, place) of visits in lists with finer centres: the finer lists nearest to a vector, under new numbers.

    A vector goes on to a share of the finer lists of each coarse one it visits: as many as it would probe in all, for the one
    it lies in, and fewer the farther one is. ``place`` 0 is the finer list in which it is a member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cell, place = vectors_of(batch.column(2)), batch.column(3).to_numpy(), batch.column(4).to_numpy()
            raw, take, cells, places = batch.column(5), [], [], []
            groups = np.unique(np.stack([cell, np.array([hash(g) for g in batch.column(0).to_pylist()])]), axis=1, return_inverse=True)[1].reshape(-1)
            for g in range(groups.max() + 1):
                rows = np.flatnonzero(groups == g)
                c = np.frombuffer(raw[int(rows[0])].as_py(), np.float32).reshape(-1, DIM)
                near = np.argsort(-(x[rows] @ c.T), axis=1, kind="stable")
                for r, order in zip(rows, near):
                    n = min(len(c), max(1, probes // (1 + int(place[r]))))
                    take += [r] * n
                    cells += [(int(cell[r]) + 1) * 1_000_000 + int(k) for k in order[:n]]
                    places += [int(place[r]) * probes + k for k in range(n)]
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(3)), pa.array(cells, pa.int64()), pa.array(places, pa.int32())], ["grp", "cls", "vec", "cell", "place"])

    met = visits.join(fine, ["grp", "cell"])
    return met.select("grp", "cls", "vec", "cell", "place", "centres").mapInArrow(run, "grp string, cls bigint, vec binary, cell bigint, place int")


def small(df: DataFrame, rows: int = BROADCAST) -> DataFrame:
    """The table, marked for a broadcast if it is known to have few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def neighbours(vectors: DataFrame, k: int = K, floor: float | None = FLOOR, probes: int = PROBES, block: int = BLOCK, fine: int = FINE, copies: int = COPIES) -> DataFrame:
    """(id, neighbour, similarity) of the k most similar vectors of each usable vector (id, grp, embedding)."""
    ready = cut(rotated(vectors))
    in_class = Window.partitionBy("grp", "cls").orderBy("id")
    offered = ready.withColumn("rn", F.row_number().over(in_class)).where(F.col("rn") <= k + 1)
    classes = offered.groupBy("grp", "cls").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))

    # the groups with most vectors, as many as the sample has rows; the vectors of any other lie in one coarse list
    by_group = dict(ready.groupBy("grp").count().orderBy(F.desc("count"), "grp").limit(SAMPLE).collect())
    share = math.ceil((1 << 30) * min(1.0, 1.2 * SAMPLE / max(1, sum(by_group.values()))))  # so few rows meet for the limit
    lot = F.xxhash64("id", F.lit(1))
    rows = ready.where(F.pmod(lot, F.lit(1 << 30)) < share).orderBy(lot).limit(SAMPLE).select("grp", "vec").toArrow()
    names, sample, index = np.array(rows.column(0).to_pylist(), object), vectors_of(rows.column(1).combine_chunks()), {}
    for g, n in by_group.items():
        own = sample[names == g]
        if len(own):
            index[g] = centres(own, min(round(n**0.5), max(1, len(own) // 8)))

    cells = cut(indexed(classes, index, probes))
    visits = cells.select("grp", "cls", "vec", F.posexplode("cells").alias("place", "cell"))
    lists = cut(visits.groupBy("grp", "cell").agg(F.count_if(F.col("place") == 0).alias("members")))
    one_level = lists.where(F.col("members") > fine).isEmpty()
    if one_level:
        placed = visits.withColumn("cell", F.col("cell").cast("bigint"))
    else:
        large = lists.where(F.col("members") > fine)
        inner = cut(fine_centres(visits.where("place = 0"), large, fine))
        whole = visits.join(small(large.select("grp", "cell")), ["grp", "cell"], "left_anti")
        placed = cut(whole.select("grp", "cls", "vec", F.col("cell").cast("bigint").alias("cell"), "place").union(refined(visits, inner, probes).select("grp", "cls", "vec", "cell", "place")))
    sized = placed.groupBy("grp", "cell").agg(F.count_if(F.col("place") == 0).alias("members"), F.count("*").alias("queries"))
    blocks = small(cut(sized.select("grp", "cell", F.col("queries").alias("n"), *(F.greatest(F.lit(1), F.ceil(F.col(c) / block)).cast("int").alias(c) for c in ("members", "queries")))))
    placed = placed.join(blocks.drop("n"), ["grp", "cell"])
    piece = lambda n: F.pmod(F.xxhash64("cls", F.lit(17)), F.col(n)).cast("int")
    spread = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    asking = placed.withColumn("mb", F.explode(spread("members"))).select("grp", "cell", "mb", piece("queries").alias("qb"), F.lit(1).alias("role"), "cls", "vec")
    member = placed.where("place = 0").withColumn("qb", F.explode(spread("queries"))).select("grp", "cell", piece("members").alias("mb"), "qb", F.lit(0).alias("role"), "cls", "vec")
    total = blocks.agg(F.coalesce(F.sum(F.col("n") * (F.col("members") + 1)), F.lit(0))).first()[0]
    parts = max(int(ready.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // UNIT_ROWS))
    work = asking.union(member).withColumn("unit", F.xxhash64("grp", "cell", "mb", "qb")).repartition(parts, "unit")
    found = scanned(work, k + 1, floor)

    offers = classes.select("grp", F.col("cls").alias("m"), "ids")
    best = Window.partitionBy("grp", "q").orderBy(F.desc("sim"), "m")
    once = found if one_level else found.groupBy("grp", "q", "m").agg(F.max("sim").alias("sim"))  # a pair may meet in several finer lists
    nearest = once.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1).drop("rn")
    rank = Window.partitionBy("grp", "q").orderBy(F.desc("sim"), "neighbour")
    listed = nearest.join(offers, ["grp", "m"]).select("grp", "q", "sim", F.explode("ids").alias("neighbour"))
    top = listed.withColumn("rn", F.row_number().over(rank)).where(F.col("rn") <= k + 1)
    # a class of many copies asks block by block
    crowds = cut(ready.groupBy("grp", F.col("cls").alias("q")).agg(F.ceil(F.count("*") / copies).cast("int").alias("blocks")).where("blocks > 1"))
    asked = ready.select("grp", F.col("cls").alias("q"), "id")
    part = lambda: F.pmod(F.xxhash64("id", F.lit(31)), F.coalesce("blocks", F.lit(1))).cast("int")
    if crowds.isEmpty():
        pairs = top.join(asked, ["grp", "q"]).where("id <> neighbour")
    else:
        few = small(crowds)
        asked = asked.join(few, ["grp", "q"], "left").select("grp", "q", "id", part().alias("part"))
        offer = top.join(few, ["grp", "q"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")
        pairs = offer.join(asked, ["grp", "q", "part"]).where("id <> neighbour")
    mine = Window.partitionBy("id").orderBy("rn")
    return pairs.withColumn("place", F.row_number().over(mine)).where(F.col("place") <= k).select("id", "neighbour", F.col("sim").alias("similarity"))


def found_pairs(vectors: DataFrame, **options) -> DataFrame:
    """(chunk_id_a, chunk_id_b): pairs of which at least one is among the other's neighbours, each once."""
    n = neighbours(vectors, **options)
    return n.select(F.least("id", "neighbour").alias("chunk_id_a"), F.greatest("id", "neighbour").alias("chunk_id_b")).distinct()
