"""Problem 3: parent links of unknown depth into roots, depths, paths, cycles and descendants.

Method: weighted disjoint-set forests. Each partition joins its own links into a forest in which a node knows its
topmost node within the partition and the offset to it. What is left are the links of those topmost nodes into other
partitions. They are contracted by one lookup of their targets and joined again in ever fewer partitions, until one
bounded forest holds the rest; every round also doubles the length that a link spans, so the number of rounds is at
most the logarithm of the longest chain of partitions. Paths are put together from the partition's own piece,
collected by walking its index of parents, and the piece of its topmost node.

Scale: links are placed by document and range of chunk numbers, so that most end in their own partition and a filing
that holds a third of all rows is spread over many; nodes are never brought to one place, only open contracted links
are, and only below ``ONE_FOREST``.

Defined results: a null, blank or unknown parent makes a root of depth 0; a node on a cycle or below one has depth -1,
an empty path and the smallest id on that cycle as root; a node that is its own parent is such a cycle; a null number
is ``-`` in a path; rows with a null id are left out; ids are compared by ``key`` and come out as they are in ``id``.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.session import broadcast_if_small, cut

ONE_FOREST, RANGE, PARTITION_ROWS, SLOTS, HEADS = 200_000, 4096, 200_000, 16, 10_000
LOCAL = "key string, id string, top string, root string, steps int, path string, out string, low string, cycle string"
OPEN = "key string, top string, root string, steps bigint, path string, low string, cycle string, done boolean"


def forest(parent: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(top, steps, order) of nodes 0..n-1: the topmost node of each, the steps to it and an order with parents first.

    parent[i] is -1 where the link leaves. A node on a cycle, or below one, has top -1 - c with c a node on that cycle.
    """
    n = len(parent)
    top, steps, order, mark = [n] * n, [0] * n, [], [0] * n
    for i in range(n):
        trail, at = [], i
        while top[at] == n and mark[at] != i + 1:
            mark[at] = i + 1
            trail.append(at)
            if parent[at] < 0:
                top[at] = at
                order.append(at)
                trail.pop()
                break
            at = parent[at]
        if top[at] == n:  # the trail bit its own tail
            first = trail.index(at)
            for k in trail[first:]:
                top[k] = -1 - at
                order.append(k)
            trail = trail[:first]
        for k in reversed(trail):
            top[k] = top[parent[k]]
            steps[k] = steps[parent[k]] + 1
            order.append(k)
    return top, steps, order


def lowest_on_cycles(parent: list[int], top: list[int], names: list[str]) -> dict[int, str]:
    """The smallest name on every cycle, by the node that stands for it."""
    out = {}
    for c in {-1 - t for t in top if t < 0}:
        low, at = names[c], parent[c]
        while at != c:
            low, at = min(low, names[at]), parent[at]
        out[c] = low
    return out


def local_forests(nodes: DataFrame) -> DataFrame:
    """Forests of the links within each partition of (key, id, parent, label).

    ``top`` (its id ``root``) and ``steps`` lead to the topmost node, ``path`` are the labels from it to the node, ``low`` is the smallest
    id from the node up to, but without, the topmost one, ``out`` the parent of the topmost node elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        keys, ids, parents, labels = ([x for b in rows for x in b.column(c).to_pylist()] for c in range(4))
        place = {k: i for i, k in enumerate(keys)}
        up = [-1 if p is None else place.get(p, -1) for p in parents]
        top, steps, order = forest(up)
        cycles = lowest_on_cycles(up, top, ids)
        path, low = [None] * len(keys), [None] * len(keys)
        for i in order:
            if top[i] == i:
                path[i] = labels[i]
            elif top[i] >= 0:
                path[i] = f"{path[up[i]]}/{labels[i]}"
                low[i] = ids[i] if low[up[i]] is None else min(ids[i], low[up[i]])
        head = [keys[t] if t >= 0 else None for t in top]
        roots = [ids[t] if t >= 0 else None for t in top]
        leaves = [parents[t] if t >= 0 else None for t in top]
        ring = [cycles[-1 - t] if t < 0 else None for t in top]
        columns = [keys, ids, head, roots, steps, path, leaves, low, ring]
        kinds = [pa.int32() if k == 4 else pa.string() for k in range(9)]
        names = [f.split()[0] for f in LOCAL.split(", ")]
        for at in range(0, len(keys), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 20_000], t) for c, t in zip(columns, kinds)], names)

    return nodes.select("key", "id", "parent", "label").mapInArrow(run, LOCAL)


def joined_forest(links: DataFrame) -> DataFrame:
    """One round over open links (key, top, root, steps, path, low, cycle, done): chains within a partition become one link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        key, head, root, steps, path, low, ring, done = ([x for b in rows for x in b.column(c).to_pylist()] for c in range(8))
        place = {k: i for i, k in enumerate(key)}
        up = [-1 if d else place.get(t, -1) for t, d in zip(head, done)]
        tops, _, order = forest(up)
        cycles = lowest_on_cycles(up, tops, low)
        for i in order:
            if tops[i] < 0:
                ring[i], done[i] = cycles[-1 - tops[i]], True
            elif (u := up[i]) >= 0:
                head[i], root[i], steps[i], low[i] = head[u], root[u], steps[i] + steps[u], min(low[i], low[u])
                ring[i], done[i] = ring[u], done[u]
                path[i] = None if ring[i] is not None else f"{path[u]}/{path[i]}" if path[u] else path[i]
        columns = [key, head, root, steps, path, low, ring, done]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in OPEN.split(", ")])

    return links.select("key", "top", "root", "steps", "path", "low", "cycle", "done").mapInArrow(run, OPEN)


def contracted(local: DataFrame, heads: int = HEADS) -> DataFrame:
    """Links of topmost nodes to the topmost node that their parent elsewhere has; done where that is settled.

    ``path`` are the labels from the target down to the parent, ``low`` the smallest id from the node up to, but
    without, the target.
    """
    open_tops = local.where("key = top AND out IS NOT NULL").select("key", "id", "out")
    # a parent that many heads ask for is there once for every ``heads`` of them
    crowds = cut(open_tops.groupBy("out").agg(F.ceil(F.count("*") / heads).cast("int").alias("slots")).where("slots > 1"))
    target = local.select(
        F.col("key").alias("p_key"), F.col("top").alias("p_top"), F.col("root").alias("p_root"), F.col("steps").alias("p_steps"), F.col("path").alias("p_path"),
        F.col("low").alias("p_low"), F.col("cycle").alias("p_cycle"), F.col("out").alias("p_out"),
    )
    if crowds.isEmpty():
        met = open_tops.join(target, F.col("out") == F.col("p_key"), "left")
    else:
        few = broadcast_if_small(crowds)
        slots = F.coalesce("slots", F.lit(1))
        asking = open_tops.join(few, "out", "left").withColumn("slot", F.pmod(F.xxhash64("key"), slots).cast("int")).drop("slots")
        there = target.join(few.withColumnRenamed("out", "p_key"), "p_key", "left").withColumn("p_slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop("slots")
        met = asking.join(there, (F.col("out") == F.col("p_key")) & (F.col("slot") == F.col("p_slot")), "left")
    known = F.col("p_key").isNotNull()
    return met.select(
        "key",
        F.when(known, F.col("p_top")).otherwise(F.col("key")).alias("top"),
        F.when(known, F.col("p_root")).otherwise(F.col("id")).alias("root"),
        F.when(known, F.col("p_steps") + 1).otherwise(0).cast("bigint").alias("steps"),
        F.col("p_path").alias("path"),
        F.least("id", "p_low").alias("low"),
        F.col("p_cycle").alias("cycle"),
        (~known | F.col("p_cycle").isNotNull() | F.col("p_out").isNull()).alias("done"),
    )


def doubled(links: DataFrame) -> DataFrame:
    """Each open link is continued by the link of its target, if that is open or settled."""
    n = links.select(*(F.col(c).alias(f"n_{c}") for c in ("key", "top", "root", "steps", "path", "low", "cycle", "done")))
    met = links.where("NOT done").join(n, F.col("top") == F.col("n_key"), "left")
    more = F.col("n_key").isNotNull()
    return met.select(
        "key",
        F.when(more, F.col("n_top")).otherwise(F.col("top")).alias("top"),
        F.when(more, F.col("n_root")).otherwise(F.col("root")).alias("root"),
        F.when(more, F.col("steps") + F.col("n_steps")).otherwise(F.col("steps")).alias("steps"),
        F.concat_ws("/", "n_path", "path").alias("path"),
        F.least("low", "n_low").alias("low"),
        F.col("n_cycle").alias("cycle"),
        F.coalesce("n_done", F.lit(True)).alias("done"),
    ).union(links.where("done"))


def settled(links: DataFrame, one_forest: int) -> DataFrame:
    """All links with their end: rounds of ever fewer partitions, then one bounded forest."""
    span = 1
    while (open_links := links.where("NOT done").count()) > one_forest:
        parts = -(-open_links // one_forest)
        links = cut(doubled(joined_forest(links.repartition(parts, "top"))))
        span *= 2
        if span > 2 * open_links:  # whatever is still open runs in circles, and its target has seen all of its circle
            low = links.select(F.col("key").alias("top"), F.col("low").alias("ring"))
            rest = links.where("NOT done").join(low, "top").select("key", "top", "root", "steps", "path", "low", F.col("ring").alias("cycle"), F.lit(True).alias("done"))
            return links.where("done").union(rest)
    # the last forest also needs the settled links at which open ones end
    ends = links.where("done").join(links.where("NOT done").select(F.col("top").alias("key")).distinct(), "key", "left_semi")
    last = joined_forest(links.where("NOT done").union(ends).coalesce(1))
    return links.where("done").join(ends.select("key"), "key", "left_anti").union(last)


def trees(nodes: DataFrame, partitions: int | None = None, one_forest: int = ONE_FOREST, heads: int = HEADS) -> DataFrame:
    """(id, root_id, node_depth, node_path) of the nodes (key, id, parent, label, place).

    ``place`` says which nodes should meet in a partition; equal keys must not occur twice.
    """
    nodes = nodes.where("key IS NOT NULL")
    spread = nodes.repartition(partitions, "place") if partitions else nodes.repartition("place")
    local = cut(local_forests(spread))
    links = settled(cut(contracted(local, heads)), one_forest)
    far = links.select(*(F.col(c).alias(a) for c, a in (("key", "top"), ("root", "f_root"), ("steps", "f_steps"), ("path", "f_path"), ("cycle", "f_cycle"))))
    # a node whose topmost node has no way out is settled; the others wait for the link of their topmost node, and as
    # that has all its nodes in one partition, no key of this join is hot
    inner = local.where("out IS NULL").select("id", "root", "steps", "path", "cycle")
    outer = local.where("out IS NOT NULL").join(far, "top").select(
        "id",
        F.col("f_root").alias("root"),
        F.col("steps") + F.col("f_steps").cast("int"),
        F.concat_ws("/", "f_path", "path").alias("path"),
        F.col("f_cycle").alias("cycle"),
    )
    loops = F.col("cycle").isNotNull()
    return inner.union(outer).select(
        "id",
        F.coalesce("cycle", "root").alias("root_id"),
        F.when(loops, -1).otherwise(F.col("steps")).cast("int").alias("node_depth"),
        F.when(loops, "").otherwise(F.col("path")).alias("node_path"),
    )


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions that hold at most PARTITION_ROWS rows each on average, and no fewer than a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


def placed(document: Column, number: Column, key: Column) -> Column:
    """Where a chunk's links are joined first: its document and range of chunk numbers; those without a number are spread by their key."""
    return F.xxhash64(document, F.coalesce(F.floor(number / RANGE), -1 - F.pmod(F.xxhash64(key), F.lit(SLOTS))))


def opened(nodes: DataFrame, stuck: DataFrame, partitions: int | None, one_forest: int) -> DataFrame:
    """(id, up) of the nodes below cycles: the ids of all that are above them and their own, nearest last.

    ``stuck`` (id, cycle) are the nodes on or below cycles. Without the link of its smallest id a cycle is a chain, whose
    end has the whole cycle as its path. A node below has the part of that chain down to where it leaves it; the rest of
    the cycle is above that part. A cycle costs what a chain of its length costs.
    """
    rows = cut(nodes.join(stuck, "id"))
    first = F.col("id") == F.col("cycle")
    found = trees(rows.withColumn("parent", F.when(~first, F.col("parent"))), partitions, one_forest)
    up = found.select("id", F.col("root_id").alias("cycle"), F.split("node_path", "/").alias("up"))
    ends = rows.where(first).select(F.col("parent").alias("key")).join(rows.select("key", "id"), "key").select("id")
    # all that hang on one cycle meet it, so it is there once for every slot
    rings = up.join(ends, "id").select("cycle", F.col("up").alias("ring"), F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("slot"))
    met = up.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(SLOTS)).cast("int")).join(rings, ["cycle", "slot"])
    shared = F.size(F.array_intersect("up", "ring"))
    return met.where(shared < F.size("up")).select("id", F.concat(F.slice("ring", shared + 1, F.size("ring") - shared), "up").alias("up"))


def descendants(nodes: DataFrame, partitions: int | None = None, one_forest: int = ONE_FOREST) -> DataFrame:
    """(id, descendant_id, levels): every node below every node.

    A path of ids names all that are above a node, so its expansion is the result and nothing else is moved. Below a
    cycle, every node of the cycle is above as well, once and with the fewest levels. What is on a cycle is not given as a
    descendant: it would be below itself and all that is below it.
    """
    escaped = nodes.where("key IS NOT NULL").withColumn("label", F.translate("id", "/", "\x1f"))
    found = trees(escaped, partitions, one_forest)
    above = found.where("node_depth > 0").select("id", F.split("node_path", "/").alias("up"))
    stuck = cut(found.where("node_depth < 0").select("id", F.col("root_id").alias("cycle")))
    if not stuck.isEmpty():
        above = above.union(opened(escaped, stuck, partitions, one_forest))
    pairs = above.select(F.col("id").alias("descendant_id"), F.size("up").alias("n"), F.posexplode("up").alias("pos", "above"))
    below = pairs.where("pos < n - 1")
    return below.select(F.translate("above", "\x1f", "/").alias("id"), "descendant_id", (F.col("n") - 1 - F.col("pos")).alias("levels"))
