import random

import pytest

from graniteflow.operators import hierarchy

SCHEMA = "key string, id string, parent string, label string, place bigint, path string, root string"


def brute(links, labels):
    out = {}
    for n in links:
        trail, at = [n], n
        while (p := links[at]) in links and p not in trail:
            trail.append(p)
            at = p
        if (p := links[at]) in links:
            ring = trail[trail.index(p) :]
            out[n] = (min(ring), -1, "")
        else:
            out[n] = (trail[-1], len(trail) - 1, "/".join(labels[t] for t in reversed(trail)))
    return out


def run(spark, links, labels, places, one_forest=hierarchy.ONE_FOREST, partitions=5):
    rows = [(k, k, links[k], labels[k], places[k], "clash", "clash") for k in links]
    df = hierarchy.trees(spark.createDataFrame(rows, SCHEMA), partitions, one_forest)
    return {r["id"]: (r["root_id"], r["node_depth"], r["node_path"]) for r in df.collect()}


@pytest.mark.parametrize("seed,one_forest", [(1, 200_000), (2, 7), (3, 25)])
def test_random_forests_with_cycles(spark, seed, one_forest):
    rng = random.Random(seed)
    ids = [f"n{k:03d}" for k in range(150)]
    links = {n: rng.choice([None, "gone", *ids, *ids[:k], *ids[:k], *ids[:k]]) for k, n in enumerate(ids)}
    labels = {n: rng.choice(["-", str(k)]) for k, n in enumerate(ids)}
    assert run(spark, links, labels, {n: rng.randrange(40) for n in ids}, one_forest) == brute(links, labels)


def test_one_long_chain_and_a_ring_over_partitions(spark):
    ids = [f"c{k:04d}" for k in range(400)]
    links = {n: ids[k - 1] if k else None for k, n in enumerate(ids)}
    ring = [f"r{k:03d}" for k in range(60)]
    links |= {n: ring[(k + 1) % 60] for k, n in enumerate(ring)} | {"tail": "r007", "self": "self"}
    labels = {n: n for n in links}
    places = {n: k for k, n in enumerate(links)}
    got = run(spark, links, labels, places, 20, 7)
    assert got == brute(links, labels)
    assert got["self"] == ("self", -1, "") and got["tail"][0] == "r000"


def test_a_parent_of_many_heads_elsewhere(spark):
    links = {"root": None, "hub": "root"} | {f"h{k:03d}": "hub" for k in range(90)} | {f"t{k:03d}": f"h{k:03d}" for k in range(90)}
    labels, rows = {n: n for n in links}, []
    for k, n in enumerate(links):
        rows.append((n, n, links[n], n, k, "clash", "clash"))
    df = hierarchy.trees(spark.createDataFrame(rows, SCHEMA), 9, heads=8)
    assert {r["id"]: (r["root_id"], r["node_depth"], r["node_path"]) for r in df.collect()} == brute(links, labels)


def test_empty(spark):
    assert run(spark, {}, {}, {}) == {}


def test_descendants(spark):
    links = {"a": None, "b/x": "a", "c": "b/x", "d": "a", "y": "z", "z": "y"}
    df = spark.createDataFrame([(k, k, v, k, 1) for k, v in links.items()], "key string, id string, parent string, label string, place bigint")
    got = {tuple(r) for r in hierarchy.descendants(df).collect()}
    assert got == {("a", "b/x", 1), ("a", "c", 2), ("b/x", "c", 1), ("a", "d", 1)}


def below_brute(links):
    """Pairs by walking up from every node that is not on a cycle."""
    out = set()
    for n in links:
        trail, at = [n], n
        while (p := links[at]) in links and p not in trail:
            trail.append(p)
            at = p
        if links[at] != n:
            out |= {(a, n, k) for k, a in enumerate(trail) if k}
    return out


def below(spark, links, places, **k):
    df = spark.createDataFrame([(n, n, p, n, places[n]) for n, p in links.items()], "key string, id string, parent string, label string, place bigint")
    rows = [tuple(r) for r in hierarchy.descendants(df, **k).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_descendants_below_cycles(spark):
    links = {"a": None, "b": "a", "r/1": "r3", "r2": "r/1", "r3": "r2", "x": "r2", "y": "x", "self": "self", "t": "self"}
    want = {("a", "b", 1), ("r2", "x", 1), ("r/1", "x", 2), ("r3", "x", 3), ("x", "y", 1), ("r2", "y", 2), ("r/1", "y", 3), ("r3", "y", 4), ("self", "t", 1)}
    assert below(spark, links, dict.fromkeys(links, 1)) == below_brute(links) == want


def test_descendants_of_random_forests_with_cycles(spark):
    rng = random.Random(5)
    ids = [f"n{k:03d}" for k in range(150)]
    links = {n: rng.choice([None, "gone", *ids, *ids[:k], *ids[:k], *ids[:k]]) for k, n in enumerate(ids)} | {"n000": "n002", "n001": "n000", "n002": "n001"}
    places = {n: rng.randrange(40) for n in ids}
    want = below_brute(links)
    assert below(spark, links, places, partitions=5, one_forest=20) == want
    assert any(a in ("n000", "n001", "n002") for a, _, _ in want)


def test_id_key(spark):
    from graniteflow.operators.latest import id_key

    got = spark.createDataFrame([(" AB ",), ("",), (" 　",), (None,)], "id string").select(id_key("id").alias("k")).collect()
    assert [r["k"] for r in got] == ["ab", None, None, None]
