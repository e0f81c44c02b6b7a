import random
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from graniteflow.llm import neardup, splitting


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(900)]
    texts = []
    for _ in range(n):
        base = rng.sample(vocabulary, rng.randrange(55, 110))
        texts.append(base)
        for _ in range(rng.randrange(3)):
            edit = [w if rng.random() > 0.08 else rng.choice(vocabulary) for w in base]
            rng.shuffle(edit)
            texts.append(edit)
    return [(f"t{k:03d}", " ".join(t)) for k, t in enumerate(texts)]


def brute(rows):
    sets = {i: set(neardup.WORD.findall(t.lower())) for i, t in rows if t}
    ids = sorted(i for i, s in sets.items() if len(s) >= 50)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if 10 * len(sets[a] & sets[b]) >= 7 * len(sets[a] | sets[b])}


@pytest.mark.parametrize("hot", [neardup.HOT, 40])
def test_pairs_are_those_of_brute_force(spark, hot):
    rows = corpus()
    same = " ".join(f"copy{k}" for k in range(70))
    rows += [(f"x{k:02d}", same) for k in range(12)] + [("short", "too few words"), ("none", None), ("empty", ""), ("upper", same.upper())]
    d = spark.createDataFrame([(i, t, 1, b"c") for i, t in [*rows, (None, same)]], "id string, text string, cls int, words binary")
    got = [tuple(r) for r in neardup.near_copies(d, hot=hot, bands=60).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert neardup.near_copies(d.limit(0)).count() == 0


def test_hot_shards_are_worked_on_in_blocks(spark):
    rng = random.Random(8)
    base = [f"b{k}" for k in range(60)]
    rows = [(f"h{k:03d}", " ".join(base[: 60 - rng.randrange(4)] + [f"u{k}"])) for k in range(150)]
    d = spark.createDataFrame(rows, "id string, text string")
    assert {tuple(r) for r in neardup.near_copies(d, hot=20, bands=60, copies=5).collect()} == brute(rows)


def test_sampled_hot_shards_lose_nothing(spark):
    rng = random.Random(9)
    base = [f"b{k}" for k in range(60)]
    rows = [(f"h{k:03d}", " ".join(base[: 60 - rng.randrange(4)] + [f"u{k}"])) for k in range(120)] + [(f"c{k:02d}", " ".join(base)) for k in range(23)]
    d = spark.createDataFrame(rows, "id string, text string")
    sampled, neardup.SAMPLED = neardup.SAMPLED, 2
    try:
        assert not neardup.hot_shards(neardup.banded(neardup.sample_of(neardup.word_sets(d)), 60, 5), 8).isEmpty()
        assert {tuple(r) for r in neardup.near_copies(d, hot=8, bands=60, copies=4).collect()} == brute(rows)
    finally:
        neardup.SAMPLED = sampled


def test_bounds_of_vantage_points_prune_and_lose_nothing():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, (1, neardup.LANES), dtype=np.uint64)
    fps = np.repeat(base, 240, axis=0)
    for k in range(240):  # members at all distances from the first
        for bit in rng.choice(192, k // 2, replace=False):
            fps[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    sizes, count = np.full(240, 60, np.int32), Counter()
    i, j = neardup.tree_pairs(fps, sizes, count)
    d = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
    assert {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())} == {(a, b) for a, b in zip(*np.nonzero(d <= neardup.radius(60, 60))) if a < b}
    assert count["pruned"] > count["met"] and count["met"] + count["pruned"] == 240 * 239 // 2
    key, cls = np.repeat(np.arange(80), 3), np.arange(240)
    a, b, held = neardup.shard_pairs(key, cls, sizes, fps, 100)
    assert {(x, y) for x, y in zip(a.tolist(), b.tolist())} == {(x, y) for x, y in zip(*np.nonzero(d <= neardup.radius(60, 60))) if x < y and x // 3 == y // 3} and not len(held)


def test_recall_at_the_limit_with_the_bands_of_the_query(spark):
    rng = random.Random(11)
    rows = []
    for k in range(600):
        word = lambda n, side: [f"{side}{k}x{j}x{rng.randrange(1000)}" for j in range(n)]
        both = word(56, "s")
        for side in "ab":  # 56 shared words of 80: a similarity of 0.7
            rows.append((f"p{k:03d}{side}", " ".join(both + word(12, side))))
    got = {tuple(r) for r in neardup.near_copies(spark.createDataFrame(rows, "id string, text string")).collect()}
    want = {(f"p{k:03d}a", f"p{k:03d}b") for k in range(600)}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 63, (300, neardup.LANES), dtype=np.uint64)
    fps[150:] = fps[:150] ^ (np.uint64(1) << rng.integers(0, 63, (150, neardup.LANES), dtype=np.uint64))
    sizes = np.full(300, 60, np.int32)
    i, j = neardup.tree_pairs(fps, sizes)
    d = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
    want = {(a, b) for a, b in zip(*np.nonzero(d <= neardup.radius(60, 60))) if a < b}
    assert {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())} == want and len(i) == len(want)


def test_groups_and_links(spark):
    rows = corpus(3, 25)
    pairs = brute(rows)
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["id"]: (r["group_id"], r["links"]) for r in neardup.groups(spark.createDataFrame(rows, "id string, text string")).collect()}
    assert got == {i: (find(i), sum(i in p for p in pairs)) for i, _ in rows}


def longest_stretch_line(text, limit):
    for k, line in enumerate(text.split("\n")):
        parts = regex.split(r"(?<=[。！？])|(?<=[.!?])(?=\s|$)", line)
        if any(len(p.strip()) > limit for p in parts):
            return k
    return -1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["word ", "longer ", "x" * 30, ". ", "! ", "\n", "。", "　", "\r\n", "3.5 "]), max_size=120), st.integers(20, 80), st.integers(0, 9))
def test_pieces(parts, limit, overlap):
    text = "".join(parts)
    pieces, forced = splitting.split_text(text, limit, overlap)
    at = 0
    for k, (a, b, _) in enumerate(pieces):
        assert 0 < b - a <= limit and b > at
        assert not text[at:a].strip() if a >= at else k > 0 and at - a <= overlap
        at = b
    assert not text[at:].strip()
    assert (forced >= 0) == any(hard for *_, hard in pieces)
    assert (text.count("\n", 0, forced) if forced >= 0 else -1) == longest_stretch_line(text, limit)


def test_valleys_are_preferred():
    a, b = "Tide waves sail harbour ship. ", "Bread flour oven dough yeast. "
    text = a * 8 + b * 8
    pieces, _ = splitting.split_text(text, 300, 20)
    assert pieces[0][1] == len(a * 8) - 1


def test_lines_nulls_and_empties(spark):
    long = "One sentence here. " * 20 + "\n" + "Another one there. " * 20
    d = spark.createDataFrame([("a", long, 5, 1), ("b", None, 1, 1), ("c", "", 1, 1), ("d", long, None, 1), ("e", " " * 900, 1, 1), ("f", "z" * 1200, 7, 1)], "id string, text string, start_line int, piece_no int")
    got = splitting.split_column(d).toPandas()
    assert set(got["id"]) == {"a", "d", "f"}
    lines = {r["id"]: r["forced_line"] for r in splitting.forced_lines(d).collect()}
    assert lines == {"a": 0, "d": 0, "e": 0, "f": 7}
    own = got[got["id"] == "a"]
    assert own["start_line"].iloc[0] == 5 and own["end_line"].iloc[-1] == 6 and set(own["forced_line"]) == {0}
    assert got[got["id"] == "d"]["start_line"].isna().all()
    assert set(got[got["id"] == "f"]["forced_line"]) == {7} and (got["n_chars"] <= 500).all()
    f = got[got["id"] == "f"].sort_values("piece_no")
    assert f["n_chars"].sum() == 1200 + 50 * (len(f) - 1)
    with pytest.raises(ValueError):
        splitting.split_column(d, 100, 60)
