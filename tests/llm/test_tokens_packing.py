import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graniteflow.llm import packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.BYTE_BPE_50K), reason="no vocabulary")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_the_library(text):
    import tiktoken

    m = tokens.merger(tokens.BYTE_BPE_50K)
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    assert m.encode(text) == tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=m.ranks, special_tokens={}).encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 3001, "ab" * 2000, "é漢字 " * 500, "\x1c\x1d \x85 　x", "<|endoftext|>", " \n\n  x", "don't I'LL"])
def test_long_and_odd_texts(reference, text):
    assert tokens.merger(tokens.BYTE_BPE_50K).encode(text) == reference(text)


def test_nulls_empties_and_other_columns(spark, reference):
    d = spark.createDataFrame([(1, "one two", "c"), (2, "", "c"), (3, None, None), (3, None, None), (None, "x", "c")], "doc_id bigint, text string, ids string")
    got = sorted(((r["doc_id"], r["ids"]) for r in tokens.encode_column(d, "doc_id", "text").collect()), key=str)
    assert got == sorted([(1, reference("one two")), (2, []), (3, []), (3, []), (None, reference("x"))], key=str)
    assert tokens.encode_column(d.limit(0), "doc_id", "text").collect() == []


def test_best_fit_takes_the_tightest_compatible_bin():
    # bins of residual 40, 30 and 20; the item of 20 fits the last best, but its cluster is there
    items = [(60, 0, -1), (70, 1, -1), (80, 2, 5)]
    assert packing.best_fit([*items, (20, 0, -1)], 100, 9)[-1] == 2
    assert packing.best_fit([*items, (20, 0, 5)], 100, 9)[-1] == 1
    assert packing.best_fit([*items, (20, 3, -1)], 100, 1) == [0, 1, 2, 3]


def test_near_copies_never_share_a_container(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(90)]
    rows = []
    for k in range(30):  # each differs from the first in one word, so in five runs of 86
        own = list(base)
        if k:  # two of them share less than 0.8, but both are near the first
            own[k * 3] = "changed"
        rows.append((k, "a", " ".join(own)))
    rows += [(100 + k, rng.choice("ab"), " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60)))) for k in range(120)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id bigint, source string, text string"), capacity=600).toPandas()
    near = out[out["doc_id"] < 30]
    assert near["cluster"].nunique() == 1 and near["container_id"].nunique() == 30


def test_containers(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(k, rng.choice("abcdef"), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for k in range(400)]
    rows += [(1000 + k, "a", "the very same text in every copy") for k in range(150)]  # a hot cluster
    rows += [(2000, "b", "long " * 500), (2001, None, None), (2002, "c", ""), (2003, None, "no source"), (None, "a", "no id"), (None, "a", "no id")]
    d = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    out = packing.pack(d, capacity=100, max_sources=2, group_size=200).toPandas()
    m = tokens.merger(tokens.BYTE_BPE_50K)
    sizes = out.groupby("doc_id")["n_tokens"].sum().to_dict()
    assert sizes == {r[0]: m.count(r[2]) for r in rows if r[0] is not None}
    assert out["doc_id"].isna().sum() == 2
    held = out[out["container_id"].notna()]
    by = held.groupby("container_id")
    assert by["n_tokens"].sum().max() <= 100
    assert by["source"].nunique(dropna=False).max() <= 2
    assert not held.duplicated(["container_id", "cluster"]).any()
    assert set(out[out["container_id"].isna()]["doc_id"]) == {2001, 2002}
    parts = held[held["doc_id"] == 2000].sort_values("part_no")
    assert list(parts["first_token"]) == [100 * k for k in range(len(parts))] and len(parts) == -(-m.count("long " * 500) // 100)
    assert packing.pack(d.limit(0)).count() == 0
