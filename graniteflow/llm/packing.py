"""Problem 7: documents into containers of a fixed number of tokens.

Method: conflict-constrained best fit. Items come in falling size; bins are ordered by residual, carry a bitmap of
their sources and one of their duplicate clusters, and the successor search walks up from the smallest residual
that holds the item until a bin without conflict is found, which is the tightest compatible one.

Conflicts: two texts of one duplicate cluster never share a container, and a container draws on at most ``max_sources``
sources where that is given. Clusters are the groups of near copies of ``neardup``, by runs of five words of which at least 0.8
are shared; a text with fewer words, or without an id, is one with its exact copies (letters and digits in small letters).

Scale: items are spread by a hash of their id over groups of about ``group_size`` documents, each packed by one task;
copies are spread with the rest, so neither a hot source nor a hot cluster meets in one task. A group leaves a
handful of containers part empty, a share that falls with ``group_size`` and not with the corpus.

Defined results: an item above the capacity is cut into full parts and a rest, which is packed like any item;
null and empty texts have no tokens and come out with a null container; repeated rows are packed each.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.llm import neardup
from graniteflow.llm.tokens import BYTE_BPE_50K, merger
from graniteflow.session import cut

CAPACITY, GROUP_SIZE, RUN, ALIKE = 2048, 8192, 5, (8, 10)
BANDS, ROWS = 8, 3  # miss 0.3 % of pairs at 0.8; runs of five words are too rare for texts to meet by chance
PLAIN = re.compile(r"[\W_]+")
SCHEMA = "container_id string, doc_id string, part_no int, first_token int, n_tokens int, source string, cluster string"


def best_fit(items: list[tuple[int, int, int]], capacity: int, max_sources: int | None = None) -> list[int]:
    """The bin of every item (size, source bit number, cluster bit number or -1), which come in falling size.

    ``open_at[r]`` are the bins of residual r and bit r of ``have`` says whether there are any, so the successor of a
    size is found with two operations on one integer.
    """
    have, open_at, sources, clusters, out = 0, [[] for _ in range(capacity + 1)], [], [], []
    for size, source, cluster in items:
        s, c = 1 << source, 0 if cluster < 0 else 1 << cluster
        left, found = have >> size << size, -1
        while left and found < 0:
            r = (left & -left).bit_length() - 1
            for k, b in enumerate(open_at[r]):
                if not clusters[b] & c and (max_sources is None or sources[b] & s or sources[b].bit_count() < max_sources):
                    found = b
                    open_at[r].pop(k)
                    break
            left &= left - 1
        if found < 0:
            found, r = len(sources), capacity
            sources.append(0)
            clusters.append(0)
        elif not open_at[r]:
            have ^= 1 << r
        sources[found] |= s
        clusters[found] |= c
        r -= size
        if r:
            open_at[r].append(found)
            have |= 1 << r
        out.append(found)
    return out


def pack_group(pdf: pd.DataFrame, capacity: int = CAPACITY, max_sources: int | None = None) -> pd.DataFrame:
    """Containers of one group of documents (doc_id, source, cluster, n_tokens, bucket)."""
    bucket = int(pdf["bucket"].iloc[0])
    rows, full = [], []
    for doc, source, cluster, n in zip(pdf["doc_id"], pdf["source"], pdf["cluster"], pdf["n_tokens"]):
        parts = n // capacity
        full += [(doc, k, k * capacity, capacity, source, cluster) for k in range(parts)]
        if n % capacity:
            rows.append((doc, parts, parts * capacity, n % capacity, source, cluster))
    rows.sort(key=lambda r: (-r[3], r[0] or "", r[1]))
    source_bit = {s: k for k, s in enumerate(dict.fromkeys(r[4] for r in rows))}
    many = [c for c, k in Counter(r[5] for r in rows).items() if k > 1]
    cluster_bit = {c: k for k, c in enumerate(many)}
    bins = best_fit([(r[3], source_bit[r[4]], cluster_bit.get(r[5], -1)) for r in rows], capacity, max_sources)
    named = [(f"{bucket}-{b}", *r) for b, r in zip(bins, rows)] + [(f"{bucket}-f{k}", *r) for k, r in enumerate(full)]
    columns = ["container_id", "doc_id", "part_no", "first_token", "n_tokens", "source", "cluster"]
    return pd.DataFrame(named, columns=columns)


def sized(docs: DataFrame, path: str = BYTE_BPE_50K, step: int = 512) -> DataFrame:
    """(doc_id, source, n_tokens, cluster) of every document, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = part.column(2).to_pylist()
                counts = pa.array(np.fromiter((m.count(t) for t in texts), np.int32, len(texts)))
                clusters = pa.array([hashlib.md5(PLAIN.sub("", t.lower()).encode("utf-8", "replace")).hexdigest() if t else None for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), counts, clusters], ["doc_id", "source", "n_tokens", "cluster"])

    return docs.select("doc_id", "source", "text").mapInArrow(run, "doc_id bigint, source string, n_tokens int, cluster string")


def pack(docs: DataFrame, capacity: int = CAPACITY, max_sources: int | None = None, group_size: int = GROUP_SIZE, path: str = BYTE_BPE_50K) -> DataFrame:
    """The content of every container, one row per part of a document."""
    groups = max(1, -(-docs.count() // group_size))  # a count answered by the file footers
    # ids pass through pandas as text, which keeps null and large ones as they are
    plain = cut(sized(docs, path).withColumn("doc_id", F.col("doc_id").cast("string")))
    near = neardup.groups(docs.select(F.col("doc_id").cast("string").alias("id"), "text"), 1, RUN, ALIKE, BANDS, ROWS).where("links > 0").groupBy("id").agg(F.min("group_id").alias("group_id"))
    met = plain.join(near.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    items = met.withColumn("cluster", F.coalesce(F.concat(F.lit("near "), "group_id"), "cluster")).drop("group_id").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "cluster", "n_tokens"), F.lit(groups)).cast("int"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pdf[pdf["n_tokens"] == 0]
        out = pack_group(pdf[pdf["n_tokens"] > 0], capacity, max_sources) if len(pdf) > len(none) else None
        rest = none.assign(container_id=None, part_no=0, first_token=0)[["container_id", "doc_id", "part_no", "first_token", "n_tokens", "source", "cluster"]]
        return rest if out is None else out if rest.empty else pd.concat([out, rest], ignore_index=True)

    return items.groupBy("bucket").applyInPandas(run, SCHEMA).withColumn("doc_id", F.col("doc_id").cast("bigint"))
