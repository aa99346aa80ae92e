from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostat.llm import sharding

from .conftest import texts_of


def brute_capacity(sizes, n):
    """Smallest largest part over all contiguous partitions, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(n):
        best = [0] + [min(max(best[j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(1, len(sizes) + 1)]
    return best[-1]


def test_smallest_capacity_is_minimax():
    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 14))]
        n = rng.randint(1, 6)
        assert sharding.smallest_capacity(np.array(sizes), n) == brute_capacity(sizes, n)


@pytest.mark.parametrize("n", [1, 3, 5])
def test_cuts_found_by_splitting_ranges_are_the_best(spark, n, monkeypatch):
    rng = random.Random(n)
    rows = [(f"{rng.choice('00ff')}{rng.randrange(16):x}{rng.randrange(1 << 24):06x}", rng.choice([1, 5, 40])) for _ in range(300)]
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    cuts = sharding.minimax_cuts(spark.createDataFrame(rows, "group string, size long"), n)
    by_group = defaultdict(int)
    for g, s in rows:
        by_group[g] += s
    groups = sorted(by_group)
    parts = defaultdict(int)
    for g in groups:
        parts[sum(g >= c for c in cuts)] += by_group[g]
    assert max(parts.values()) == sharding.smallest_capacity(np.array([by_group[g] for g in groups]), n)


def test_documents(with_null_ids):
    rows = sharding.shard_documents(with_null_ids, n_shards=4).collect()
    docs = texts_of(with_null_ids)
    assert sorted((r["size"], r["text_crc32"], str(r["doc_id"])) for r in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), str(i)) for i, t in docs)
    shard_of = defaultdict(set)
    slots = defaultdict(list)
    for r in rows:
        shard_of[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 4
    assert all(len(s) == 1 for s in shard_of.values())  # equal texts stay together
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_largest_shard_is_minimax(odd_docs):
    rows = sharding.shard_documents(odd_docs.where("doc_id <> 303"), n_shards=3).groupBy("shard").agg(
        F.sum("size").alias("n")).collect()
    by_group = defaultdict(int)
    import hashlib

    for i, t in texts_of(odd_docs.where("doc_id <> 303")):
        by_group[hashlib.md5((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    sizes = np.array([by_group[g] for g in sorted(by_group)])
    assert max(r["n"] for r in rows) == sharding.smallest_capacity(sizes, 3)


def test_empty(no_docs):
    assert sharding.shard_documents(no_docs).collect() == []
