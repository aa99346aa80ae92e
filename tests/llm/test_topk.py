from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerostat.llm import topk


def brute(rows, k):
    v = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, a in v:
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in v if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_against_all_pairs(spark, small_blocks, monkeypatch):
    rng = random.Random(5)
    if small_blocks:
        monkeypatch.setattr(topk, "CANDIDATES", 7)
        monkeypatch.setattr(topk, "QUERIES", 2)
        monkeypatch.setattr(topk, "BLOCKS", 2)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(19)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(8)]  # ties
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (350, [float("inf")]), (None, [1.0]),
             (400, []), (401, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("query", F.lit("x")).withColumn(
        "score", F.lit(None).cast("string"))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5)


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 256 * 512)]


def test_large_components_are_scored_exactly(spark):
    rng = random.Random(8)
    sizes = [1.0, 300_000.0, 3e6, 1e12]  # the last with small ones only
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * sizes[rng.choice([0, 0, 0, 1, 2])] for _ in range(9)]) for i in range(60)]
    rows += [(60 + i, [0.0, 1e12 + i, 0.5]) for i in range(2)] + [(50, [0.25, 0.5 ** 8, -0.25])]
    rows += [(63, [300_000.0]), (64, [300_000.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = (F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in topk.top_k(df, asks, k=5).collect()) == brute(rows, 5)
    for bad in (1e30, 4e12):  # a component that no long holds, a score that no long holds
        with pytest.raises(Exception, match="too large|OverflowError|int too big"):
            topk.top_k(spark.createDataFrame([(0, [bad, bad]), (1, [bad, bad])], "vec_id long, embedding array<double>"), asks).collect()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).collect() == []


def test_bound_never_drops_the_best():
    rng = np.random.default_rng(2)
    for _ in range(30):
        there = rng.integers(-200, 200, (rng.integers(1, 40), rng.integers(1, 80)))
        query = rng.integers(-200, 200, len(there))
        at, score = topk.best_of(query, topk._remaining(query[:, None])[:, 0], there, topk._remaining(there),
                                 np.zeros(there.shape[1], bool), 3)
        whole = query @ there
        best = np.lexsort((np.arange(len(whole)), -whole))[:3]
        assert set(best) <= set(at) and (score == whole[at]).all()
