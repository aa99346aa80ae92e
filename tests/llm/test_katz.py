from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from pyspark.sql import functions as F

from aerostat.llm.katz import Deal, _emit, _total, _unpack_counts, discounts, numbered, score_texts
from aerostat.llm.queries import id_remainder

from . import brute
from .conftest import texts_of

END = "\0end"


def tokens(text):
    return brute.words(brute.ascii_lower(text)) + [END]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_a_recursive_model(with_null_ids, order):
    docs = texts_of(with_null_ids)
    model = brute.Katz([tokens(t) for i, t in docs if brute.remainder(i, 7) != 2], order, discounts)
    types = len(model.counts[1])
    want = []
    for i, t in docs:
        own = tokens(t)
        base = sum(math.log10((model.counts[1][(w,)] + 1) / (model.tokens + types + 1)) for w in own)
        want.append((str(i), brute.remainder(i, 7) == 2, len(own), sum(model.counts[1][(w,)] > 0 for w in own), model.tokens,
                     round(base, 6), round(model.score(own), 6)))
    got = score_texts(with_null_ids, id_remainder("doc_id", 7) == 2, order, piece_bytes=500).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6), round(r["score"], 6)) for r in got) == sorted(want)


def test_probabilities_sum_to_one(odd_docs):
    texts = [tokens(t) for i, t in texts_of(odd_docs)]
    model = brute.Katz(texts, 3, discounts)
    words = [g[0] for g in model.counts[1]] + ["never seen"]
    for context in [("the",), ("of", "the"), (END,), ("never seen",), (texts[0][0], texts[0][1])]:
        if len(context) < 3:
            assert sum(model.p((*context, w)) for w in words) == pytest.approx(1, abs=1e-9)


def test_discounts():
    d = discounts([100, 40, 20, 12, 8, 6])
    assert all(0 < x < 1 for x in d)
    assert discounts([10, 0, 0, 0, 0, 0]) == [0.5, 0.75, pytest.approx(5 / 6), 0.875, 0.9]
    assert discounts([0] * 6)[0] == 0.5


def test_full_contexts_leave_something(spark):
    """A context seen often, always with one word, still allows another."""
    rows = [(i, "always here") for i in range(12)] + [(100, "always there"), (101, "always new")]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") > 50).collect()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_no_training_rows_and_empty(odd_docs, no_docs):
    got = score_texts(odd_docs.where("doc_id < 5"), F.lit(None).cast("boolean")).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == 0 and r["held_out"] for r in got)
    assert score_texts(no_docs, F.lit(False)).collect() == []


@pytest.mark.parametrize("buckets", [1, 3, 51, 1 << 16, 100_003, 3 << 30])
def test_buckets_are_ranges_without_an_upper_limit(buckets):
    """Every digest is in one bucket, in order, and its key there has 48 bits at most."""
    deal = Deal(buckets)
    edge = np.array([0, 1, (1 << 64) - 1], np.uint64)
    keys = np.unique(deal.keys(np.concatenate([edge, np.random.default_rng(1).integers(0, 1 << 64, 20_000, np.uint64)])))
    at, last = 0, -1
    for bucket, start, end in deal.stretches(keys):
        assert start == at and last < bucket < buckets
        assert int(keys[end - 1]) - bucket * deal.width < min(deal.width, 1 << 48)
        at, last = end, bucket
    assert at == len(keys)
    assert deal.bits == 64 if buckets >= 1 << 16 else deal.bits < 64


@pytest.mark.parametrize("buckets", [2, 70_000, 1 << 40])
def test_counts_by_many_buckets(buckets):
    """The counts that the buckets total, however many these are, are those of the n-grams."""
    texts = [["a b a b c", "b c"], ["a b", "c a b"]]
    press = zstandard.ZstdCompressor().compress
    sent = pa.concat_tables(_emit(3, buckets)(pa.table({
        "doc_id": [10 * n + i for i in range(len(own))], "held_out": [False] * len(own), "text": [press(t.encode()) for t in own],
        "digest": list(range(len(own))), "piece": [n] * len(own)})) for n, own in enumerate(texts))
    for m in (1, 2, 3):
        want = Counter(g for own in texts for t in own for g in zip(*[tokens(t)[i:] for i in range(m)]))
        own = sent.filter(pc.equal(sent["n"], m))
        stats, replies = [], {}
        for bucket in own["bucket"].unique().to_pylist():
            for r in _total(own.filter(pc.equal(own["bucket"], bucket))).to_pylist():
                if r["stats"]:
                    stats.append(r["stats"])
                else:
                    replies[r["piece"], bucket] = r["totals"]
        assert [sum(x) for x in zip(*stats)][-2:] == [len(want), sum(want.values())]
        for n, texts_of_piece in enumerate(texts):
            grams = {g for t in texts_of_piece for g in zip(*[tokens(t)[i:] for i in range(m)])}
            sizes = {(r["piece"], r["bucket"]): int.from_bytes(r["keys"][:8], "little") for r in own.to_pylist()}
            got = [int(c) for (piece, b), raw in replies.items() if piece == n for c in _unpack_counts(raw, sizes[piece, b])]
            assert sorted(got) == sorted(want[g] for g in grams)


@pytest.mark.parametrize("bits", [3, 48, 53, 64])
@pytest.mark.parametrize("n", [0, 1, 2, 1000, 5000])
def test_numbers_of_keys(bits, n):
    """Also of keys that differ in their lowest bits only."""
    rng = np.random.default_rng(n)
    for keys in (rng.integers(0, 1 << bits, n, np.uint64), rng.integers(0, 7, n, np.uint64),
                 np.uint64((1 << bits) - 1) - rng.integers(0, 8, n, np.uint64)):
        want, first, number = np.unique(keys, return_index=True, return_inverse=True)
        for got, right in zip(numbered(keys, bits), (want, number, first)):
            assert got.tolist() == right.tolist()
