from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from aerostat.llm import suffix_dedup
from aerostat.llm.suffix_dedup import remove_repeats

from . import brute
from .conftest import texts_of


def check(df, length, **more):
    docs = texts_of(df)
    assert len({i for i, _ in docs}) == len(docs)
    want = brute.cut(docs, length)
    rows = remove_repeats(df, length, **more).collect()
    assert {r["doc_id"]: (r["n_bytes"], sum(e - s for s, e in zip(r["starts"], r["ends"])), len(r["starts"]), bytes(r["kept"]))
            for r in rows} == want


def test_documents(odd_docs):
    check(odd_docs.where("doc_id NOT IN (7, 303)"), 50)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_in_many_shards(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(suffix_dedup, "STEP", rng.choice([64, 1 << 20]))
    monkeypatch.setattr(suffix_dedup.least_ids, "__defaults__", (rng.choice([150, 1 << 20]),))
    letters = ["ab", "a", "é", "xyz ", "\n", "\0"] if seed % 2 else ["a", "b"]
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 50))) for _ in range(5)]
    rows = [(i * 7 % 60, "".join(rng.choice(passages) if rng.random() < 0.3 else rng.choice(letters)
                                 for _ in range(rng.randint(0, 25)))) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 20, gram=8, piece_bytes=300)


def common_phrase(n):
    """Texts that share a phrase in surroundings of their own, and some of them these, too."""
    rng = random.Random(n)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(60)) + " all rights reserved by the owners " +
             "".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(n)]
    return [(i, texts[i if i % 5 else i // 2]) for i in range(n)]


@pytest.mark.parametrize("hot", [1, 20, 150])
def test_hot_anchors(spark, hot):
    check(spark.createDataFrame(common_phrase(200), "doc_id long, text string"), 50, piece_bytes=2000, hot=hot)


def test_a_hot_anchor_goes_to_many_buckets():
    rows, buckets = common_phrase(400), 16
    pieces = [pa.table({"piece": pa.array([k] * len(own), pa.int64()), "doc_id": pa.array([i for i, _ in own], pa.int64()),
                        "text": [suffix_dedup.pressed(t.encode()) for _, t in own], "digest": pa.array([i for i, _ in own], pa.int64())})
              for k, own in enumerate(rows[k::8] for k in range(8))]
    anchors = pa.concat_tables([suffix_dedup._emit_anchors(50, 24, buckets)(p) for p in pieces])

    def load(hot):
        """Windows of the fullest bucket over those of all."""
        masks = pa.concat_tables([suffix_dedup._shared(hot)(anchors.filter(pa.compute.equal(anchors["bucket"], b)))
                                  for b in range(buckets)])
        sent = pa.concat_tables([suffix_dedup._emit_segments(50, 24, buckets)(
            p, masks.filter(pa.compute.equal(masks["piece"], k))) for k, p in enumerate(pieces)])
        size = np.zeros(buckets)
        for b, w in zip(sent["bucket"].to_pylist(), sent["windows"].to_pylist()):
            size[b] += np.frombuffer(suffix_dedup.unpressed(w), np.uint32).sum()
        return size.max() / size.sum()

    assert load(1 << 15) > 0.2 and load(50) < 0.15


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(4)
    for _ in range(20):
        text = rng.integers(97, 99, rng.integers(10, 200)).astype(np.uint8)
        n, raw = len(text), text.tobytes()
        data = np.concatenate([text, np.zeros(32, np.uint8)])
        rank = suffix_dedup.suffix_ranks(data, n, 32)
        order = np.argsort(rank)
        heads = [data[i:i + 32].tobytes() for i in order]
        assert heads == sorted(heads)
        before = np.full(n, -1, np.int64)
        before[order[1:]] = order[:-1]
        cut = np.sort(rng.choice(n, 3, replace=False))
        start = np.unique(np.concatenate([[0], cut]))
        lcp = suffix_dedup.common_prefixes(data, start, np.diff(np.append(start, n)), before, 32)
        padded = raw + bytes(64)
        for i in range(n):
            j, k = before[i], 0
            while j >= 0 and k < 32 and padded[i + k] == padded[j + k]:
                k += 1
            assert lcp[i] == k


def test_shards_merge_to_the_smallest_id():
    a = (np.array([b"ab", b"cd"], "S2"), np.array([5, 9]), None)
    b = (np.array([b"cd", b"zz"], "S2"), np.array([3, 1]), None)
    assert [x.tolist() for x in suffix_dedup.merge_shards([a, b])] == [[5, 3], [3, 1]]


@pytest.mark.parametrize("length, gram", [(300, 8), (8, 8), (400, 24)])
def test_other_lengths(spark, length, gram):
    rng = random.Random(length)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(i, passage[rng.randrange(300):] + "".join(rng.choice("xyz") for _ in range(40)) + passage[:rng.randrange(500)])
            for i in range(8)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), length, gram=gram)


def test_anchors_fit_into_windows(no_docs):
    for gram in (7, 51):
        with pytest.raises(ValueError):
            remove_repeats(no_docs, 50, gram=gram)


def test_equal_ids_and_null_ids(spark):
    long = "one passage that is longer than fifty bytes, certainly it is " * 2
    rows = [(5, long), (5, long), (None, long), (None, long + "x"), (2, "x" + long[:-30])]
    got = sorted((str(r["doc_id"]), len(r["kept"])) for r in remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    only = len(rows[4][1])
    assert got[0] == ("2", only)
    # what the smallest id holds goes from the rest; rows with one id, or none, spare each other
    assert len({n for i, n in got if i == "5"}) == 1 and all(n < len(long) for i, n in got if i != "2")


def test_characters_stay_whole(spark):
    rows = [(1, "é" * 40 + "."), (2, "ab" + "é" * 40 + "!"), (3, "日本語" * 30), (4, "x日本語" * 9 + "日本語" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS kept", "doc_id AS piece")
    got = remove_repeats(df, whole_characters=True, keep=["kept", "piece"]).collect()
    for r in got:
        bytes(r["kept"]).decode()
        assert r["carried"]["kept"] == "c" and r["carried"]["piece"] == r["doc_id"]
    assert {r["doc_id"]: bytes(r["kept"]).decode() for r in got}[2] == "ab!"


def test_empty(no_docs):
    assert remove_repeats(no_docs).collect() == []
