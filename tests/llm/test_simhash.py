from __future__ import annotations

import random

import numpy as np
import pytest

from aerostat.llm import simhash
from aerostat.llm.components import components

from . import brute
from .conftest import texts_of


def test_fingerprints(with_null_ids):
    got = sorted((str(r["doc_id"]), r["fp"] % (1 << 64)) for r in simhash.fingerprints(with_null_ids).collect())
    assert got == sorted((str(i), brute.fingerprint(t)) for i, t in texts_of(with_null_ids))


def test_components_of_documents(odd_docs):
    docs = dict(texts_of(odd_docs))
    want = brute.linked({i: brute.fingerprint(t) for i, t in docs.items()})
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["component_id"] == want[r["doc_id"]] for r in rows)
    assert all(len(r["fingerprint"]) == 16 for r in rows)


@pytest.mark.parametrize("tile", [3, 4096])
def test_tiles_lose_no_link(spark, tile):
    rng = random.Random(9)
    fps = {}
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(6):
            f = centre
            for _ in range(rng.randint(0, 4)):
                f ^= 1 << rng.randrange(64)
            fps[f] = f
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    links = simhash.links(spark.createDataFrame([(signed(f),) for f in fps], "fp long"), 3, tile)
    rows = components(links).collect()
    root = {r["node"] % (1 << 64): r["root"] for r in rows}
    want = brute.linked(fps)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    for members in groups.values():
        if len(members) > 1:
            assert len({root[m] for m in members}) == 1
        else:
            assert not members & root.keys()
    assert len(set(root.values())) == sum(len(m) > 1 for m in groups.values())


def test_forest_spans_a_dense_tile():
    a = np.arange(64, dtype=np.uint64)
    u, v = simhash.tile_links(a, a, 6)
    assert len(u) < 128 and set(u) | set(v) == set(a.tolist())


def test_chain_of_components(spark):
    n = 60
    order = list(range(n))
    random.Random(2).shuffle(order)
    rows = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {got[i] for i in range(n)} == {0} and got[1001] == got[1000] == 1000


def test_one_row_of_each_group_stays(with_null_ids):
    left = simhash.drop_near_duplicates(with_null_ids)
    assert left.columns == with_null_ids.columns
    docs = texts_of(with_null_ids)
    by_fp = {}
    for i, t in docs:
        by_fp.setdefault(brute.fingerprint(t), []).append((i is None, i or 0))
    heads = brute.linked({f: f for f in by_fp})
    first = {}
    for f, ids in by_fp.items():
        first[heads[f]] = min([first.get(heads[f], (True, 1 << 62)), *ids])
    assert sorted(str(i) for i, _ in texts_of(left)) == sorted(str(None if none else i) for none, i in first.values())


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.drop_near_duplicates(no_docs).collect() == []
