from __future__ import annotations

import random
from collections import defaultdict
from itertools import permutations

import pytest

from aerostat.llm import filter_audit
from aerostat.llm.copies import with_group_value
from pyspark.sql import functions as F

from .brute import words
from .conftest import DOCS


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    parts = defaultdict(list)
    for i, t, s in docs:
        t = t or ""
        w = words(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and least[t] < i}
        parts[s or ""].append((i, {f for f, bad in fails.items() if bad}))
    out = set()
    for part, own in parts.items():
        removed_at = defaultdict(int)
        rows = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_at[f] += len(gone)
                rows.append([part, "".join(order), step, len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                             sum(d[1] == {f} for d in own), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f])
        out |= {(*r[:-1], removed_at[r[-1]]) for r in rows}
    return out


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.fixture(scope="module")
def more_docs(with_null_ids, spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(700)] + ["ABC", "#x", "a|b", "DEF"]
    rows = []
    for i in range(160):
        few = rng.random() < 0.3
        text = " ".join(rng.choice(vocabulary[:20] if few else vocabulary[:rng.choice([700, 703, 704])]) for _ in range(rng.choice([50, 210, 400])))
        rows.append((1000 + i, text, "en", rng.choice(["src0", "src1", None, ""]), 0))
    rows += [(2000 + i, rows[i % 7][1], "en", "src1", 0) for i in range(90)]  # copies, one group above the bound for hot ones
    rows += [(3000 + i, rows[0][1], "en", "src0", 0) for i in range(80)]
    return with_null_ids.unionByName(spark.createDataFrame(rows, DOCS), allowMissingColumns=True)


def test_documents(more_docs, spark):
    rng = random.Random(4)
    ids = [r["doc_id"] for r in more_docs.select("doc_id").collect()]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in ids if rng.random() < 0.6]
    labels += [(ids[0], 1, 0), (ids[0], 0, 1), (None, 1, 1), (99_999, 1, 1)]
    got = filter_audit.audit_documents(more_docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    docs = [tuple(r) for r in more_docs.select("doc_id", "text", "source").collect()]
    rows = got.select(*COLUMNS).collect()
    assert len(rows) == 600 * len({d[2] or "" for d in docs})
    assert {tuple(r) for r in rows} == brute(docs, labels)
    assert all(any(r[c] for r in rows) for c in COLUMNS[3:])


def test_fields_do_not_carry(spark):
    many = 1 << 60
    rows = spark.createDataFrame([("p", True, True, many), ("p", True, False, 3), ("p", False, True, many), (None, None, None, 5)],
                                 "part string, x boolean, y boolean, n long")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in filter_audit.audit(rows, "xy", ["y"], n="n").collect()}
    xy = [got["p", "xy", s] for s in (1, 2)]
    assert [r["removed"] for r in xy] == [many + 3, many] and xy[1]["kept"] == 0 and xy[1]["redundant"] == many
    assert [r["y_lost"] for r in xy] == [many, many] and [r["unique_fails"] for r in xy] == [3, many]
    assert [r["shapley"] for r in xy] == [many + 6, 3 * many] and [got["", "yx", s]["kept"] for s in (1, 2)] == [5, 5]


def test_packed_masks_hold_one_step_an_order():
    packed = filter_audit.packed_masks(5)
    assert len(packed) == 32 and packed[0] == 0
    for mask in range(1, 32):
        removed = filter_audit.unpacked(packed[mask], 5)
        assert removed.shape == (120, 5) and (removed.sum(axis=1) == 1).all()


def test_many_parts_in_a_task(spark, monkeypatch):
    rows = spark.range(40).select((F.col("id") % 20).cast("string").alias("part"), (F.col("id") % 3 == 0).alias("x"))
    monkeypatch.setattr(filter_audit, "PARTS", 3)
    got = filter_audit.audit(rows.coalesce(1), "x").groupBy().agg(F.sum("removed"), F.sum("kept"), F.count("*")).first()
    assert tuple(got) == (14, 26, 20)


def test_words_across_steps():
    text = b"  aa bb\taa\ncc dd " * 9
    assert all(filter_audit.word_numbers(text, step) == (45, 4) for step in (1, 2, 5, 1 << 20))


def test_group_values_of_hot_and_cold_keys(spark):
    rows = [(i, k) for i, k in enumerate(["a"] * 90 + ["b"] * 5 + ["c", None, None])]
    got = with_group_value(spark.createDataFrame(rows, "id long, k string"), "k", F.max("id"), "top", least=10).collect()
    assert sorted((r["id"], r["top"]) for r in got) == [(i, {"a": 89, "b": 94}.get(k)) for i, k in rows]


def test_empty(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(no_docs, labels).collect() == []
    with pytest.raises(ValueError):
        filter_audit.audit(no_docs, "ABCDEFG")
