from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from aerostat.llm.mixing import mix_documents, mix_sources, targets

from . import brute
from .conftest import texts_of


def test_targets_share_all_words():
    t = targets({"b": 100, "a": 10, None: 50, "c": 0})
    assert t["c"] == 0 and t["a"] == 30.0  # at three times its size
    assert sum(t.values()) == pytest.approx(160)
    assert t["b"] / t[None] == pytest.approx(2)  # weights 2 and 1: a, b, c, null weigh 1, 2, 3, 1
    assert targets({}) == {} and targets({None: 0}) == {None: 0.0}


def expected(docs):
    size = defaultdict(int)
    rows = []
    for i, t, s in docs:
        n = len(brute.words(t))
        size[s] += n
        rows.append((i, s, n, hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()))
    aim = targets(dict(size))
    out = []
    for s in size:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: r[3])
        whole = int(aim[s] // size[s]) if size[s] else 0
        rest = aim[s] - whole * size[s] if whole < 3 else 0
        upto = 0
        for r in own:
            more = rest > 0 and 2 * upto + r[2] < 2 * rest
            upto += r[2]
            out.append((r[0], r[2], size[s], round(aim[s], 6), r[2] * (whole + more)))
    return Counter(out)


def test_documents(with_null_ids):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in with_null_ids.select("doc_id", "text", "source").collect()]
    got = mix_sources(with_null_ids).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got) == expected(docs)


def test_equal_rows_come_near_the_target(spark):
    rows = [(1, "a b c d", "x")] * 10 + [(2, "e f g h i j", "y")] * 31 + [(3, "k", "y"), (4, "l m", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mix_sources(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got) == expected(rows)
    for source in (1, 2):
        own = [r for r in got if r["doc_id"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 4


def test_rows_of_the_mix(odd_docs):
    taken = Counter()
    for r in mix_sources(odd_docs).where("size > 0").collect():
        taken[r["doc_id"]] += r["taken"] // r["size"]
    rows = mix_documents(odd_docs)
    assert rows.columns == odd_docs.columns
    have = Counter(r["doc_id"] for r in rows.collect() if brute.words(r["text"]))
    assert have == +taken
    assert set(texts_of(rows)) <= set(texts_of(odd_docs))


def test_empty(no_docs):
    assert mix_sources(no_docs).collect() == [] and mix_documents(no_docs).collect() == []
