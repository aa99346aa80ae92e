from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from aerostat.llm.queries import QUERIES, id_remainder, table
from aerostat.llm.toxicity import (Model, document_evidence, drop_toxic, maximal_segments, probability, score_toxicity,
                                   significant, tail, tokens, train)

from .conftest import SF


def brute_segments(values):
    """All maximal segments, by the recursive definition: take the best one, then both sides."""
    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += values[j]
                # the largest score; of these the shortest, of these the first
                if total > 1e-12 and (top is None or total > top[0] + 1e-9):
                    top = (total, i, j)
        return [] if top is None else best(lo, top[1]) + [(top[1], top[2], top[0])] + best(top[2] + 1, hi)
    return best(0, len(values))


def test_linear_scan_finds_all_maximal_segments():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 14)
        weight = {i: rng.choice([3.1, 1.7, 0.9, -2.3]) + rng.random() * 0.01 for i in range(n) if rng.random() < 0.6}
        drift = rng.choice([0.11, 0.53])
        values = [weight.get(i, 0.0) - drift for i in range(n)]
        got = maximal_segments(sorted(weight.items()), drift)
        # segments may be padded by nothing: both start and end on a positive token
        assert [(a, b, round(s, 6)) for a, b, s in got] == [(a, b, round(s, 6)) for a, b, s in brute_segments(values)]


def test_tail_is_a_probability():
    assert tail(-100) == 1 and 0 < tail(20) < 1e-8 and tail(0) == pytest.approx(0.632, abs=1e-3)


def test_passages():
    model = Model({"scum": 3.0, "idio ": 2.0}, drift=0.1, scale=0.3, place=0.2)
    text = tokens("plain words first, then you Scum! idiots, and plain words again")
    (first, last, score, p), = significant(text, model)
    assert (first, last) == (5, 6) and score == pytest.approx(4.8) and p < 0.05
    assert document_evidence(tokens("plain words"), model) == 0
    assert probability(text, model) > probability([], model)


@pytest.fixture(scope="module")
def trained(spark):
    sf = SF.replace("0.001", "0.01")
    docs = table(spark, sf, "documents")
    return docs, table(spark, sf, "labels"), train(docs, table(spark, sf, "labels"), id_remainder("doc_id", 3) != 1)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    held = score_toxicity(docs, model).join(labels, "doc_id").where(id_remainder("doc_id", 3) == 1)
    hit, clean_hit, toxic, clean = held.agg(
        F.sum(F.col("toxic") * F.col("predicted")), F.sum((1 - F.col("toxic")) * F.col("predicted")),
        F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    assert hit >= 0.7 * toxic and clean_hit <= 0.02 * clean


def test_odd_rows(trained, with_null_ids, no_docs):
    _, _, model = trained
    rows = score_toxicity(with_null_ids, model, spans=True).collect()
    assert len(rows) == with_null_ids.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    left = drop_toxic(with_null_ids, model)
    assert left.columns == with_null_ids.columns and left.count() == sum(1 - r["predicted"] for r in rows)
    assert score_toxicity(no_docs, model).collect() == [] and drop_toxic(no_docs, model).collect() == []


def test_no_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = train(odd_docs, none, F.lit(True))
    assert score_toxicity(odd_docs, model).where("predicted = 1").count() == 0


def test_labels_are_no_input(spark):
    rows = QUERIES["op3_toxicity"](spark, SF)
    assert set(rows.columns) == {"doc_id", "held_out", "score", "predicted"}
