from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from aerostat.llm.common import utf8
from aerostat.llm.quality import RepetitionRules, measure, repetition_quality

from . import brute
from .conftest import texts_of


def test_measures(with_null_ids):
    rows = repetition_quality(with_null_ids).collect()
    texts = {}
    for i, t in texts_of(with_null_ids):
        texts.setdefault(i, []).append(t)
    assert len(rows) == sum(map(len, texts.values()))
    for r in rows:
        wants = [brute.repetition(t) for t in texts[r["doc_id"]]]
        assert any(all(r[c] == v for c, v in w.items()) for w in wants), r["doc_id"]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_verdict():
    clean = " ".join(f"word{i}" for i in range(200))
    repeated = clean + "\n" + " ".join(["buy this very good thing now today"] * 12)
    lines = "\n".join([" ".join(f"w{i}x{j}" for i in range(12)) for j in range(10)] + ["the same line again, as before"] * 12)
    junk = " ".join(f"word{i}###" for i in range(100))
    got = measure(*utf8(pa.array([clean, repeated, lines, junk, None, "short text"])), RepetitionRules())
    assert got["kept"].tolist() == [True, False, False, False, False, False]


def test_empty(no_docs):
    assert repetition_quality(no_docs).collect() == []


def test_range_hashes_across_chunks(monkeypatch):
    from aerostat.llm import common

    rng = np.random.default_rng(3)
    data = rng.integers(0, 4, 900).astype(np.uint8)
    cuts = np.sort(rng.choice(900, 120, replace=False))
    start, end = cuts[::2], cuts[1::2]
    whole = common.range_hashes(data, start, end)
    by_bytes = {}
    for s, e, h in zip(start, end, whole):
        assert by_bytes.setdefault(data[s:e].tobytes(), h) == h
    assert len(set(by_bytes.values())) == len(by_bytes)
    for size in (1, 7, 64, 899):
        monkeypatch.setattr(common, "_CHUNK", size)
        common._chunk_powers.cache_clear()
        assert (common.range_hashes(data, start, end) == whole).all()
    common._chunk_powers.cache_clear()


def test_a_long_text_takes_bounded_memory():
    rng = np.random.default_rng(4)
    words = [bytes(w) for w in rng.integers(97, 123, (50_000, 6)).astype(np.uint8)]
    data = np.frombuffer(b" ".join(words[i] for i in rng.integers(0, 50_000, 1_200_000)), np.uint8)
    tracemalloc.start()
    measure(data, np.array([0, len(data)]), RepetitionRules())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 24 * len(data)
