from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostat.llm.fill_in_middle import ExceptionIndex, fill_in_middle, restored

from .conftest import DOCS, texts_of

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, unit, rate=50, spm_rate=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    units = TOKEN.findall(text) if unit == "token" else list(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é日𝄞\n"), max_size=40))
def test_index(text):
    raw = text.encode()
    index = ExceptionIndex(np.frombuffer(raw, np.uint8))
    borders = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    points = np.arange(len(text) + 1)
    assert (index.to_points(borders) == points).all() and (index.to_bytes(points) == borders).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)  # nothing is recorded of ASCII


@pytest.mark.parametrize("unit", ["token", "character"])
@pytest.mark.parametrize("rate", [50, 100])
def test_documents(with_null_ids, spark, unit, rate):
    more = [(400 + i, t, None, None, None) for i, t in enumerate(
        ["a <P> b", "x<S", "<M>", " ", "a ", " a", "日本 語", "𝄞", "<S", "P> <", "\x1c\x85  one", "tab\tend\t"] * 3)]
    docs = with_null_ids.unionByName(spark.createDataFrame(more, DOCS), allowMissingColumns=True)
    rows = restored(fill_in_middle(docs, unit=unit, rate=rate)).collect()
    want = [brute(i, t, unit, rate) for i, t in texts_of(docs)]
    assert sorted(map(str, (tuple(r)[:6] for r in rows))) == sorted(map(str, want))
    assert sorted((str(r["doc_id"]), r["restored"]) for r in rows) == sorted((str(i), t or "") for i, t in texts_of(docs))
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_other_sentinels_and_types(spark):
    docs = spark.createDataFrame([("k(1)", "a.* (b) c d e f g h", 1)], "`my id` string, body string, n int")
    row = restored(fill_in_middle(docs, rate=100, sentinels=("(.*)", "[S]", "\\M"), text="body", doc_id="my id"),
                   ("(.*)", "[S]", "\\M")).first()
    assert row["form"] != "plain" and row["restored"] == "a.* (b) c d e f g h" and row["doc_id"] == "k(1)"


def test_a_long_text_is_cut_whole(spark):
    docs = spark.range(1).select(F.lit(5).cast("long").alias("doc_id"), F.repeat(F.lit("né 日本 plain "), 600_000).alias("text"))
    row = restored(fill_in_middle(docs, rate=100)).select("n", "prefix_chars", "middle_chars", F.md5("output").alias("o"),
                                                          F.md5("restored").alias("r")).first()
    text = "né 日本 plain " * 600_000
    _, n, form, prefix, middle, out = brute(5, text, "token", 100)
    assert (row["n"], row["prefix_chars"], row["middle_chars"]) == (n, prefix, middle)
    assert (row["o"], row["r"]) == (hashlib.md5(out.encode()).hexdigest(), hashlib.md5(text.encode()).hexdigest())


def test_empty(no_docs):
    assert restored(fill_in_middle(no_docs)).collect() == []
