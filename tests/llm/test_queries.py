"""Registered queries against their SQL."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
import tiktoken

from aerostat.llm.katz import score_texts
from aerostat.llm.queries import ORACLE_SQL, QUERIES, id_remainder

from . import brute
from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_answers_for_every_row(spark, name):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_katz_query_is_a_model_of_three_words(spark):
    scores = lambda df: {r["doc_id"]: pytest.approx(r["score"], rel=1e-9) for r in df.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    three, two = (scores(score_texts(docs, id_remainder("doc_id", 7) == 2, order)) for order in (3, 2))
    got = {r["doc_id"]: r["score"] for r in QUERIES["op1_katz_scores"](spark, SF).collect()}
    assert got == three and got != two


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_byte_bpe_query_is_the_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha256 = lambda raw: hashlib.sha256(raw).hexdigest()
    want = {}
    for i, t in documents(spark).items():
        ids = library.encode_ordinary(t)
        want[i] = (len(ids), sha256(",".join(map(str, ids)).encode()), sha256(t.encode()))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op6_byte_bpe"](spark, SF).collect()}
    assert got == want


def test_simhash_query_is_the_plain_one(spark):
    fps = {i: brute.fingerprint(t) for i, t in documents(spark).items()}
    root = brute.linked(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op5_simhash"](spark, SF).collect()}
    assert got == {i: (f"{fp:016x}", root[i]) for i, fp in fps.items()}


def test_sharding_query_cuts_where_the_plain_one_does(spark):
    docs = documents(spark)
    size, sums = {i: len(t.encode()) + 1 for i, t in docs.items()}, defaultdict(int)
    group = {i: hashlib.md5(t.encode()).hexdigest() for i, t in docs.items()}
    for i, g in group.items():
        sums[g] += size[i]

    def cut(capacity):
        shard, held, out = 0, 0, {}
        for g in sorted(sums):
            if held + sums[g] > capacity:
                shard, held = shard + 1, 0
            held += sums[g]
            out[g] = shard
        return out if shard < 16 and max(sums.values()) <= capacity else None

    capacity = max(-(-sum(sums.values()) // 16), max(sums.values()))
    while not cut(capacity):
        capacity += 1
    rows = QUERIES["op8_sharding"](spark, SF).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"]) for r in rows} == {
        i: (size[i], zlib.crc32(t.encode()), cut(capacity)[group[i]]) for i, t in docs.items()}
    for s in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
