from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerostat.llm.common import staged
from aerostat.llm.mixing import mix_documents
from aerostat.llm.queries import ORACLE_SQL, QUERIES, table

from . import brute
from .conftest import SF, texts_of


def test_thirteen_queries_and_five_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_a_table(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    near = corpus_pipeline.near_dedup(spark, docs, SF)
    have = dict(texts_of(docs))
    root = brute.linked({i: brute.fingerprint(t) for i, t in have.items()})
    assert {i for i, _ in texts_of(near)} == {i for i in have if root[i] == i}
    cut = {r["doc_id"]: r for r in corpus_pipeline.repeat_dedup(spark, near, SF).collect()}
    for i, (_, _, _, kept) in brute.cut(texts_of(near), 50).items():
        # bytes of a character that was split go with it
        assert cut[i]["text"] == kept.decode(errors="ignore") and cut[i]["n_chars"] == len(cut[i]["text"])


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = table(spark, SF, "documents")
    assert rows and {r["doc_id"] for r in rows} <= {i for i, _ in texts_of(docs)}
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_last_stage_decodes_what_it_got(spark, odd_docs):
    mixed = mix_documents(odd_docs)
    want = sorted((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts_of(mixed))
    got = corpus_pipeline.bpe(spark, mixed, SF).collect()
    assert sorted((r["doc_id"], r["decoded_sha256"]) for r in got) == want


@pytest.fixture(scope="module")
def odd_table(with_null_ids, spark, tmp_path_factory):
    """A folder whose documents have null ids and texts, repeats, and columns of all sorts of names."""
    folder = str(tmp_path_factory.mktemp("odd"))
    odd = with_null_ids
    for name in ("row", "row_key", "__row_key", "__mix_key", "copy", "others", "carried", "kept", "a.b", "with space"):
        odd = odd.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    odd = odd.withColumn("a list", F.array(F.lit(1), F.col("doc_id"))).withColumn("map", F.create_map(F.lit("k"), F.col("doc_id")))
    odd.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_leave_other_columns_alone(spark, odd_table):
    docs = table(spark, odd_table, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, odd_table), name)
        rows = docs.collect()
        assert docs.columns == table(spark, odd_table, "documents").columns and rows, name
        for r in rows:
            own = "none" if r["doc_id"] is None else str(r["doc_id"])
            assert all(r[c] == f"{c} of {own}" for c in ("row", "__row_key", "__mix_key", "copy", "others", "carried", "a.b", "with space"))
            assert r["map"] == {"k": r["doc_id"]} and r["a list"] == [1, r["doc_id"]]


def test_run_on_the_odd_table(spark, odd_table):
    rows = corpus_pipeline.run(spark, odd_table).collect()
    known = {r["doc_id"] for r in table(spark, odd_table, "documents").collect()}
    assert rows and {r["doc_id"] for r in rows} <= known and None in {r["doc_id"] for r in rows}
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_one_defined_row_of_repeats_stays(spark):
    rows = [(1, "a b c d e f", s) for s in ("z", "y", None, "x")] * 3 + [(2, "something else entirely, so far away", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for some in (docs, docs.orderBy("source").coalesce(1)):
        got = corpus_pipeline.near_dedup(spark, some, SF).collect()
        # a field that is null is left out, so the row without a source is the least as text
        assert sorted((r["doc_id"], r["source"]) for r in got) == [(1, "x"), (2, "q")]


def test_empty_table(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).collect() == []
