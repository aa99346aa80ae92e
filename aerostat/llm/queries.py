"""Queries of the operators on the test tables, and their SQL where there is one."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat.llm.byte_bpe import decode, encode
from aerostat.llm.fill_in_middle import FIM_SQL, fill_in_middle, restored
from aerostat.llm.filter_audit import AUDIT_SQL, audit_documents
from aerostat.llm.katz import score_texts
from aerostat.llm.mixing import MIX_SQL, mix_sources
from aerostat.llm.quality import quality_sql, repetition_quality
from aerostat.llm.sharding import shard_documents
from aerostat.llm.simhash import near_duplicates
from aerostat.llm.suffix_dedup import REPEATS_SQL, remove_repeats
from aerostat.llm.token_files import read_token_files, write_token_files
from aerostat.llm.topk import TOP_K_SQL, top_k
from aerostat.llm.toxicity import score_toxicity, train
from aerostat.llm.warc import WARC_SQL, read_warc, write_warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) == 2, order=3)


def repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_quality(table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 3) != 1)
    return score_toxicity(docs, model).withColumn("held_out", id_remainder("doc_id", 3) == 1)


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), length=3, radius=3)


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Ids and decoded bytes of each document as digests."""
    whole = decode(encode(docs, path, public_tokenizers.PATTERN), path)
    return whole.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=16)


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    root, manifest = write_token_files(table(spark, sf_dir, "documents"), path, end=1)

    def digests(batches):
        for b in batches:
            ids = b.column("ids")
            ends = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(np.diff(ends).astype(np.int64)),
                                              pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_token_files(root, manifest).mapInArrow(
        digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fill_in_the_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = restored(fill_in_middle(table(spark, sf_dir, "documents"), unit="token", rate=50, spm_rate=80, seed=42))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(spark, root, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_katz_scores": lm_scores,
    "op2_repetition_rules": repetition_rules,
    "op3_toxicity": toxicity,
    "op4_exact_top_k": exact_top_k,
    "op5_simhash": simhash,
    "op6_byte_bpe": byte_bpe,
    "op7_suffix_dedup": suffix_dedup,
    "op8_sharding": sharding,
    "op9_mixing": mixing,
    "op10_token_files": token_files,
    "op11_fill_in_middle": fill_in_the_middle,
    "op12_warc_archive": warc_archive,
    "op13_filter_audit": filter_interactions,
}

ORACLE_SQL = {
    "op2_repetition_rules": quality_sql(),
    "op7_suffix_dedup": REPEATS_SQL,
    "op4_exact_top_k": TOP_K_SQL,
    "op9_mixing": MIX_SQL,
    "op11_fill_in_middle": FIM_SQL,
    "op12_warc_archive": WARC_SQL,
    "op13_filter_audit": AUDIT_SQL,
}
