"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written
as Parquet and reread as the next stage's documents. Stages 1 to 4 return
the columns of the documents, whatever these are besides doc_id, text,
source and n_chars:

1. toxicity: documents that the segment search predicts toxic go;
2. SimHash near-dedup: of each group the smallest id stays;
3. suffix-array dedup: repeated runs of 50 bytes and more go, except where
   they stand in the document with the smallest id; a text of which nothing
   is left stays as an empty document;
4. mixing: documents are taken as often as the mix takes them, up to three
   times, or not at all;
5. byte-level BPE: ids of every text, and the text decoded from them.

Null texts count as empty, null ids are ids of their own kind (see the
operators), rows that repeat id and text are one document from stage 2 on,
and an empty table passes through. Columns may have any names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat.llm.byte_bpe import decode, encode
from aerostat.llm.common import staged
from aerostat.llm.mixing import mix_documents
from aerostat.llm.queries import id_remainder, table
from aerostat.llm.simhash import drop_near_duplicates
from aerostat.llm.suffix_dedup import remove_repeats
from aerostat.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the labelled ones."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 3) != 1))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (three-word shingles, three bits)."""
    return drop_near_duplicates(docs, length=3, radius=3)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands in a document with a smaller id, by runs of 50 bytes; ``n_chars`` follows."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = remove_repeats(docs, length=50, whole_characters=True, keep=others)
    new = {"text": F.col("kept").cast("string"), "n_chars": F.char_length(F.col("kept").cast("string")).cast("long"),
           "doc_id": F.col("doc_id"), **{c: F.col("carried")[c] for c in others}}
    return cut.select(*[new[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mix_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and a digest of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    whole = decode(encode(docs, path, public_tokenizers.PATTERN), path)
    return whole.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_dedup),
    ("mixing", mixing),
    ("byte_bpe", bpe),
]

ORACLE_SQL = None  # SQL cannot express the model, the suffix arrays or the merges


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
