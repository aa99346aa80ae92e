"""Byte-level BPE by a global shuffle of distinct words.

Texts explode into pre-tokens with positions; each distinct pre-token of the
corpus is encoded once (``distinct_words``), its ids are joined back, and
every document is reassembled by position. Decoding joins the token-byte
table to the ids.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import press_texts, small_batches, tidied
from aerostat.llm.distinct_words import BUCKET, Piece, encoded_words

PIECE = 4 << 20  # text bytes of a piece, about

# The split pattern for which a faster equal form is known, and that form
# for texts that hold only ASCII and the letters of these Latin blocks.
KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_NARROW = re.compile(
    KNOWN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s0-9{_LETTERS}]").replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", "[0-9]"),
    re.ASCII).findall
_BEYOND = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ɏ]").search


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def _token_bytes(path: str) -> pa.Array:
    """The token-byte table: entry i holds the bytes of id i."""
    table = ranks(path)
    out: list[bytes | None] = [None] * (max(table.values()) + 1)
    for token, i in table.items():
        out[i] = token
    return pa.array(out, pa.large_binary())


def splitter(pattern: str):
    """Function that cuts a text into pre-tokens."""
    wide = regex.compile(pattern).findall
    if pattern != KNOWN:
        return wide
    return lambda text: wide(text) if _BEYOND(text) else _NARROW(text)


def _byte_splitter(pattern: str):
    split = splitter(pattern)
    return lambda raw: list(map(str.encode, split(raw.decode())))


def _word_encoder(path: str, pattern: str):
    known, encode = ranks(path), _encoding(path, pattern).encode_ordinary

    def run(words: list[str]) -> list[list[int]]:
        return [encode(w) if (one := known.get(w.encode())) is None else [one] for w in words]

    return run


def _reassemble(make_split, buckets: int, kind: type):
    result = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return result.empty_table()
        piece = Piece(docs, make_split(), buckets)
        ids, ends = piece.reassemble(words, kind)
        return pa.table([piece.ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))], schema=result)

    return run


def encode(docs: DataFrame, path: str, pattern: str = KNOWN, text: str = "text", doc_id: str = "doc_id",
           piece_bytes: int = PIECE) -> DataFrame:
    """Token ids of every whole text: ``doc_id``, ``ids``.

    ``path`` names a rank file, ``pattern`` cuts texts into pre-tokens, each
    of which is encoded by itself. There are no special tokens.

    Null and empty texts have no ids. Repeated rows and null document ids
    each get a row; an empty table gives none; a long text makes its piece
    as long as it is; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = np.uint16 if max(ranks(path).values()) < 1 << 16 else np.uint32
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("digest"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces, buckets = max(least, -(-total // piece_bytes)), max(least, -(-total // BUCKET))
    dealt = press_texts(rows.withColumn("piece", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(pieces)).cast("long")))
    split = partial(_byte_splitter, pattern)
    encoded = encoded_words(dealt, split, partial(_word_encoder, path, pattern), buckets, kind)
    return dealt.groupBy("piece").cogroup(encoded.groupBy("piece")).applyInArrow(
        tidied(_reassemble(split, buckets, kind)), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` (in place of a column of that name), the bytes of the ids in order (null ids: null).

    The token-byte table is as long as the vocabulary, whatever the input.
    An id outside of it fails the job.
    """
    tokens = tokens.drop("decoded")
    keep = tokens.schema

    def run(batches):
        table = _token_bytes(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for at in range(0, batch.num_rows, 512):
                rows, own = batch.slice(at, 512), column.slice(at, 512)
                ends = np.concatenate([[0], np.cumsum(own.value_lengths().fill_null(0).to_numpy())])
                found = table.take(own.flatten())
                if found.null_count:
                    raise ValueError("an id is not in the vocabulary")
                where = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
                decoded = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(own), [None, pa.py_buffer(where[ends].tobytes()), found.buffers()[2]])
                decoded = pa.array(decoded.to_pylist(), pa.binary(), mask=own.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*rows.columns, decoded], [*rows.schema.names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return tokens.mapInArrow(run, f"{kinds}, decoded binary")
