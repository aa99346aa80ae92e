from __future__ import annotations

import base64

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from aerostat.llm import distinct_words
from aerostat.llm.byte_bpe import KNOWN, _byte_splitter, decode, encode, splitter

from .conftest import SF, texts_of

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_known_one():
    assert public_tokenizers.PATTERN == KNOWN


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Z9é ßÿ×½\n\t\r\x0b\x1c\x1f\x85 'stld日ª.,!"), max_size=30))
def test_narrow_pattern_splits_alike(text):
    import regex

    assert splitter(KNOWN)(text) == regex.findall(KNOWN, text)


def test_ids_and_round_trip(with_null_ids, library):
    rows = decode(encode(with_null_ids, PATH, public_tokenizers.PATTERN), PATH).collect()
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts_of(with_null_ids))
    assert sorted((str(r["doc_id"]), list(r["ids"]), bytes(r["decoded"])) for r in rows) == want


def test_small_pieces_and_another_pattern(odd_docs):
    some = odd_docs.where("doc_id < 20")
    pattern = r"\S+|\s+"
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = encode(some, PATH, pattern, piece_bytes=64).collect()
    assert sorted((r["doc_id"], list(r["ids"])) for r in rows) == sorted(
        (i, own.encode_ordinary(t)) for i, t in texts_of(some))


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, [0, 1]), (2, []), (3, None)], "n int, ids array<int>")
    got = {r["n"]: r["decoded"] for r in decode(df, PATH).collect()}
    assert got[2] == b"" and got[3] is None and len(got[1]) >= 2
    with pytest.raises(Exception):
        decode(spark.createDataFrame([([999_999],)], "ids array<int>"), PATH).collect()


def test_empty(no_docs):
    assert decode(encode(no_docs, PATH), PATH).collect() == []


def test_what_a_piece_sends_grows_little_with_the_buckets(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL").collect()]
    press = zstandard.ZstdCompressor(level=1).compress
    piece = pa.table({"doc_id": list(range(len(texts))), "text": pa.array([press(t.encode()) for t in texts], pa.binary()),
                      "digest": list(range(len(texts))), "piece": [0] * len(texts)})
    total = sum(len(t.encode()) for t in texts)

    def sent(buckets):
        out = distinct_words._emit(lambda: _byte_splitter(public_tokenizers.PATTERN), buckets)(piece)
        return sum(len(x) for c in ("words", "sizes") for x in out.column(c).to_pylist())

    # as many words a message as a piece of 4 MiB has at 0.5 GB and at 30 GB of documents
    few, many, as_before = (max(1, round(n * total / (4 << 20))) for n in (51, 1_060, 6_400))
    assert sent(many) < 1.4 * sent(few) and sent(many) < 0.8 * sent(as_before)
