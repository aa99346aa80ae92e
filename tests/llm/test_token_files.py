from __future__ import annotations

import glob
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerostat.llm.common import pressed
from aerostat.llm.distinct_words import Piece, SpacedPiece
from aerostat.llm.queries import token_files
from aerostat.llm.token_files import Distribution, _Model, decode_segment, encode_segment, read_token_files, write_token_files

from .conftest import SF, texts_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 299), max_size=400), st.sampled_from([1, 1_000, (1 << 32) // 300]), st.sampled_from([1, 7, 64, 2048]))
def test_round_trip(ids, scale, block):
    ids = np.array(ids, np.int64) * scale
    assert (decode_segment(encode_segment(ids, block)) == ids).all()


@pytest.mark.parametrize("vocabulary", [1, 2, 49_408, 200_000])
def test_round_trip_of_long_streams(vocabulary):
    rng = np.random.default_rng(vocabulary)
    for ids in (rng.integers(0, vocabulary, 9_000), np.full(9_000, vocabulary - 1), np.minimum(rng.zipf(1.3, 9_000), vocabulary) - 1):
        raw = encode_segment(ids)
        assert (decode_segment(raw) == ids).all()
        assert all((decode_segment(raw, only=k) == ids[2048 * k:2048 * (k + 1)]).all() for k in range(5))  # any block alone


def entropy(ids):
    n = np.unique(ids, return_counts=True)[1]
    return float((n * np.log2(len(ids) / n)).sum()) / 8


def test_mixing_beats_the_static_distribution():
    rng = np.random.default_rng(1)
    follows = rng.integers(0, 3_000, (3_000, 3))
    chain = [0, 0]
    for _ in range(60_000):  # the next id often follows from the last one, and repeats happen
        if rng.random() < 0.02:
            chain += chain[-rng.integers(40, 400):][:60]
        chain.append(int(follows[chain[-1]][rng.integers(0, 3)]) if rng.random() < 0.7 else int(min(rng.zipf(1.2), 3_000)) - 1)
    ids = np.array(chain)
    free = rng.permutation(ids)  # the same ids without any order
    assert len(encode_segment(ids)) < 0.93 * entropy(ids)
    assert len(encode_segment(free)) < 1.04 * entropy(free) + 4 * 3_000  # with the head: little is lost where nothing follows


@pytest.mark.parametrize("n", [1, 2, 5_000, 200_000])
def test_distribution(n):
    ids = np.random.default_rng(n).integers(0, n, 3 * n)
    d = Distribution.of(ids)
    same = Distribution.unpacked(d.packed())
    assert (same.ids == d.ids).all() and (same.shares == d.shares).all() and d.shares.min() >= 1 and d.shares.sum() == 1 << d.bits
    assert (np.diff(d.shares) <= 0).all()


def test_what_repeats_is_predicted():
    ids = np.tile(np.arange(50) * 97, 400)
    assert len(encode_segment(ids)) < len(ids) / 8  # 16 bits an id as they are


def test_damage_is_found():
    good = encode_segment(np.arange(5_000) % 700)
    for at in (len(good) - 60, 30):  # in a block, in the head
        raw = bytearray(good)
        raw[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            decode_segment(bytes(raw))
    with pytest.raises(ValueError, match="not a segment"):
        decode_segment(b"nothing like it at all")


def dealt(texts):
    n = len(texts)
    return pa.table({"doc_id": pa.array(range(n), pa.int64()), "digest": pa.array([b""] * n),
                     "text": pa.array([pressed(t.encode()) for t in texts], pa.binary())})


def test_words_between_white_space():
    """Words cut and numbered by Arrow are those of ``bytes.split``, and empty ones at the ends of a text."""
    texts = ["", " ", "a", " a  b\x0ba\x0c", "\r\nB\tb ", "\xa0x\x1cy\x85z\u2003 é\u3000ß", "a b" * 50, "\x00 \x00"]
    buckets = 3
    piece = SpacedPiece(dealt(texts), buckets)
    words = [w.encode() for w in piece.words.to_pylist()]
    got = [[words[c] for c in piece.codes[s:e] if words[c]] for s, e in zip(piece.ends, piece.ends[1:])]
    assert got == [t.encode().split() for t in texts]
    sent = []
    for bucket, raw, sizes in piece.messages():
        ends = np.cumsum(sizes).tolist()
        sent += [(bucket, raw[s:e]) for s, e in zip([0, *ends], ends)]
    assert sorted(w for _, w in sent) == sorted(words) and [words[i] for i in piece.order] == [w for _, w in sent]
    assert all(0 <= b < buckets for b, _ in sent)


def test_words_are_cut_without_python_objects():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.3, 20_000) % 60_000) for _ in range(12)]
    table = dealt(texts)

    def cost(make):
        best = float("inf")
        for _ in range(3):
            begin = time.process_time()
            make()
            best = min(best, time.process_time() - begin)
        return best

    assert cost(lambda: SpacedPiece(table, 50)) < 0.8 * cost(lambda: Piece(table, bytes.split, 50))


def test_numbers_of_the_model_are_narrow():
    """Half the width of before, but where 32 bits do not hold the shares of the whole."""
    of = {n: _Model(3, Distribution.of(np.arange(n))) for n in (1, 2, 49_408, 300_000)}
    assert [m.kind for m in of.values()] == [np.uint64, np.uint32, np.uint32, np.uint64]
    for n, m in of.items():
        m.predict()
        ids = np.array([0, n // 2, n - 1], np.uint32)
        start, width = m.interval(ids, ids.astype(np.intp))
        assert start.dtype == width.dtype == m.kind
        assert (width > 0).all() and int(start[-1]) + int(width[-1]) == 1 << 12 + m.bits


@pytest.mark.parametrize("small", [False, True])
def test_files(odd_docs, small):
    more = {"piece_bytes": 400, "segment": 300} if small else {}
    root, manifest = write_token_files(odd_docs, PATH, end=1, **more)
    assert manifest.count() > (20 if small else 0)
    rows = read_token_files(root, manifest).collect()
    library = Tokenizer.from_file(PATH)
    at, want = 0, []
    for i, t in sorted(texts_of(odd_docs), key=lambda d: d[0]):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, ids))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], list(r["ids"])) for r in rows) == want


def test_null_ids_come_first_and_empty(with_null_ids, no_docs):
    rows = read_token_files(*write_token_files(with_null_ids, PATH, end=1)).collect()
    none = [r["start"] for r in rows if r["doc_id"] is None]
    assert len(none) == 3 and max(none) < min(r["start"] for r in rows if r["doc_id"] is not None)
    assert read_token_files(*write_token_files(no_docs, PATH, end=1)).collect() == []


def test_a_damaged_file_fails(odd_docs):
    root, manifest = write_token_files(odd_docs, PATH, end=1)
    path = sorted(glob.glob(f"{root.removeprefix('file:')}/*.ids"))[0]
    raw = open(path, "rb").read()
    for bad in (raw[:-9], raw[:40], raw[:10] + b"x" + raw[11:], b""):
        open(path, "wb").write(bad)
        with pytest.raises(Exception, match="damaged|cut off"):
            read_token_files(root, manifest).collect()


def test_coded_segments_are_not_shuffled(spark, odd_docs):
    root, manifest = write_token_files(odd_docs, PATH, end=1)
    plan = read_token_files(root, manifest)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "data" not in manifest.columns


def test_digests_of_the_query(spark):
    library = Tokenizer.from_file(PATH)
    at, want = 0, []
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files(spark, SF).collect()) == want


def test_end_outside_the_vocabulary(odd_docs):
    with pytest.raises(ValueError):
        write_token_files(odd_docs, PATH, end=1 << 20)
