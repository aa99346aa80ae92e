"""Global shuffle of distinct words: each word of the corpus is encoded once.

Documents are dealt into pieces of bounded size. A piece explodes into its
distinct words; positions are numbers into that list and stay with the
piece. The words of all pieces meet in buckets by a checksum of the word,
where each distinct word is encoded once; the ids are joined back to the
pieces that sent the word, and every document is reassembled by position.

A piece sends a word once, however often it holds it, so a frequent word is
one entry a piece. Words travel packed, many to a row.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from aerostat.llm.common import pressed, tidied, unpress_texts, unpressed, word_hashes

# Text bytes per bucket. The words that a piece sends are much less than its text, so a bucket can serve many pieces; and
# the fewer buckets there are, the more words a message has, and the better these pack: a piece of 4 MiB sends 0.61 MiB
# to 100 buckets, 0.80 to 930 (30 GB of documents at this size) and would send 1.18 to 6,100.
BUCKET = 48 << 20

WORDS = "bucket long, piece long, words binary, sizes binary"
ENCODED = "piece long, bucket long, ids binary, counts binary"


class _Numbers(dict):
    """Numbers words in the order in which they are first seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Piece:
    """Words of some documents, in the order of their ids, as numbers of their distinct words.

    ``codes`` holds the words of each document by position. Words are dealt
    to buckets by a checksum; ``order`` lists their numbers bucket by bucket.
    """

    def __init__(self, table: pa.Table, split: Callable[[bytes], list[bytes]], buckets: int):
        table = table.sort_by([("doc_id", "ascending"), ("digest", "ascending")])
        numbers = _Numbers()
        self.ids = table.column("doc_id")
        self.codes = [array("i", map(numbers.__getitem__, split(t))) for t in unpress_texts(table.column("text"))]
        self.words = list(numbers)
        in_order = sorted(numbers)  # neighbours share letters, which packs better
        number = np.fromiter(map(numbers.__getitem__, in_order), np.int64, len(in_order))
        bucket = np.fromiter(map(zlib.crc32, in_order), np.int64, len(in_order)) % buckets
        by_bucket = np.argsort(bucket, kind="stable")
        self.order, self.bucket = number[by_bucket], bucket[by_bucket]

    def messages(self):
        """(bucket, bytes of its words, their lengths)."""
        cut = np.flatnonzero(np.diff(self.bucket)) + 1
        for part, own in zip(np.split(self.bucket, cut), np.split(self.order, cut)):
            if len(part):
                words = [self.words[i] for i in own.tolist()]
                yield int(part[0]), b"".join(words), np.fromiter(map(len, words), np.uint32, len(words))

    def reassemble(self, encoded: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after another, and where each ends (with a leading 0)."""
        flat, counts = _answers(encoded, kind)
        start, length = np.empty(len(counts), np.int64), np.empty(len(counts), np.int64)
        start[self.order], length[self.order] = np.cumsum(counts) - counts, counts
        parts, ends = [np.zeros(0, np.int32)], [0]
        for codes in self.codes:
            total = 0
            for at in range(0, len(codes), 1 << 20):  # bounds the index arrays
                some = np.frombuffer(codes, np.int32)[at:at + (1 << 20)]
                n = length[some]
                upto = np.cumsum(n)
                parts.append(flat[np.repeat(start[some] - upto + n, n) + np.arange(upto[-1])].astype(np.int32))
                total += int(upto[-1])
            ends.append(ends[-1] + total)
        return np.concatenate(parts), np.array(ends, np.int64)


class SpacedPiece:
    """A piece whose words are what stands between ASCII white space, with the numbers of its words in one array.

    The words are cut, numbered and sorted by Arrow and never become Python
    objects. White space at the ends of a text makes empty words, which
    have no ids.
    """

    def __init__(self, table: pa.Table, buckets: int):
        table = table.sort_by([("doc_id", "ascending"), ("digest", "ascending")])
        self.ids, self.buckets = table.column("doc_id"), buckets
        texts = pa.array(unpress_texts(table.column("text")), pa.large_binary()).view(pa.large_string())
        words = pc.ascii_split_whitespace(texts)
        self.ends = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())])
        numbered = words.flatten().dictionary_encode()
        self.codes = numbered.indices.to_numpy()
        # neighbours share letters, which packs better
        in_order = pc.sort_indices(numbered.dictionary).to_numpy()
        data, start, end = _spans(numbered.dictionary)
        bucket = (word_hashes(data, start[in_order], end[in_order]) % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        self.order, self.bucket = in_order[by_bucket].astype(np.int64), bucket[by_bucket]
        self.words = numbered.dictionary

    def messages(self):
        """(bucket, bytes of its words, their lengths)."""
        data, start, end = _spans(self.words.take(pa.array(self.order)))
        cut = [0, *(np.flatnonzero(np.diff(self.bucket)) + 1).tolist(), len(self.bucket)]
        for s, e in zip(cut, cut[1:]):
            if s < e:
                yield int(self.bucket[s]), data[start[s]:end[e - 1]].tobytes(), (end[s:e] - start[s:e]).astype(np.uint32)

    def reassemble(self, encoded: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after another, and where each ends (with a leading 0)."""
        flat, counts = _answers(encoded, kind)
        start, length = np.empty(len(counts), np.int64), np.empty(len(counts), np.int64)
        start[self.order], length[self.order] = np.cumsum(counts) - counts, counts
        parts, upto = [np.zeros(0, np.int32)], np.zeros(len(self.codes) + 1, np.int64)
        for at in range(0, len(self.codes), 1 << 18):  # bounds the index arrays
            some = self.codes[at:at + (1 << 18)]
            parts.append(_gathered(flat, start[some], length[some]).astype(np.int32))
            np.cumsum(length[some], out=upto[at + 1:at + 1 + len(some)])
            upto[at + 1:at + 1 + len(some)] += upto[at]
        return np.concatenate(parts), upto[self.ends]


def _spans(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a column of words with 8 spare ones, and where each word starts and ends."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    raw = words.buffers()[2]
    data = np.zeros((len(raw or b"")) + 8, np.uint8)
    if raw is not None:
        data[:-8] = np.frombuffer(raw, np.uint8)
    return data, ends[:-1], ends[1:]


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``start``, one after another."""
    upto = np.cumsum(length)
    return flat[np.repeat(start - upto + length, length) + np.arange(upto[-1] if len(upto) else 0)]


def _answers(encoded: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a piece's words, bucket by bucket, and how many each word has."""
    got = encoded.sort_by("bucket")
    flat, counts = (np.frombuffer(b"".join(map(unpressed, got.column(c).to_pylist())), k)
                    for c, k in (("ids", kind), ("counts", np.uint32)))
    return flat, counts.astype(np.int64)


def _emit(make_split: Callable | None, buckets: int):
    schema = pa.schema([("bucket", pa.int64()), ("piece", pa.int64()), ("words", pa.binary()), ("sizes", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        number = table.column("piece")[0].as_py()
        piece = SpacedPiece(table, buckets) if make_split is None else Piece(table, make_split(), buckets)
        return pa.Table.from_pylist([{"bucket": bucket, "piece": number, "words": pressed(words), "sizes": pressed(sizes.tobytes())}
                                     for bucket, words, sizes in piece.messages()], schema)

    return run


def _encode(make_encode: Callable, kind: type):
    schema = pa.schema([("piece", pa.int64()), ("bucket", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        sizes = [np.frombuffer(unpressed(s), np.uint32) for s in table.column("sizes").to_pylist()]
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        raw = b"".join(map(unpressed, table.column("words").to_pylist()))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        numbered = words.dictionary_encode()
        distinct, codes = numbered.dictionary.cast(pa.large_string()), numbered.indices.to_numpy()
        encode, flat, counts = make_encode(), [], []
        for at in range(0, len(distinct), 10_000):
            ids = encode(distinct[at:at + 10_000].to_pylist())
            counts.append(np.fromiter(map(len, ids), np.uint32, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), kind, int(counts[-1].sum())))
        flat, counts = np.concatenate(flat), np.concatenate(counts)
        upto, at, rows = np.cumsum(counts, dtype=np.int64), 0, []
        start = upto - counts
        for piece, bucket, own in zip(table.column("piece").to_pylist(), table.column("bucket").to_pylist(), sizes):
            some = codes[at:at + len(own)]
            at += len(own)
            rows.append({"piece": piece, "bucket": bucket, "counts": pressed(counts[some].tobytes()),
                         "ids": pressed(_gathered(flat, start[some], counts[some].astype(np.int64)).tobytes())})
        return pa.Table.from_pylist(rows, schema)

    return run


def encoded_words(dealt: DataFrame, make_split: Callable | None, make_encode: Callable, buckets: int, kind: type) -> DataFrame:
    """Ids of the distinct words of each piece (``ENCODED``), to be cogrouped with its documents.

    ``dealt`` has ``doc_id``, ``text`` (compressed), ``digest`` and ``piece``.
    ``make_split`` and ``make_encode`` are called in the tasks and return
    the function that cuts the bytes of a text into words, and the one that
    maps a list of words to their lists of ids. Without ``make_split`` words
    are what stands between ASCII white space (``SpacedPiece``).
    """
    return dealt.groupBy("piece").applyInArrow(tidied(_emit(make_split, buckets)), WORDS).groupBy("bucket").applyInArrow(
        tidied(_encode(make_encode, kind)), ENCODED)
