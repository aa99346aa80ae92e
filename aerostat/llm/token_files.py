"""Compressed token-id files: an adaptive context-mixing range coder.

A file holds segments of whole documents. A segment's ids form one stream,
cut into blocks of a fixed number of ids. Each block is coded by itself and
carries a checksum, so any block can be read alone: it begins with the
distribution of the segment's ids, which its head holds, and with nothing
learnt.

Order 0 is that distribution. Order 1 keeps, per last id, the two next ids
that it has counted most, order 2 the one per last two ids, in hashed slots.
What the counts of a slot are worth as a probability is learnt as well, per
state of the counts: these are the weights by which the three orders are
mixed. The probability of an id is the sum of what all orders give it, and
one step of the range coder. All blocks of a segment are coded side by side
in numpy, one id of every block at a time.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerostat.llm.common import press_texts, small_batches, staged, tidied
from aerostat.llm.distinct_words import BUCKET, SpacedPiece, encoded_words
from aerostat.llm.files import filesystem, write_whole
from aerostat.llm.ranges import byte_ranges, range_of
from aerostat.session import scratch_path

BLOCK = 2048  # ids of a block
SEGMENT = 8 << 20  # ids of a segment, about; a longer document is a segment of its own
PIECE = 8 << 20  # text bytes of a piece, about
MAGIC = b"IDR3"
_HEAD = struct.Struct("<4sIII")  # of a segment: mark, ids of a block, blocks, bytes of the packed distribution
_BLOCK = struct.Struct("<III")  # of a block: ids, coded 16-bit words, checksum

_ONE, _TWO = 1 << 10, 1 << 11  # slots of the tables of order 1 and 2, per block
_SURE = 7  # counts of a slot stop here
_MIX = 12  # bits of the weights of the mixture
# chances of being right, of 4,096, that a block begins with, by the counts: of order 2; of order 1 by the counts of
# its first guess (0, 1, more) and its second (0, 1, more)
START_TWO = np.array([160, 230, 1300, 1600, 1600, 1700, 1900, 2400], np.uint32)
_FIRST_RIGHT = np.array([[96, 96, 96], [360, 110, 110], [680, 220, 530]])
_SECOND_RIGHT = np.array([[40, 40, 40], [110, 160, 160], [240, 170, 310]])
_N = np.minimum(np.arange(8), 2)
START_ONE = (_FIRST_RIGHT[_N, _N[:, None]] << 16 | _SECOND_RIGHT[_N, _N[:, None]]).ravel().astype(np.uint32)
_U = np.uint64
_LEAST = _U(1 << 48)  # width of an interval, of 64 bits


class Distribution:
    """Order 0: the ids of a segment by falling frequency, and their shares of ``1 << bits``."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray):
        self.ids, self.shares = ids, shares
        self.bits = int(shares.sum()).bit_length() - 1
        self.upto = np.concatenate([[0], np.cumsum(shares)])

    @classmethod
    def of(cls, ids: np.ndarray) -> Distribution:
        if ids.max() < 1 << 24:
            n = np.bincount(ids)
            found = np.flatnonzero(n)
            n = n[found]
        else:
            found, n = np.unique(ids, return_counts=True)
        order = np.argsort(-n, kind="stable")
        found, n = found[order], n[order]
        total = 1 << max(20, len(found).bit_length() + 2)
        shares = 1 + n * (total - len(found)) // n.sum()
        shares[0] += total - shares.sum()
        return cls(found, shares)

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        """Places of ids in ``self.ids``."""
        most = int(self.ids.max())
        if most < 1 << 24:
            place = np.zeros(most + 1, np.int64)
            place[self.ids] = np.arange(len(self.ids))
            return place[ids]
        by_id = np.argsort(self.ids)
        return by_id[np.searchsorted(self.ids, ids, sorter=by_id)]

    def packed(self) -> bytes:
        """Differences of the shares, which fall after the first, and the ids."""
        return zlib.compress(b"".join(x.astype("<u4").tobytes() for x in (
            np.array([len(self.ids)]), self.ids, self.shares[:1], -np.diff(self.shares))))

    @classmethod
    def unpacked(cls, raw: bytes) -> Distribution:
        flat = np.frombuffer(zlib.decompress(raw), "<u4").astype(np.int64)
        n = int(flat[0])
        return cls(flat[1:n + 1], np.concatenate([flat[n + 1:n + 2], flat[n + 1] - np.cumsum(flat[n + 2:])]))


class _Model:
    """What all blocks ("lanes") of a segment have learnt. Ids are ranks by frequency; tables are laid end to end.

    Numbers are as narrow as they can be, since each step makes some hundred passes over the lanes.
    """

    def __init__(self, lanes: int, prior: Distribution):
        self.bits, n = prior.bits, len(prior.ids)
        self.kind = np.uint32 if _MIX + prior.bits <= 32 and n > 1 else np.uint64  # of shares of the whole; one id has it all
        self.upto, self.shares = prior.upto.astype(self.kind), prior.shares.astype(self.kind)
        lane, rank = np.arange(lanes), np.arange(n)
        self.slot_one, self.slot_two = rank * 0x9E3779B1 >> 9 & _ONE - 1, rank * 0x85EBCA6B >> 11 & _TWO - 1
        # a slot of order 1: second guess << 32 | first guess << 6 | count of the second << 3 | count of the first;
        # of order 2: guess << 3 | count
        self.one, self.two = np.zeros(lanes * _ONE, np.uint64), np.zeros(lanes * _TWO, np.uint32)
        self.all_one, self.all_two, self.all_state_one, self.all_state_two = lane * _ONE, lane * _TWO, lane * 64, lane * 8
        # chance of being right by the counts, of 4,096: order 2; order 1, its first guess << 16 | its second
        self.right_two, self.right_one = np.tile(START_TWO, lanes), np.tile(START_ONE, lanes)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)  # the last id, the slot of the one before
        self.narrow(lanes)

    def narrow(self, n: int) -> None:
        """Go on with the first ``n`` lanes."""
        for name in ("all_one", "all_two", "all_state_one", "all_state_two", "last", "before"):
            setattr(self, name, getattr(self, name)[:n])
        self.g, self.w, self.new = np.empty((3, n), np.uint32), np.empty((3, n), self.kind), np.empty((n, 2), np.uint32)

    def predict(self) -> None:
        """Guesses ``g`` of order 2 and order 1 (two), their weights ``w``, and the weight ``rest`` of order 0."""
        slot = self.slot_two[self.last]
        self.at_one = self.slot_one[self.last] + self.all_one
        self.at_two = (slot ^ self.before) + self.all_two
        self.before = slot >> 1
        self.say_two = two = self.two[self.at_two]
        one = self.one[self.at_one].view(np.uint32)
        low, g, w = one[::2], self.g, self.w
        np.right_shift(two, 3, out=g[0])
        np.right_shift(low, 6, out=g[1])
        g[2] = one[1::2]
        self.n_two, self.n_one = two & 7, low & 63
        self.state_two, self.state_one = self.all_state_two + self.n_two, self.all_state_one + self.n_one
        self.p_two, self.p_one = p_two, p_one = self.right_two[self.state_two], self.right_one[self.state_one]
        w[0] = p_two
        rest = (1 << _MIX) - w[0]
        np.right_shift(rest * (p_one >> 16), _MIX, out=w[1])
        rest -= w[1]
        np.right_shift(rest * (p_one & 0xFFFF), _MIX, out=w[2])
        rest -= w[2]
        self.rest = rest  # 1 at least: 4096 less 4032, and of that twice no more than 15/16
        self.wide = w << self.bits

    def interval(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each id (``at``: the same as an index) in the mixture, of ``1 << _MIX + bits``.

        A guess adds its weight at the start of its id's own interval.
        """
        self.hit = self.g == ids
        start, width = self.rest * self.upto[at], self.rest * self.shares[at]
        start += np.add.reduce(self.wide * (self.g < ids), axis=0, dtype=self.kind)
        width += np.add.reduce(self.wide * self.hit, axis=0, dtype=self.kind)
        return start, width

    def find(self, value: np.ndarray, rank_of: np.ndarray) -> np.ndarray:
        """Ids whose intervals hold the values. ``rank_of`` maps a place in order 0 to its id.

        The guesses are taken out by rising ids: a value beyond a guess's
        weight moves down by it, one within it to its start. What is left
        is a value of order 0 alone.
        """
        key = (self.g.astype(self.kind) << _MIX) + self.w  # 2**18 ids at most where 32 bits have to do
        low, high = np.minimum(key[0], key[1]), np.maximum(key[0], key[1])
        middle = np.minimum(high, key[2])
        key[2], key[0], key[1] = np.maximum(high, key[2]), np.minimum(low, middle), np.maximum(low, middle)
        starts, weights = self.rest * self.upto[key >> _MIX], (key & (1 << _MIX) - 1) << self.bits
        for start, weight in zip(starts, weights):
            value = value - np.minimum(value - np.minimum(value, start), weight)
        return rank_of[value // self.rest]

    def learn(self, ids: np.ndarray, at: np.ndarray) -> None:
        hit_two, hit_first, hit_second = self.hit.view(np.uint8)
        both = hit_first << 1 | hit_second
        hits = (hit_two << 2 | both).astype(np.intp)
        p_two, p_one = self.p_two, self.p_one
        self.right_two[self.state_two] = p_two - (p_two >> 4) + _AIM_TWO[hits]
        self.right_one[self.state_one] = p_one - (p_one >> 4 & _OPEN_ONE[hits]) + _AIM_ONE[hits]

        case = (hit_two << 3).astype(np.uint32) | self.n_two
        self.two[self.at_two] = np.where(_STAYS[case], self.say_two + _STEP_TWO[case], ids << 3 | 1)

        case = (both.astype(np.uint32) << 6) + self.n_one
        first, new = self.g[1], self.new
        second, moves = np.where(_FRESH[case], ids, self.g[2]), _MOVES[case]
        np.bitwise_or(np.where(moves, second, first) << 6, _COUNTS[case], out=new[:, 0])
        new[:, 1] = np.where(moves, first, second)
        self.one[self.at_one] = new.view(np.uint64).ravel()
        self.last = at


def _cases() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What becomes of a slot of order 1, by (first guess right, second right, count of the second, of the first).

    Whether the id becomes the second guess, whether the guesses change places then, and the counts.
    """
    fresh, moves, counts = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, np.uint32)
    for case in range(256):
        first, second, n_first, n_second = case >> 7, case >> 6 & 1, case & 7, case >> 3 & 7
        if not n_first:
            fresh[case], n_second = True, 1
        elif first:
            n_first = min(n_first + 1, _SURE)
        elif second:
            n_second = min(n_second + 1, _SURE)
        elif n_second > 1:  # a guess that fails often makes room
            n_second -= 1
        else:
            fresh[case], n_second = True, 1
        if n_second > n_first:
            moves[case], n_first, n_second = True, n_second, n_first
        counts[case] = n_second << 3 | n_first
    return fresh, moves, counts


_FRESH, _MOVES, _COUNTS = _cases()
# of order 2, by right, count: whether the guess stays, and what is added to its count; sums go round at 2**32
_STAYS = np.array([n > 1 for n in range(8)] + [True] * 8)
_STEP_TWO = np.array([-1] * 8 + [1] * _SURE + [0]).astype(np.uint32)
# by right (order 2, first guess, second) what a sixteenth of the old chances makes room for; order 1 answers for what
# order 2 does not know, its second guess for what the first does not
_AIM_TWO = np.array([2] * 4 + [252] * 4, np.uint32)
_OPEN_ONE = np.array([0x0FFF0FFF, 0x0FFF0FFF, 0x0FFF0000, 0x0FFF0000, 0, 0, 0, 0], np.uint32)
_AIM_ONE = np.array([2 << 16 | 2, 2 << 16 | 239, 239 << 16, 239 << 16, 0, 0, 0, 0], np.uint32)


def encode_segment(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Code a stream of ids below 2**32."""
    lanes = -(-len(ids) // block)
    if not lanes:
        return _HEAD.pack(MAGIC, block, 0, 0)
    prior = Distribution.of(ids)
    packed = prior.packed()
    out = [_HEAD.pack(MAGIC, block, lanes, len(packed)), packed]
    last = len(ids) - block * (lanes - 1)
    flat = np.zeros(lanes * block, np.uint32)
    flat[:len(ids)] = prior.ranks(ids)
    grid = np.ascontiguousarray(flat.reshape(lanes, block)[:, :block if lanes > 1 else last].T)
    del flat
    model = _Model(lanes, prior)
    total = _U(_MIX + prior.bits)
    room = len(grid) + 64
    words, at = np.zeros(lanes * room, np.int32), np.arange(lanes) * room
    low, span = np.zeros(lanes, _U), np.full(lanes, ~_U(0))
    rest = []  # of the last lane, when it is over
    for step, row in enumerate(grid):
        if lanes > 1 and step == last:
            rest.append(low[-1])
            model.narrow(lanes - 1)
            low, span = low[:-1], span[:-1]
        row = row[:len(low)]
        index = row.astype(np.intp)
        model.predict()
        start, width = model.interval(row, index)
        unit = span >> total
        add = unit * start
        low = low + add
        over = (low < add).nonzero()[0]
        if len(over):  # a carry goes to the last word, and further at the end
            words[at[over] - 1] += 1
        span = unit * width
        some = (span < _LEAST).nonzero()[0]
        while len(some):
            a, b, place = low[some], span[some] << _U(16), at[some]
            words[place] = a >> _U(48)
            at[some] = place + 1
            low[some], span[some] = a << _U(16), b
            some = some[b < _LEAST]
        model.learn(row, index)
        if step % 16 == 0 and (at - np.arange(lanes) * room).max() + 64 > room:
            words = np.concatenate([words.reshape(lanes, room), np.zeros((lanes, room), np.int32)], axis=1).ravel()
            at += np.arange(lanes) * room
            room *= 2
    low = np.concatenate([low, np.array(rest, _U)])
    for _ in range(4):  # the rest of each lane
        words[at] = low >> _U(48)
        at += 1
        low = low << _U(16)
    words = words.reshape(lanes, room)
    while len(over := np.argwhere(words > 0xFFFF)):
        words[over[:, 0], over[:, 1]] -= 1 << 16
        np.add.at(words, (over[:, 0], over[:, 1] - 1), 1)
    at -= np.arange(lanes) * room
    plain, words = ids.astype("<u4"), words.astype("<u2")
    for k in range(lanes):
        own = plain[k * block:(k + 1) * block]
        out.append(_BLOCK.pack(len(own), int(at[k]), zlib.crc32(own)))
        out.append(words[k, :at[k]].tobytes())
    return b"".join(out)


def _blocks(raw: bytes) -> tuple[Distribution | None, list[tuple[int, np.ndarray, int]]]:
    """The distribution of a segment, and ids, coded words and checksum of its blocks."""
    try:
        mark, _, lanes, packed = _HEAD.unpack_from(raw)
        if mark != MAGIC:
            raise ValueError("not a segment of token ids")
        prior = Distribution.unpacked(raw[_HEAD.size:_HEAD.size + packed]) if lanes else None
        at, blocks = _HEAD.size + packed, []
        for _ in range(lanes):
            size, n, crc = _BLOCK.unpack_from(raw, at)
            at += _BLOCK.size
            blocks.append((size, np.frombuffer(raw, "<u2", n, at), crc))
            at += 2 * n
    except (struct.error, zlib.error) as e:
        raise ValueError("not a segment of token ids, or a damaged one") from e
    return prior, blocks


def decode_segment(raw: bytes, only: int | None = None) -> np.ndarray:
    """Ids of a segment, or of one of its blocks; a damaged block raises ``ValueError``."""
    prior, blocks = _blocks(raw)
    if only is not None:
        blocks = blocks[only:only + 1]
    if not blocks:
        return np.zeros(0, np.int64)
    sizes, lanes = [b[0] for b in blocks], len(blocks)
    room = max(len(b[1]) for b in blocks) + 8
    words = np.zeros((lanes, room), np.uint16)
    for k, (_, own, _) in enumerate(blocks):
        words[k, :len(own)] = own
    words, last = words.ravel(), sizes[-1]
    code = np.zeros(lanes, _U)  # less the lower end of the interval
    next_word = np.arange(lanes) * room
    limit = next_word + room - 1
    for _ in range(4):
        code = (code << _U(16)) | words[next_word].astype(_U)
        next_word += 1
    span = np.full(lanes, ~_U(0))
    model = _Model(lanes, prior)
    total = _U(_MIX + prior.bits)
    most = (_U(1) << total) - _U(1)
    rank_of = np.repeat(np.arange(len(prior.ids), dtype=np.uint32), prior.shares)
    grid = np.zeros((max(sizes), lanes), np.uint32)
    for step, row in enumerate(grid):
        if lanes > 1 and step == last:
            model.narrow(lanes - 1)
            code, span = code[:-1], span[:-1]
        model.predict()
        unit = span >> total
        ids = row[:len(code)]
        ids[:] = model.find(np.minimum(code // unit, most).astype(model.kind), rank_of)
        index = ids.astype(np.intp)
        start, width = model.interval(ids, index)
        code = code - unit * start
        span = unit * width
        some = (span < _LEAST).nonzero()[0]
        while len(some):
            place, b = next_word[some], span[some] << _U(16)
            code[some] = (code[some] << _U(16)) | words.take(np.minimum(place, limit[some]))
            next_word[some] = place + 1
            span[some] = b
            some = some[b < _LEAST]
        model.learn(ids, index)
    out = np.ascontiguousarray(grid.T)
    flat = prior.ids[np.concatenate([out[k, :size] for k, size in enumerate(sizes)])]
    plain, done = flat.astype("<u4"), 0
    for k, (size, _, crc) in enumerate(blocks):
        if zlib.crc32(plain[done:done + size]) != crc:
            raise ValueError(f"block {k if only is None else only} is damaged")
        done += size
    return flat


# --- Spark steps ------------------------------------------------------------------

@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return _tokenizer(path).get_vocab_size()


def _encoder(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # its threads would compete with the executor's other tasks
    batch = _tokenizer(path).encode_batch_fast
    return lambda words: [e.ids for e in batch(words, add_special_tokens=False)]


# --- files ------------------------------------------------------------------------

_PART = struct.Struct("<4sIII")  # of a segment in a file: mark, bytes of the packed documents, of the coded ids, checksum of the former
PART = b"DOCS"
NULL = -(1 << 63)  # written for a document without an id, which has a mask of its own


def pack_part(docs: list[int | None], counts: np.ndarray, coded: bytes) -> bytes:
    """A segment as it stands in a file: its documents, their numbers of ids, and the coded ids."""
    names = np.array([NULL if d is None else d for d in docs], "<i8")
    missing = np.array([d is None for d in docs], np.uint8)
    known = zlib.compress(b"".join((struct.pack("<I", len(docs)), missing.tobytes(), names.tobytes(), counts.astype("<u4").tobytes())))
    return _PART.pack(PART, len(known), len(coded), zlib.crc32(known)) + known + coded


def read_parts(stream) -> Iterator[tuple[pa.Array, np.ndarray, bytes]]:
    """Documents, numbers of ids and coded ids of the segments of a file, one after another."""
    while head := stream.read(_PART.size):
        if len(head) < _PART.size:
            raise ValueError("a file of token ids is cut off")
        mark, size, length, crc = _PART.unpack(head)
        known, coded = stream.read(size), stream.read(length)
        if mark != PART or len(coded) < length or zlib.crc32(known) != crc:
            raise ValueError("a file of token ids is damaged")
        flat = zlib.decompress(known)
        n = struct.unpack_from("<I", flat)[0]
        missing = np.frombuffer(flat, np.uint8, n, 4).astype(bool)
        names = np.frombuffer(flat, "<i8", n, 4 + n)
        yield pa.array(names, pa.int64(), mask=missing), np.frombuffer(flat, "<u4", n, 4 + 9 * n).astype(np.int64), coded


MANIFEST = "file string, piece int, documents long, ids long, bytes long"


def _write(buckets: int, end: int, kind: type, segment: int, root: str):
    schema = pa.schema([("file", pa.string()), ("piece", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        number = docs.column("piece")[0].as_py()
        piece = SpacedPiece(docs, buckets)
        ids, ends = piece.reassemble(words, kind)
        counts = np.diff(ends) + 1
        ids = np.insert(ids, ends[1:], end)
        upto, names = np.cumsum(counts), piece.ids.to_pylist()
        total = len(ids)
        del piece

        def parts():
            at = 0
            while at < len(counts):
                base = int(upto[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(upto, base + segment, side="right")))
                yield pack_part(names[at:to], counts[at:to], encode_segment(ids[base:int(upto[to - 1])]))
                at = to

        name = f"{number:08d}.ids"
        row = {"file": name, "piece": number, "documents": len(counts), "ids": total, "bytes": write_whole(root, name, parts())}
        return pa.Table.from_pylist([row], schema)

    return run


def write_token_files(docs: DataFrame, tokenizer: str, end: int, text: str = "text", doc_id: str = "doc_id",
                      piece_bytes: int = PIECE, segment: int = SEGMENT) -> tuple[str, DataFrame]:
    """Encode every whole text, append ``end``, and write the ids in ascending order of document ids.

    ``tokenizer`` names a file of the tokenizers library whose pre-tokenizer
    drops white space. Returns the folder and its manifest, one row per
    file: ``file``, ``piece`` (their order is that of the ids) and the
    numbers of ``documents``, ``ids`` and ``bytes``. A file holds a range of
    ids of about ``piece_bytes`` of text, in segments, is written under a
    temporary name and renamed; the manifest is stored last.

    Null and empty texts are an end alone. Null document ids come first;
    rows with equal ids stand by a digest of the text, and a heavy id is cut
    by it. An empty table writes nothing; long texts are coded whole; other
    columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = vocabulary_size(tokenizer)
    if not 0 <= end < vocabulary:
        raise ValueError("the end id is not in the vocabulary")
    kind = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    root = scratch_path(spark, "llm", "token_files")
    fs, folder = filesystem(root)
    fs.create_dir(folder, recursive=True)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.unhex(F.md5(body)).alias("digest"))
    narrow = staged(rows.select(F.col("doc_id").alias("id"), "digest", F.octet_length("text").cast("long").alias("size")), "token_rows")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total // BUCKET))
    # a place per piece; smaller pieces where there would be fewer than tasks
    places = spark.sparkContext.broadcast(byte_ranges(narrow, max(1, min(piece_bytes, total // least))))

    @F.pandas_udf("long")  # like the words' piece: equal numbers of two types are dealt apart
    def piece_of(ids: pd.Series, digests: pd.Series) -> pd.Series:
        return pd.Series([range_of(places.value, None if pd.isna(i) else int(i), d) for i, d in zip(ids, digests)], dtype="int64")

    dealt = press_texts(rows.withColumn("piece", piece_of(F.col("doc_id").cast("decimal(20,0)"), "digest")))
    # every tokenizer that drops white space cuts at ASCII white space, too
    words = encoded_words(dealt, None, partial(_encoder, tokenizer), buckets, kind)
    files = dealt.groupBy("piece").cogroup(words.groupBy("piece")).applyInArrow(
        tidied(_write(buckets, end, kind, segment, root)), MANIFEST)
    return root, staged(files, "token_manifest")


def read_token_files(root: str, manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``ids`` of every document, from the files.

    Where a file starts follows from the manifest alone; a task reads one
    file, segment by segment. One that is missing, cut off or changed fails.
    """
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = manifest.select("file", "documents", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        fs, folder = filesystem(root)
        for b in batches:
            for name, documents, start in zip(*[c.to_pylist() for c in b.columns]):
                with fs.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for docs, counts, coded in read_parts(stream):
                        ids = decode_segment(coded).astype(np.int32)
                        ends = np.concatenate([[0], np.cumsum(counts)])
                        for at in range(0, len(docs), 2048):
                            own = ends[at:at + 2049]
                            yield pa.RecordBatch.from_arrays([
                                docs.slice(at, len(own) - 1), pa.array(start + own[:-1]), pa.ListArray.from_arrays(
                                    pa.array(own - own[0], pa.int32()), pa.array(ids[own[0]:own[-1]]))], schema=schema)
                        start, documents = start + int(ends[-1]), documents - len(docs)
                if documents:
                    raise ValueError(f"{name} is cut off")

    return starts.repartition(max(1, manifest.count())).mapInArrow(run, "doc_id long, start long, ids array<int>")
