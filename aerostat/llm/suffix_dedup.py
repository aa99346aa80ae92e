"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id. All such strings ("windows") of the corpus are
judged, in four steps:

1. Documents are dealt into pieces of bounded size. Every window has an
   anchor, the gram in it with the smallest hash; a run of windows with the
   same anchor is a segment. Equal windows have equal anchors, so a segment
   whose anchor stands in no other document is done.
2. The other segments go, once per piece and text, to a bucket of their
   anchor. A copy, or a passage that a third of all documents share, is one
   row of a piece there, however often it stands in it. An anchor with
   many distinct segments (a phrase in ever new surroundings) is hot: its
   segments go as single windows, each dealt by a hash of its own bytes, so
   that they spread over all buckets.
3. In a bucket, anchors with more than one distinct segment are cut into
   shards of bounded size. A shard gets a suffix array (Larsson-Sadakane
   refinement), common prefixes (Kasai) show which windows are equal, and
   shards are merged by binary search in their sorted distinct windows.
   That yields the smallest document of every window.
4. Each piece compares these with its own ids and cuts its texts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.llm.common import (RangeHash, joined, mix, press_texts, pressed, small_batches, tidied, unpress_texts, unpressed,
                                 words_at)

PIECE = 4 << 20  # text bytes of a piece, about
GRAM = 24  # bytes of an anchor
SHARD = 1 << 20  # bytes of segments in a shard
HOT = 1 << 15  # distinct segments of an anchor, summed over the pieces, that stay together
STEP = 1 << 18  # windows or bytes looked at together
NO_ID = np.iinfo(np.int64).max  # a null id is smaller than none

_C = np.uint32(0x9E3779B1)


# --- anchors and segments ---------------------------------------------------

def _gram_hash(data: np.ndarray, n: int, gram: int) -> np.ndarray:
    """32-bit hash of the ``gram`` bytes from each of the first ``n`` places."""
    mult, size, have = _C, 1, _BYTE32[data[:n + gram - 1]]
    total, done = None, 0
    while True:
        if gram & size:
            total = have[done:done + n].copy() if total is None else total * mult + have[done:done + n]
            done += size
        if done == gram:
            break
        have = have[:-size] * mult + have[size:]
        mult, size = np.uint32(int(mult) ** 2 & 0xFFFFFFFF), 2 * size
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x85EBCA6B)
    total ^= total >> np.uint32(13)
    return total


_BYTE32 = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def _first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value (the first, if several) in each run of ``width``."""
    low = (values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(values) - width + 1
    return (np.minimum(low[:n], low[width - size:width - size + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _hashes_at(spare: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the ``n`` bytes from each place (``spare`` as in ``words_at``)."""
    h = np.zeros(len(places), np.uint64)
    for j in range(0, n, 8):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words_at(spare, places + min(j, n - 8)))
    return h


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: first byte, windows, row, hash of the anchor, hash of the bytes.

    Work is done in steps of bounded size; a run that meets a step's end is
    two segments, which changes nothing for their windows.
    """
    spare = np.concatenate([data, np.zeros(8, np.uint8)])
    out: dict[str, list] = {c: [] for c in ("start", "windows", "row", "anchor", "text")}
    for at in range(0, max(0, len(data) - length + 1), STEP):
        n = min(STEP, len(data) - length + 1 - at)
        part = data[at:at + n + length - 1]
        width = length - gram + 1
        anchor = _first_smallest(_gram_hash(part, len(part) - gram + 1, gram), width)
        edge = np.zeros(n, np.int64)
        np.add.at(edge, offsets[1:-1][(offsets[1:-1] > at) & (offsets[1:-1] < at + n)] - at, 1)
        row = np.cumsum(edge) + np.searchsorted(offsets, at, side="right") - 1
        good = np.arange(at, at + n) + length <= offsets[1:][row]
        opens = good.copy()
        opens[1:] &= ~good[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(opens)
        if not len(start):
            continue
        # windows of a run: up to the next run or the next window that crosses a row
        total = np.concatenate([[0], np.cumsum(good)])
        windows = total[np.append(start[1:], n)] - total[start]
        out["start"].append(start + at)
        out["windows"].append(windows)
        out["row"].append(row[start])
        out["anchor"].append(_hashes_at(spare, anchor[start] + at, gram))
        out["text"].append(RangeHash(part).of(start, start + windows + length - 1))
    return {c: np.concatenate(v) if v else np.zeros(0, np.uint64 if c in ("anchor", "text") else np.int64)
            for c, v in out.items()}


class Piece:
    """The documents of a piece in the order of their ids, and their segments."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        table = table.combine_chunks().sort_by([("doc_id", "ascending"), ("digest", "ascending")])
        table = table.combine_chunks()
        self.table = table
        self.ids = table.column("doc_id").combine_chunks()
        self.data, self.offsets = joined(unpress_texts(table.column("text")))
        self.seg = segments(self.data, self.offsets, length, gram)
        self.length = length
        ids = self.ids.fill_null(NO_ID)
        self.key = (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).to_numpy(zero_copy_only=False)

    def anchors(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in the order of bucket and value, each segment's number in it, and which meet two ids here."""
        found, of = np.unique(_dealt(self.seg["anchor"], buckets), return_inverse=True)
        own = self.key[self.seg["row"]]
        low = np.full(len(found), NO_ID)
        high = np.full(len(found), np.iinfo(np.int64).min)
        np.minimum.at(low, of, own)
        np.maximum.at(high, of, own)
        return found, of, low < high

    def windows_of(self, at: np.ndarray) -> dict[str, np.ndarray]:
        """The windows of these segments, each as a segment that is its own anchor."""
        count = self.seg["windows"][at]
        start = _spread(self.seg["start"][at], count)
        h = _hashes_at(np.concatenate([self.data, np.zeros(8, np.uint8)]), start, self.length) if len(at) else np.zeros(0, np.uint64)
        return {"start": start, "windows": np.ones(len(start), np.int64), "row": np.repeat(self.seg["row"][at], count),
                "anchor": h, "text": h}


def _distinct(number: np.ndarray, text: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by number and text, stable, and which of that order open a new one."""
    order = np.lexsort((text, number))
    n, t, w = number[order], text[order], windows[order]
    first = np.ones(len(order), bool)
    first[1:] = (n[1:] != n[:-1]) | (t[1:] != t[:-1]) | (w[1:] != w[:-1])
    return order, first


def _dealt(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper, value in the lower half."""
    return ((anchor >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (anchor & np.uint64(0xFFFFFFFF))


def _by_bucket(dealt: np.ndarray):
    """(bucket, from, to) of each bucket's stretch in sorted values."""
    bucket = (dealt >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip(np.concatenate([[0], cut]), np.append(cut, len(bucket))):
        if b > a:
            yield int(bucket[a]), int(a), int(b)


def _emit_anchors(length: int, gram: int, buckets: int):
    schema = pa.schema([("bucket", pa.int64()), ("piece", pa.int64()), ("anchors", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        number = table.column("piece")[0].as_py()
        piece = Piece(table, length, gram)
        found, of, _ = piece.anchors(buckets)
        low = found.astype(np.uint32)
        order, first = _distinct(of, piece.seg["text"], piece.seg["windows"])
        counts = np.bincount(of[order[first]], minlength=len(found)).astype(np.uint32)  # distinct segments
        rows = [{"bucket": b, "piece": number, "anchors": low[s:e].tobytes(), "counts": pressed(counts[s:e].tobytes())}
                for b, s, e in _by_bucket(found)]
        return pa.Table.from_pylist(rows, schema)

    return run


def _shared(hot: int):
    """Per piece one bit per anchor: whether another piece has it, too; and one: whether it has more than ``hot`` segments."""
    schema = pa.schema([("piece", pa.int64()), ("bucket", pa.int64()), ("shared", pa.binary()), ("hot", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("anchors")]
        counts = np.concatenate([np.frombuffer(unpressed(x.as_py()), np.uint32) for x in table.column("counts")])
        values = np.concatenate(parts)
        order = np.argsort(values)
        opens = np.flatnonzero(np.concatenate([[True], np.diff(values[order]) != 0]))
        distinct = values[order[opens]]
        twice = np.diff(np.append(opens, len(values))) > 1
        many = np.add.reduceat(counts[order].astype(np.int64), opens) > hot
        rows = []
        for bucket, piece, own in zip(table.column("bucket").to_pylist(), table.column("piece").to_pylist(), parts):
            at = np.searchsorted(distinct, own)
            rows.append({"piece": piece, "bucket": bucket, "shared": np.packbits(twice[at]).tobytes(),
                         "hot": pressed(np.packbits(many[at]).tobytes())})
        return pa.Table.from_pylist(rows, schema)

    return run


class Candidates:
    """Segments of a piece that may have equals, one per distinct text, in bucket order; those of hot anchors as single windows."""

    def __init__(self, piece: Piece, masks: pa.Table, buckets: int):
        found, of, here = piece.anchors(buckets)
        shared, hot = here.copy(), np.zeros(len(found), bool)
        bits = {b: (m, unpressed(x)) for b, m, x in zip(*(masks.column(c).to_pylist() for c in ("bucket", "shared", "hot")))}
        for b, s, e in _by_bucket(found):
            more, many = (np.unpackbits(np.frombuffer(x, np.uint8), count=e - s).astype(bool) for x in bits[b])
            shared[s:e] |= more
            hot[s:e] = many
        whole, single = np.flatnonzero((shared & ~hot)[of]), piece.windows_of(np.flatnonzero((shared & hot)[of]))
        self.seg = {c: np.concatenate([v[whole], single[c]]) for c, v in piece.seg.items()}  # all such segments
        dealt = _dealt(self.seg["anchor"], buckets)
        order, first = _distinct(dealt, self.seg["text"], self.seg["windows"])  # equal texts: the smallest id first
        self.unique = order[first]  # into self.seg
        self.of = np.empty(len(order), np.int64)  # unique number of each such segment
        self.of[order] = np.cumsum(first) - 1
        self.bucketed = dealt[self.unique]


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of each stretch, one after another."""
    upto = np.cumsum(count)
    return np.repeat(start - upto + count, count) + np.arange(int(upto[-1]) if len(upto) else 0)


_SEGMENTS = "bucket long, piece long, anchors binary, windows binary, ids binary, texts binary"


def _emit_segments(length: int, gram: int, buckets: int):
    schema = pa.schema([("bucket", pa.int64()), ("piece", pa.int64()), *[(c, pa.binary()) for c in
                                                                         ("anchors", "windows", "ids", "texts")]])

    def run(docs: pa.Table, masks: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        number = docs.column("piece")[0].as_py()
        piece = Piece(docs, length, gram)
        some = Candidates(piece, masks, buckets)
        seg = {c: v[some.unique] for c, v in some.seg.items()}
        ids = piece.key[seg["row"]]
        rows = []
        for b, s, e in _by_bucket(some.bucketed):
            where = _spread(seg["start"][s:e], seg["windows"][s:e] + length - 1)
            rows.append({"bucket": b, "piece": number, "anchors": seg["anchor"][s:e].tobytes(),
                         "windows": pressed(seg["windows"][s:e].astype(np.uint32).tobytes()), "ids": pressed(ids[s:e].tobytes()),
                         "texts": pressed(piece.data[where].tobytes())})
        return pa.Table.from_pylist(rows, schema)

    return run


# --- suffix arrays ------------------------------------------------------------

def suffix_ranks(data: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Ranks of the first ``n`` suffixes by their first ``depth`` bytes (8 times a power of two).

    Larsson-Sadakane refinement: sorted by 8 bytes first; then the rank h
    bytes further on refines each group that is not yet a single suffix,
    and h doubles. Finished suffixes are not sorted again.
    """
    key = words_at(data, np.arange(n))
    order = np.argsort(key)
    opens = np.ones(n, bool)
    opens[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))  # first place of the group
    size = np.diff(np.append(np.flatnonzero(opens), n))
    alive = order[np.repeat(size > 1, size)]
    h = 8
    while h < depth and len(alive):
        after = np.where(alive + h < n, rank[np.minimum(alive + h, n - 1)] + 1, 0)
        key = (rank[alive].astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        by = np.argsort(key)
        alive, key = alive[by], key[by]
        group = (key >> np.uint64(32)).astype(np.int64)
        place = np.arange(len(alive))
        opens = np.ones(len(alive), bool)
        opens[1:] = key[1:] != key[:-1]
        first = np.ones(len(alive), bool)
        first[1:] = group[1:] != group[:-1]
        rank[alive] = group + np.maximum.accumulate(np.where(opens, place, 0)) - np.maximum.accumulate(
            np.where(first, place, 0))
        size = np.diff(np.append(np.flatnonzero(opens), len(alive)))
        alive = alive[np.repeat(size > 1, size)]
        h *= 2
    return rank


def common_prefixes(data: np.ndarray, start: np.ndarray, size: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of every suffix and the one before it in the suffix array, up to ``most`` bytes.

    Kasai's walk in text order: the prefix of the next suffix is at most one
    byte shorter. Each stretch (``start``, ``size``) is a lane of its own
    and all lanes step together. The suffixes are ordered by ``most`` bytes;
    after a tie nothing is known of the next prefix, so it starts at 0.
    """
    out = np.zeros(len(before), np.int64)
    lane = np.arange(len(start))
    h = np.zeros(len(start), np.int64)
    step = 0
    while len(lane):
        here = start[lane] + step
        other = before[here]
        known = h[lane]
        h[lane] = np.where((known == most) | (other < 0), 0, np.maximum(known - 1, 0))
        grow = np.flatnonzero(other >= 0)
        while len(grow):
            k = h[lane[grow]]
            same = k < most
            same[same] = data[here[grow[same]] + k[same]] == data[other[grow[same]] + k[same]]
            grow = grow[same]
            h[lane[grow]] += 1
        out[here] = h[lane]
        step += 1
        lane = lane[size[lane] > step]
    return out


def sorted_windows(texts: np.ndarray, windows: np.ndarray, ids: np.ndarray, length: int):
    """Distinct windows of a shard in order, their smallest id, and each window's number in them."""
    size = windows + length - 1
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    n, depth = len(texts), 8
    while depth < length:
        depth *= 2
    data = np.concatenate([texts, np.zeros(depth, np.uint8)])
    order = np.argsort(suffix_ranks(data, n, depth))  # the suffix array
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    opens = common_prefixes(data, start, size, before, depth)[order] < length
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(opens)
    place = _spread(start, windows)
    _, head, number = np.unique(group[place], return_index=True, return_inverse=True)
    distinct = np.ndarray((n - length + 1,), dtype=f"S{length}", buffer=data, strides=(1,))[place[head]]
    least = np.full(len(head), NO_ID)
    np.minimum.at(least, number, np.repeat(ids, windows))
    return distinct, least, number


def merge_shards(shards: list) -> list[np.ndarray]:
    """Smallest id over all shards of each shard's distinct windows, by binary search."""
    if len(shards) == 1:
        return [shards[0][1]]
    least = [s[1].copy() for s in shards]
    for i, (mine, _, _) in enumerate(shards):
        for j, (other, theirs, _) in enumerate(shards):
            if i != j and len(other) and len(mine):
                at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
                same = other[at] == mine
                least[i][same] = np.minimum(least[i][same], theirs[at[same]])
    return least


def least_ids(anchors: np.ndarray, windows: np.ndarray, ids: np.ndarray, texts: np.ndarray, length: int,
              shard: int = SHARD) -> np.ndarray:
    """Smallest id of every window of all segments, segment by segment."""
    size = windows + length - 1
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    # equal segments, byte for byte: sorted by a hash, compared with the one before
    h = np.zeros(len(size), np.uint64)
    for a, b in _stretches(size, STEP):
        own = start[a:b] - start[a]
        h[a:b] = RangeHash(texts[start[a]:start[b - 1] + size[b - 1]]).of(own, own + size[a:b])
    order = np.lexsort((h, anchors))
    a, t, s = anchors[order], h[order], size[order]
    same = np.zeros(len(order), bool)
    same[1:] = (a[1:] == a[:-1]) & (t[1:] == t[:-1]) & (s[1:] == s[:-1])
    for lo in range(0, len(order), 1 << 12):
        pair = lo + np.flatnonzero(same[lo:lo + (1 << 12)])
        if len(pair):
            n = s[pair]
            differ = texts[_spread(start[order[pair]], n)] != texts[_spread(start[order[pair - 1]], n)]
            same[pair[np.add.reduceat(differ, np.concatenate([[0], np.cumsum(n)])[:-1]) > 0]] = False
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(~same) - 1
    head = order[~same]
    least = np.full(len(head), NO_ID)
    np.minimum.at(least, number, ids)
    # anchors with several distinct segments need the suffix arrays
    own = anchors[head]
    several = np.zeros(len(head), bool)
    if len(head) > 1:
        several[1:] = own[1:] == own[:-1]
        several[:-1] |= own[1:] == own[:-1]
    result = np.repeat(least, windows[head])
    upto = np.concatenate([[0], np.cumsum(windows[head])])
    for group in _shard_groups(own, size[head], np.flatnonzero(several), shard):
        done = []
        for part in group:
            seg = head[part]
            done.append(sorted_windows(texts[_spread(start[seg], size[seg])], windows[seg], least[part], length))
        for part, (_, _, which), low in zip(group, done, merge_shards(done)):
            result[_spread(upto[part], windows[head[part]])] = low[which]
    where = _spread(upto[number], windows)
    return result[where]


def _stretches(size: np.ndarray, most: int):
    ends, a = np.cumsum(size), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def _shard_groups(anchor: np.ndarray, size: np.ndarray, at: np.ndarray, most: int):
    """Lists of shards that must be merged: whole anchors together, a larger one in several shards."""
    if not len(at):
        return
    opens = np.flatnonzero(np.concatenate([[True], anchor[at][1:] != anchor[at][:-1]]))
    total = np.add.reduceat(size[at], opens)
    bounds = np.append(opens, len(at))
    for a, b in _stretches(total, most):
        own = at[bounds[a]:bounds[b]]
        yield [own[x:y] for x, y in _stretches(size[own], most)]


def _merge_buckets(length: int):
    schema = pa.schema([("piece", pa.int64()), ("bucket", pa.int64()), ("runs", pa.binary()), ("sizes", pa.binary()),
                        ("least", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        anchors = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("anchors")]
        windows, ids, texts = ([np.frombuffer(unpressed(x.as_py()), kind) for x in table.column(c)]
                               for c, kind in (("windows", np.uint32), ("ids", np.int64), ("texts", np.uint8)))
        windows = [w.astype(np.int64) for w in windows]
        all_windows = np.concatenate(windows)
        low = least_ids(np.concatenate(anchors), all_windows, np.concatenate(ids), np.concatenate(texts), length)
        # per segment runs of windows with one smallest id
        first = np.concatenate([[0], np.cumsum(all_windows)])
        opens = np.ones(len(low), bool)
        opens[1:] = low[1:] != low[:-1]
        opens[first[:-1]] = True
        at = np.flatnonzero(opens)
        sizes = np.diff(np.append(at, len(low))).astype(np.uint32)
        total = np.concatenate([[0], np.cumsum(opens)])
        runs = total[first[1:]] - total[first[:-1]]
        rows, seg = [], 0
        for bucket, piece, own in zip(table.column("bucket").to_pylist(), table.column("piece").to_pylist(), windows):
            lo, hi = total[first[seg]], total[first[seg + len(own)]]
            rows.append({"piece": piece, "bucket": bucket, "runs": pressed(runs[seg:seg + len(own)].astype(np.uint32).tobytes()),
                         "sizes": pressed(sizes[lo:hi].tobytes()), "least": pressed(low[at[lo:hi]].tobytes())})
            seg += len(own)
        return pa.Table.from_pylist(rows, schema)

    return run


# --- cutting ------------------------------------------------------------------

def _removed(piece: Piece, found: pa.Table, buckets: int) -> np.ndarray:
    """Which bytes of a piece go."""
    masks = found.filter(found.column("shared").is_valid())
    results = found.filter(found.column("runs").is_valid()).sort_by("bucket")
    some = Candidates(piece, masks, buckets)
    runs, sizes, least = (
        np.concatenate([np.zeros(0, kind), *[np.frombuffer(unpressed(x), kind) for x in results.column(c).to_pylist()]])
        for c, kind in (("runs", np.uint32), ("sizes", np.uint32), ("least", np.int64)))
    runs, sizes = runs.astype(np.int64), sizes.astype(np.int64)
    first, own = np.concatenate([[0], np.cumsum(runs)]), some.of
    which = _spread(first[own], runs[own])  # runs of all candidate segments
    opened = np.concatenate([[0], np.cumsum(sizes)])
    start = np.repeat(some.seg["start"] - opened[first[own]], runs[own]) + opened[which]
    goes = least[which] < np.repeat(piece.key[some.seg["row"]], runs[own])
    edge = np.zeros(len(piece.data) + 1, np.int32)
    np.add.at(edge, start[goes], 1)
    np.add.at(edge, start[goes] + sizes[which][goes] + piece.length - 1, -1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Also drop the other bytes of a character of which a byte goes."""
    character = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
    hit = np.zeros(int(character[-1]) + 1 if len(character) else 1, bool)
    hit[character[gone]] = True
    return hit[character]


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())),
                  ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])


def _cut(length: int, gram: int, buckets: int, whole: bool, keep: list[str]):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        schema = pa.schema([*_CUT, *[docs.schema.field(c) for c in keep]])
        if not docs.num_rows:
            return schema.empty_table()
        piece = Piece(docs, length, gram)
        gone = _removed(piece, found, buckets)
        if whole:
            gone = _whole_characters(piece.data, gone)
        turn = np.zeros(len(gone) + 1, np.int8)
        turn[:-1] += gone
        turn[1:] -= gone
        cut = np.unique(piece.offsets[1:-1])
        cut = cut[(cut > 0) & (cut < len(gone))]
        both = cut[gone[cut] & gone[cut - 1]]  # a run never crosses documents
        begins = np.sort(np.concatenate([np.flatnonzero(turn > 0), both]))
        ends = np.sort(np.concatenate([np.flatnonzero(turn < 0), both]))
        row = np.searchsorted(piece.offsets, begins, side="right") - 1
        per = np.searchsorted(row, np.arange(len(piece.ids) + 1))
        kept_at = np.zeros(len(piece.offsets), np.int64)
        kept_at[1:] = np.cumsum(np.diff(piece.offsets)) - np.diff(np.searchsorted(np.flatnonzero(gone), piece.offsets)).cumsum()
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(piece.ids),
            [None, pa.py_buffer(kept_at.astype(np.int64).tobytes()), pa.py_buffer(piece.data[~gone].tobytes())])
        lists = [pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.array(x - piece.offsets[row]))
                 for x in (begins, ends)]
        return pa.table([piece.ids, pa.array(np.diff(piece.offsets)), *lists, kept.cast(pa.binary()),
                         *[piece.table.column(c) for c in keep]], schema=schema)

    return run


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id",
                   piece_bytes: int = PIECE, whole_characters: bool = False, keep: Sequence[str] = (),
                   hot: int = HOT) -> DataFrame:
    """What is left of every text, and the removed runs.

    Returns ``doc_id``, ``n_bytes``, ``starts`` and ``ends`` (byte places of
    the maximal removed runs), ``kept`` (the remaining bytes) and
    ``carried``, a struct of the columns named in ``keep``. ``gram`` is the
    length of an anchor (8 bytes at least, ``length`` at most). With
    ``whole_characters`` a character of which a byte goes goes whole, so
    that ``kept`` is a valid text. ``hot`` is the number of distinct
    segments of an anchor beyond which they are dealt window by window.

    Null texts count as empty; texts under ``length`` bytes stay whole. A
    null id is larger than all others, and rows with equal ids never remove
    from each other. An empty table gives no rows; other columns are
    ignored. Texts are cut as bytes, so a character may be split.
    """
    if not 8 <= gram <= length:
        raise ValueError("an anchor has 8 bytes at least and is no longer than a window")
    spark = docs.sparkSession
    small_batches(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("digest"),
                       *[F.struct(*[F.col(f"`{c}`") for c in keep]).alias("carried")] * bool(keep))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // piece_bytes))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * piece_bytes)))
    dealt = press_texts(rows.withColumn("piece", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(pieces)).cast("long")))
    masks = dealt.groupBy("piece").applyInArrow(
        tidied(_emit_anchors(length, gram, buckets)), "bucket long, piece long, anchors binary, counts binary") \
        .groupBy("bucket").applyInArrow(tidied(_shared(hot)), "piece long, bucket long, shared binary, hot binary")
    least = dealt.groupBy("piece").cogroup(masks.groupBy("piece")).applyInArrow(
        tidied(_emit_segments(length, gram, buckets)), _SEGMENTS).groupBy("bucket").applyInArrow(
        tidied(_merge_buckets(length)), "piece long, bucket long, runs binary, sizes binary, least binary")
    found = masks.unionByName(least, allowMissingColumns=True)
    result = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("kept", T.BinaryType()), *[f for f in rows.schema.fields if f.name == "carried"]])
    return dealt.groupBy("piece").cogroup(found.groupBy("piece")).applyInArrow(
        tidied(_cut(length, gram, buckets, whole_characters, ["carried"] * bool(keep))), result)


REPEATS_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, p, b[p + 1:p + 50] AS w
  FROM (SELECT doc_id, b, unnest(range(0, greatest(octet_length(b) - 49, 0))) AS p FROM d)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
gone AS (SELECT doc_id, p FROM windows JOIN firsts USING (w) WHERE first < doc_id),
marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens FROM gone),
numbered AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
runs AS (SELECT doc_id, run, min(p) AS s, max(p) + 50 AS e FROM numbered GROUP BY doc_id, run),
parts AS (  -- what stands before each run, and after the last
  SELECT d.doc_id, r.s, substr(h, 2 * coalesce(lag(r.e) OVER o, 0) + 1, 2 * (r.s - coalesce(lag(r.e) OVER o, 0))) AS part,
         r.e - r.s AS n, r.e = max(r.e) OVER (PARTITION BY d.doc_id) AS is_last, substr(h, 2 * r.e + 1) AS rest
  FROM runs r JOIN d USING (doc_id) WINDOW o AS (PARTITION BY d.doc_id ORDER BY r.s)),
cut AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_removed, count(*) AS n_spans,
         string_agg(part, '' ORDER BY s) || max(CASE WHEN is_last THEN rest END) AS kept
  FROM parts GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""
