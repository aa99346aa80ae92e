"""Katz backoff language model.

Counts of n-grams are discounted by Good-Turing; what the discounts free in
a context goes to the words not seen there, by a backoff weight that makes
each distribution sum to one exactly. A token's probability is evaluated
recursively from the lowest order up.

Documents are dealt into pieces of bounded size. A piece sends each distinct
n-gram it holds, as a digest with its training count, to a bucket of that
digest; the bucket returns the corpus count to every piece that asked. The
counts are kept in a table partitioned by order. A second round sums, per
context, the mass of its seen words, and keeps the backoff weights in
another such table; a context that stands in one piece only is summed there.
Every round is a job of its own, whose shuffle files go when its table is
written. A frequent word, word pair or copied document is one entry
a piece, however often it stands there, and n-grams are dealt by their own
digest and not by their context, so nothing is hot.

A bucket is a range of the digests, so their number grows with the corpus
without an end. Digests have 48 bits inside a bucket, until with 65,536
buckets (1 TB of text) all 64 bits are in use.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import (free_shuffles, joined, mix, press_texts, pressed, small_batches, staged, tidied, unpress_texts, unpressed,
                                 word_hashes, word_spans)

PIECE = 8 << 20  # text bytes of a piece, about
CUTOFF = 5  # counts above are not discounted
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0x9FB21C651E98DF25)
_KEY = 48  # bits of a key inside its bucket


# --- discounts ------------------------------------------------------------------

def discounts(counts_of_counts: list[int], cutoff: int = CUTOFF) -> list[float]:
    """Factor of each count 1 .. ``cutoff``; counts above keep all (factor 1).

    ``counts_of_counts[r - 1]`` is the number of n-grams seen r times, up to
    r = cutoff + 1. The cutoff is lowered until Good-Turing gives factors
    between 0 and 1; if none does, an absolute discount serves.
    """
    n = [0, *counts_of_counts]
    for k in range(cutoff, 0, -1):
        if all(n[1:k + 2]):
            common = (k + 1) * n[k + 1] / n[1]
            if common < 1:
                d = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, k + 1)]
                if all(0 < x < 1 for x in d):
                    return d + [1.0] * (cutoff - k)
    off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return [(r - off) / r for r in range(1, cutoff + 1)]


@dataclass(frozen=True)
class Totals:
    """Corpus figures of every order; a few numbers each."""

    tokens: int
    types: int
    factors: tuple[tuple[float, ...], ...]  # by order, by count
    unknown: float  # probability of all unseen tokens together
    scale: float  # of the unigrams, 1 unless nothing was freed

    def factor(self, order: int, count: np.ndarray) -> np.ndarray:
        table = np.array([0.0, *self.factors[order - 1], 1.0])
        return table[np.minimum(count, len(table) - 1)]


def totals(rows: list, order: int) -> Totals:
    by = {r["n"]: r for r in rows}
    factors, unknown, scale, tokens, types = [], 1.0, 1.0, 0, 0
    for m in range(1, order + 1):
        r = by.get(m)
        stats = list(r["stats"]) if r else [0] * (CUTOFF + 3)
        factors.append(tuple(discounts(stats[:CUTOFF + 1])))
        if m == 1:
            types, tokens = stats[-2], stats[-1]
            freed = sum((1 - d) * (c + 1) * n for c, (d, n) in enumerate(zip(factors[0], stats)))
            if tokens:
                unknown = freed / tokens if freed else 1 / (tokens + 1)
                scale = 1.0 if freed else tokens / (tokens + 1)
    return Totals(tokens, types, tuple(factors), unknown, scale)


# --- packing --------------------------------------------------------------------

def numbered(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys (below 2**bits), the number of each key among them, and where each distinct one stands first.

    One sort of plain numbers, the upper bits of a key beside its place,
    which is several times faster than sorting places by keys. Keys that
    differ only in the bits left out may come in the wrong order; then the
    places are sorted.
    """
    n = len(keys)
    low = n.bit_length()
    packed = (keys >> np.uint64(max(0, bits + low - 64)) << np.uint64(low)) | np.arange(n, dtype=np.uint64)
    packed.sort()
    place = (packed & np.uint64((1 << low) - 1)).astype(np.int64)
    del packed
    ordered = keys[place]
    if (ordered[1:] < ordered[:-1]).any():
        place = np.argsort(keys, kind="stable")
        ordered = keys[place]
    new = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    number = np.empty(n, np.int64)
    number[place] = np.cumsum(new) - 1
    return ordered[new], number, place[new]


def _pack_keys(keys: np.ndarray) -> bytes:
    """Number of keys, then the steps between the sorted 48-bit keys, byte by byte; the upper two compressed."""
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return len(keys).to_bytes(8, "little") + planes[:4].tobytes() + pressed(planes[4:6].tobytes())


def _unpack_keys(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :4] = np.frombuffer(raw, np.uint8, 4 * n, offset=8).reshape(4, n).T
    out[:, 4:6] = np.frombuffer(unpressed(raw[8 + 4 * n:]), np.uint8).reshape(2, n).T
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte a count; counts of 255 and more follow in full; compressed."""
    return pressed(np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes())


def _unpack_counts(raw: bytes, n: int) -> np.ndarray:
    raw = unpressed(raw)
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", offset=n)
    return out


def _pack_masses(masses: np.ndarray) -> bytes:
    """Number of distinct masses, these, and the number of each, byte by byte and compressed; most masses repeat."""
    values, of = np.unique(masses, return_inverse=True)
    return len(values).to_bytes(8, "little") + values.tobytes() + pressed(
        of.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_masses(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    of = np.frombuffer(unpressed(raw[8 + 8 * n:]), np.uint8).reshape(4, -1).T
    return np.frombuffer(raw, np.float64, n, offset=8)[np.ascontiguousarray(of).view("<u4").ravel()]


@dataclass(frozen=True)
class Deal:
    """Buckets as ranges of equal width of the upper ``bits`` bits of the digests."""

    buckets: int

    @property
    def bits(self) -> int:
        return min(64, _KEY + self.buckets.bit_length() - 1)

    @property
    def width(self) -> int:
        return -(-(1 << self.bits) // self.buckets)  # 2**48 at most

    def keys(self, digests: np.ndarray) -> np.ndarray:
        return digests >> np.uint64(64 - self.bits)

    def stretches(self, keys: np.ndarray):
        """(bucket, from, to) of each bucket in sorted keys."""
        bucket = (keys // np.uint64(self.width)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip(np.concatenate([[0], cut]), np.append(cut, len(bucket))):
            if b > a:
                yield int(bucket[a]), int(a), int(b)

    def packed(self, bucket: int, keys: np.ndarray) -> bytes:
        return _pack_keys(keys - np.uint64(bucket * self.width))


# --- a piece of the corpus --------------------------------------------------------

class Piece:
    """Tokens of some documents and their distinct n-grams, order by order.

    ``grams[m]`` are the sorted keys of order m, ``of[m]`` the number of the
    m-gram that ends at each token (-1: too near to the start of its text).
    """

    def __init__(self, table: pa.Table, order: int, buckets: int):
        self.deal = Deal(buckets)
        table = table.sort_by([("doc_id", "ascending"), ("digest", "ascending")]).combine_chunks()
        data, offsets = joined(unpress_texts(table.column("text")))
        self.docs, self.order = table, order
        start, end, row = word_spans(data, offsets)
        n = len(offsets) - 1
        lower = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
        self.row = np.zeros(len(start) + n, np.int64)
        token = np.full(len(start) + n, _END, np.uint64)
        place = np.arange(len(start)) + row  # an end stands before each later document
        token[place] = word_hashes(lower, start, end)
        self.length = np.bincount(row, minlength=n).astype(np.int64) + 1
        self.row = np.repeat(np.arange(n), self.length)
        first = np.cumsum(self.length) - self.length
        self.nth = np.arange(len(token)) - first[self.row]
        train = ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        self.train = train[self.row]
        self.grams, self.of, gram = {}, {}, token
        for m in range(1, order + 1):
            if m > 1:
                gram = mix(np.concatenate([[np.uint64(0)], gram[:-1]]) * _STEP + token)
            at = np.flatnonzero(self.nth >= m - 1)
            self.grams[m], number, _ = numbered(self.deal.keys(gram[at]), self.deal.bits)
            self.of[m] = np.full(len(token), -1, np.int64)
            self.of[m][at] = number

    def train_counts(self, m: int) -> np.ndarray:
        at = (self.of[m] >= 0) & self.train
        return np.bincount(self.of[m][at], minlength=len(self.grams[m]))


class Answers:
    """What the buckets returned to a piece."""

    def __init__(self, piece: Piece, table: pa.Table, model: Totals):
        self.count = {m: np.zeros(len(g), np.int64) for m, g in piece.grams.items()}
        self.own = {m: np.zeros(len(g), bool) for m, g in piece.grams.items()}
        self.alone = {m: np.zeros(len(g), bool) for m, g in piece.grams.items()}  # in no other piece
        self.weight = {m: np.full(len(g), np.nan) for m, g in piece.grams.items()}  # of the contexts asked for
        where = {m: {b: (s, e) for b, s, e in piece.deal.stretches(g)} for m, g in piece.grams.items()}
        rows = table.to_pylist()
        for r in rows:
            if r["totals"] is not None:
                m = r["n"]
                s, e = where[m][r["bucket"]]
                self.count[m][s:e] = _unpack_counts(r["totals"], e - s)
                for bits, c in ((self.own, "owner"), (self.alone, "alone")):
                    bits[m][s:e] = np.unpackbits(np.frombuffer(r[c], np.uint8), count=e - s)
        asked = {}
        for r in rows:
            if r["totals"] is None:
                m = r["n"]
                if m not in asked:
                    asked[m] = _asked(piece, self, model, m)
                s, e = where[m][r["bucket"]]
                self.weight[m][s + np.flatnonzero(asked[m][s:e])] = np.frombuffer(r["weights"])


def _asked(piece: Piece, got: Answers, model: Totals, m: int) -> np.ndarray:
    """Which contexts of order ``m`` a piece needs the masses of and cannot sum itself."""
    at = np.flatnonzero(piece.of[m + 1] >= 0)
    count, context = got.count[m + 1][piece.of[m + 1][at]], piece.of[m][at - 1]
    need = np.zeros(len(piece.grams[m]), bool)
    whole = (count == 0) | (model.factor(m + 1, count) == 1)  # its context's sums decide
    need[context[(got.count[m][context] > 0) & whole]] = True
    return need & ~got.alone[m]


def _weights(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Backoff weight of contexts by their masses; negative and per count if no count was discounted."""
    full = high >= 1 - 1e-12
    weight = np.where(full, 1, 1 - high) / np.maximum(1 - low, 1e-300)  # all words seen: never asked for
    return np.where(full, -weight, weight)


def _sums(piece: Piece, got: Answers, model: Totals, m: int, p: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masses of the seen words of each context of order ``m``, over the longer n-grams that are ``mine``."""
    at = np.flatnonzero(piece.of[m + 1] >= 0)
    gram = piece.of[m + 1][at]
    one = np.zeros(len(mine), np.int64)
    one[gram] = at  # a place of each
    one = one[mine & (got.count[m + 1] > 0)]
    c, own = got.count[m + 1][piece.of[m + 1][one]], piece.of[m][one - 1]
    n = len(piece.grams[m])
    return (np.bincount(own, model.factor(m + 1, c) * c / got.count[m][own], minlength=n),
            np.bincount(own, p[one], minlength=n))


def evaluate(piece: Piece, got: Answers, model: Totals, order: int) -> np.ndarray:
    """Probability of every token under the model of ``order``, recursively."""
    if order == 1:
        count = got.count[1][piece.of[1]]
        known = model.factor(1, count) * count / max(model.tokens, 1) * model.scale
        return np.where(count > 0, known, model.unknown)
    p = evaluate(piece, got, model, order - 1)
    at = np.flatnonzero(piece.of[order] >= 0)
    count = got.count[order][piece.of[order][at]]
    context = piece.of[order - 1][at - 1]
    total = got.count[order - 1][context]
    alone = got.alone[order - 1]  # all n-grams of such a context are here
    sums = _sums(piece, got, model, order - 1, p, np.ones(len(piece.grams[order]), bool))
    weight = np.where(alone, _weights(*sums), got.weight[order - 1])[context]
    full = weight < 0  # no count was discounted: the context counts once more
    base = total + full
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = model.factor(order, count) * count / base
        unseen = np.where(full, -weight / base, weight) * p[at]
    p[at] = np.where(total == 0, p[at], np.where(count > 0, seen, unseen))
    return p


# --- Spark steps ------------------------------------------------------------------

def _emit(order: int, buckets: int):
    schema = pa.schema([("n", pa.int32()), ("bucket", pa.int64()), ("piece", pa.int64()),
                        ("keys", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        number, piece = table.column("piece")[0].as_py(), Piece(table, order, buckets)
        rows = []
        for m, grams in piece.grams.items():
            counts = piece.train_counts(m)
            rows += [{"n": m, "bucket": b, "piece": number, "keys": piece.deal.packed(b, grams[s:e]),
                      "counts": _pack_counts(counts[s:e])} for b, s, e in piece.deal.stretches(grams)]
        return pa.Table.from_pylist(rows, schema)

    return run


def _total(table: pa.Table) -> pa.Table:
    """Corpus counts of one order and bucket, for each piece that asked, and one row of figures."""
    keys = [_unpack_keys(x) for x in table.column("keys").to_pylist()]
    counts = [_unpack_counts(x, len(k)) for x, k in zip(table.column("counts").to_pylist(), keys)]
    _, number, first = numbered(np.concatenate(keys), _KEY)
    count = np.bincount(number, weights=np.concatenate(counts)).astype(np.int64)
    own = np.zeros(len(number), bool)
    own[first] = True  # one piece speaks for each n-gram
    alone = (np.bincount(number) == 1)[number]
    seen = count[count > 0]
    stats = [*np.bincount(np.minimum(seen, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].tolist(),
             len(seen), int(seen.sum())]
    n, bucket, at, rows = table.column("n")[0].as_py(), table.column("bucket")[0].as_py(), 0, []
    for piece, k in zip(table.column("piece").to_pylist(), keys):
        rows.append({"n": n, "bucket": bucket, "piece": piece, "totals": _pack_counts(count[number[at:at + len(k)]]),
                     "owner": np.packbits(own[at:at + len(k)]).tobytes(), "alone": np.packbits(alone[at:at + len(k)]).tobytes()})
        at += len(k)
    rows.append({"n": n, "bucket": bucket, "stats": stats})
    return pa.Table.from_pylist(rows, pa.schema([
        ("n", pa.int32()), ("bucket", pa.int64()), ("piece", pa.int64()), ("totals", pa.binary()),
        ("owner", pa.binary()), ("alone", pa.binary()), ("stats", pa.list_(pa.int64()))]))


def _contexts(buckets: int, m: int, model: Totals):
    """Masses of the seen words of the contexts of order ``m``, from the piece that speaks for each n-gram.

    Contexts that stand in one piece only are left to that piece. Also names the contexts whose sums this piece will need (``asked``).
    """
    schema = pa.schema([("bucket", pa.int64()), ("piece", pa.int64()), ("keys", pa.binary()), ("high", pa.binary()),
                        ("low", pa.binary()), ("asked", pa.binary())])

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        number, piece = docs.column("piece")[0].as_py(), Piece(docs, m + 1, buckets)
        got = Answers(piece, found, model)
        p = evaluate(piece, got, model, m)
        need = _asked(piece, got, model, m)
        high, low = _sums(piece, got, model, m, p, got.own[m + 1])
        some = np.flatnonzero((need | (high > 0)) & ~got.alone[m])
        keys = piece.grams[m][some]
        high, low = high[some], low[some]
        rows = [{"bucket": b, "piece": number, "keys": piece.deal.packed(b, keys[s:e]), "high": _pack_masses(high[s:e]),
                 "low": low[s:e][high[s:e] > 0].tobytes(), "asked": np.packbits(need[some[s:e]]).tobytes()}
                for b, s, e in piece.deal.stretches(keys)]
        return pa.Table.from_pylist(rows, schema)

    return run


def _masses(m: int):
    schema = pa.schema([("n", pa.int32()), ("bucket", pa.int64()), ("piece", pa.int64()), ("weights", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")  # sums in one order, so reruns agree
        keys = [_unpack_keys(x) for x in table.column("keys").to_pylist()]
        _, number, _ = numbered(np.concatenate(keys), _KEY)
        mass = np.concatenate([_unpack_masses(x) for x in table.column("high").to_pylist()])
        high = np.bincount(number, mass)
        low = np.bincount(number[mass > 0], np.concatenate([np.frombuffer(x) for x in table.column("low").to_pylist()]),
                          minlength=len(high))
        weight = _weights(high, low)
        rows, at = [], 0
        for bucket, piece, k, asked in zip(*(table.column(c).to_pylist() for c in ("bucket", "piece")), keys,
                                           table.column("asked").to_pylist()):
            mine = np.unpackbits(np.frombuffer(asked, np.uint8), count=len(k)).astype(bool)
            of = number[at:at + len(k)][mine]
            at += len(k)
            if len(of):
                rows.append({"n": m, "bucket": bucket, "piece": piece, "weights": weight[of].tobytes()})
        return pa.Table.from_pylist(rows, schema)

    return run


def _scores(order: int, buckets: int, model: Totals):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        piece = Piece(docs, order, buckets)
        got = Answers(piece, found, model)
        n = len(piece.length)
        count = got.count[1][piece.of[1]]
        base = np.log10((count + 1) / (model.tokens + model.types + 1))
        score = np.log10(evaluate(piece, got, model, order))
        return pa.table([
            piece.docs.column("doc_id"), piece.docs.column("held_out"), pa.array(piece.length),
            pa.array(np.bincount(piece.row, count > 0, minlength=n).astype(np.int64)),
            pa.array(np.bincount(piece.row, base, minlength=n)), pa.array(np.bincount(piece.row, score, minlength=n))],
            schema=schema)

    return run


_FOUND = "n int, bucket long, piece long, weights binary"


def score_texts(docs: DataFrame, held_out: Column, order: int = 2, text: str = "text", doc_id: str = "doc_id",
                piece_bytes: int = PIECE) -> DataFrame:
    """Learn a model of ``order`` words from the rows not ``held_out`` and score every row's whole text.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (add-one unigrams) and ``score``, both log10 probabilities.

    Tokens never seen in training are one unknown token together, which
    gets the mass that the unigram discounts free. A context whose counts
    are all above the cutoff frees nothing; it counts once more, and that
    share goes to the unseen words.

    Null texts are empty and consist of an end; a null ``held_out`` counts
    as held out; repeated rows each get a row; an empty table gives none;
    without training rows every token is unknown; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"),
                       body.alias("text"), F.xxhash64(body).alias("digest"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(least, -(-total // piece_bytes))
    buckets = max(least, -(-total // (2 * piece_bytes)))
    dealt = press_texts(rows.withColumn("piece", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(pieces)).cast("long")))
    counts = staged(dealt.groupBy("piece").applyInArrow(
        tidied(_emit(order, buckets)), "n int, bucket long, piece long, keys binary, counts binary").groupBy("n", "bucket").applyInArrow(
        tidied(_total), "n int, bucket long, piece long, totals binary, owner binary, alone binary, stats array<bigint>"), "ngrams", by="n")
    figures = counts.where("stats IS NOT NULL").groupBy("n").agg(
        F.array(*[F.sum(F.col("stats")[i]) for i in range(CUTOFF + 3)]).alias("stats")).collect()  # a row an order
    model = totals(figures, order)
    free_shuffles(spark)
    found = counts.where("piece IS NOT NULL").drop("stats")
    for m in range(1, order):
        masses = dealt.groupBy("piece").cogroup(found.where(F.col("n") <= m + 1).groupBy("piece")).applyInArrow(
            tidied(_contexts(buckets, m, model)),
            "bucket long, piece long, keys binary, high binary, low binary, asked binary").groupBy("bucket").applyInArrow(
            tidied(_masses(m)), _FOUND)
        found = found.unionByName(staged(masses, "weights", by="n"), allowMissingColumns=True)
        free_shuffles(spark)
    if order == 1:
        found = found.withColumn("weights", F.lit(None).cast("binary"))
    return dealt.groupBy("piece").cogroup(found.groupBy("piece")).applyInArrow(
        tidied(_scores(order, buckets, model)), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "score double").withColumn("train_tokens", F.lit(model.tokens).cast("long"))
