"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles by the population counts of
their two halves. Two fingerprints within the radius differ by no more than
the radius in these counts, so only tiles of neighbouring counts are
compared: all their pairs, by exclusive-or and bit counts in numpy. A tile
pair returns a spanning forest of its links instead of the links (at most
one row per fingerprint), which keeps every connection; components follow
by star contraction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostat.llm.common import small_batches, staged, whole_row
from aerostat.llm.components import components

TILE = 4096  # fingerprints of a tile, about
SEED = 42


def shingle_hashes(text: str | None, length: int) -> np.ndarray:
    """XXH64 of every run of ``length`` words (of all words if there are fewer)."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= length:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    ends = [*starts[length:], at]
    return np.array([digest(view[s:e - 1], SEED) for s, e in zip(starts, ends)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        piece = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(piece, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, length: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``digest`` of the text and ``fp``, the fingerprint's bits as a signed long (no words: 0)."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(shingle_hashes(t.as_py(), length)) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "digest", "fp"])

    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.md5(body).alias("digest"), body.alias("text")) \
        .mapInArrow(run, "doc_id long, digest string, fp long")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, by hooking and pointer jumping."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, as pairs of fingerprints."""
    both = np.concatenate([a, b])
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = max(1, (1 << 20) // max(len(b), 1))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            root = _roots(len(both), np.concatenate([left, i + at]), np.concatenate([right, j + len(a)]))
            left = np.flatnonzero(root != np.arange(len(both)))
            right = root[left]
    apart = both[left] != both[right]
    return both[left[apart]], both[right[apart]]


def _compare(radius: int):
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                a, b = (batch.column(c)[r].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (0, 1))
                u, v = tile_links(a, b, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = 3, tile: int = TILE) -> DataFrame:
    """Links that connect all distinct fingerprints (``fp``) within ``radius`` bits."""
    half = lambda shift: F.bit_count(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    dealt = fps.select("fp", half(32).alias("high"), half(0).alias("low"))
    # at most 33 * 33 rows
    cells = dealt.groupBy("high", "low").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    tiles = staged(dealt.join(F.broadcast(cells), ["high", "low"]).withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")).groupBy("high", "low", "part").agg(
            F.collect_list("fp").alias("fps")), "tiles")
    near = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)
            if abs(i) + abs(j) <= radius and (i, j) >= (0, 0)]
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near]))
    one = tiles.withColumn("step", step).select(
        (F.col("high") + F.col("step.i")).alias("high"), (F.col("low") + F.col("step.j")).alias("low"),
        ((F.col("step.i") == 0) & (F.col("step.j") == 0)).alias("same"), F.col("part").alias("own"), F.col("fps").alias("a"))
    pairs = one.join(tiles, ["high", "low"]).where("NOT same OR own <= part").select("a", F.col("fps").alias("b"))
    return pairs.repartition(F.xxhash64("a", "b")).mapInArrow(_compare(radius), "a long, b long")


def _by_fingerprint(known: DataFrame, radius: int) -> DataFrame:
    """``fp`` and ``root``, the fingerprint that names its component."""
    found = components(links(known.select("fp"), radius))
    return known.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, length: int = 3, radius: int = 3, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """Component of every document under links of at most ``radius`` differing bits.

    Returns ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id reachable, the document's own included.

    Null, empty and blank texts have fingerprint zero and are linked like
    others. Null ids never name a component unless all its ids are null;
    repeated rows each get a row; an empty table gives none; texts are read
    whole; other columns are ignored.
    """
    own = staged(fingerprints(docs, length, text, doc_id).drop("digest"), "fingerprints")
    known = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = _by_fingerprint(known, radius)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return own.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, length: int = 3, radius: int = 3, text: str = "text",
                         doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, unchanged: the smallest id (null last), of several the smallest text digest.

    Rows that repeat that id and text are one document: of those that differ
    in other columns the least by these, as text, stays, so reruns agree.
    Columns may have any names and types; only the chosen keys meet the
    texts again.
    """
    own = staged(fingerprints(docs, length, text, doc_id), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    known = own.groupBy("fp").agg(first)
    chosen = _by_fingerprint(known, radius).groupBy("root").agg(F.min("first").alias("first"))
    key = lambda i, d: F.concat(F.coalesce(i.cast("string"), F.lit("")), F.lit(":"), d)
    stay = chosen.select(key(F.col("first.doc_id"), F.col("first.digest")).alias("key"))
    others = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (doc_id, text)]))
    body = F.coalesce(F.col(text), F.lit(""))
    whole = docs.select(whole_row(docs), key(F.col(doc_id).cast("long"), F.md5(body)).alias("key"), others.alias("others"))
    return whole.join(stay, "key", "left_semi").groupBy("key").agg(F.min_by("row", "others").alias("row")).select("row.*")
