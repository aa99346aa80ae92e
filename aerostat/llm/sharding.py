"""Sharding by minimax contiguous partition.

Documents with equal texts form an atomic group. Groups stand in the order
of their text digest; shards are runs of consecutive groups, and the largest
shard is as small as any such cut allows.

The driver never holds a list of groups. It holds the byte sums of digest
ranges (65,536 at first), binary-searches the smallest capacity for which a
greedy walk needs no more than ``n_shards`` shards, and splits only those
ranges in which a cut can fall, until each of them is a single group. Per
level that is one aggregation on Spark and at most a few hundred ranges
times 256 rows on the driver, at any input size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat.llm.common import staged

FIRST_DIGITS, MORE_DIGITS = 4, 2  # hex digits of a first range; added by each split


def greedy_cuts(sums: np.ndarray, n_shards: int, capacity: int) -> list[int]:
    """Position after each shard when each takes all that still fits.

    ``sums`` are running totals with a leading zero. A range that exceeds
    the capacity by itself stops the walk where it stands.
    """
    at, cuts = 0, []
    for _ in range(n_shards):
        at = max(at, int(np.searchsorted(sums, sums[at] + capacity, side="right")) - 1)
        cuts.append(at)
    return cuts


def smallest_capacity(sizes: np.ndarray, n_shards: int) -> int:
    """Smallest capacity whose greedy walk covers all ranges (binary search)."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    low, high = -(-int(sums[-1]) // n_shards), int(sums[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(sums, n_shards, middle)[-1] == len(sizes):
            high = middle
        else:
            low = middle + 1
    return low


def _ranges(rows: DataFrame, digits: int) -> list[tuple[str, int, str, str]]:
    got = (
        rows.groupBy(F.substring("group", 1, digits).alias("prefix"))
        .agg(F.sum("size").alias("size"), F.min("group").alias("low"), F.max("group").alias("high"))
        .collect()
    )
    return sorted((r["prefix"], r["size"], r["low"], r["high"]) for r in got)


def _open_ranges(parts: list[tuple[str, int, str, str]], n_shards: int) -> set[str]:
    """Ranges of several groups in which a cut of the best partition can fall."""
    sizes = np.array([p[1] for p in parts], dtype=np.int64)
    several = np.array([p[2] != p[3] for p in parts])
    sums = np.concatenate([[0], np.cumsum(sizes)])
    least = max(-(-int(sums[-1]) // n_shards), int(sizes[~several].max(initial=0)))
    if (heavy := several & (sizes > least)).any():
        return {parts[i][0] for i in np.flatnonzero(heavy)}
    most = smallest_capacity(sizes, n_shards)
    found: set[str] = set()
    for k, low in enumerate(greedy_cuts(sums, n_shards, least)[:-1], 1):
        high = int(np.searchsorted(sums, min(k * most, int(sums[-1])), side="left"))
        found |= {parts[i][0] for i in range(low, min(high + 1, len(parts))) if several[i]}
    return found


def minimax_cuts(rows: DataFrame, n_shards: int) -> list[str]:
    """First group of every shard but the first (fewer if groups run out).

    ``rows`` has ``group`` (hexadecimal digest) and ``size`` (positive long).
    """
    digits = {}
    parts = _ranges(rows, FIRST_DIGITS)
    digits.update({p[0]: FIRST_DIGITS for p in parts})
    while parts and (split := _open_ranges(parts, n_shards)):
        kept = [p for p in parts if p[0] not in split]
        for length in sorted({len(p) for p in split}):
            some = sorted(p for p in split if len(p) == length)
            inside = rows.where(F.substring("group", 1, length).isin(some))
            kept += _ranges(inside, length + MORE_DIGITS)
        parts = sorted(kept, key=lambda p: p[2])
    if not parts:
        return []
    sizes = np.array([p[1] for p in parts], dtype=np.int64)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    cuts = greedy_cuts(sums, n_shards, smallest_capacity(sizes, n_shards))
    return [parts[c][2] for c in dict.fromkeys(cuts) if c < len(parts)]


def shard_documents(
    docs: DataFrame,
    n_shards: int = 16,
    text: str = "text",
    doc_id: str = "doc_id",
    rows_per_cell: int = 200_000,
) -> DataFrame:
    """Assign every document to a shard; shard sizes are near equal in bytes.

    Returns ``doc_id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``,
    ``law`` (``bytes``), ``shard``, ``slot`` (from 0 without gaps in each
    shard) and ``grown_shard`` (null under this law).

    A null text counts as the empty text and shares its group. Repeated rows
    and null ids each get a slot of their own; an empty table gives no rows;
    a group above the fair share fills a shard alone. Other columns of
    ``docs`` are ignored. Texts are read once; only digests are shuffled.

    Slots are numbered in cells (a hash of id, digest and the task that read
    the row, within the shard), so that neither a shard nor a group of
    copies or of equal rows is sorted in one task. The cells' offsets that
    are broadcast are a row of 24 bytes per ``rows_per_cell`` rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = staged(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.md5(body).alias("group"),
        F.spark_partition_id().alias("task"),  # stored, so that it is the same in all that follows
    ), "shard_rows")
    cuts = minimax_cuts(rows, n_shards)
    shard: Column = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("group") >= F.lit(cut)).cast("int")
    cells = max(256, -(-rows.count() // (n_shards * rows_per_cell)))
    placed = rows.withColumn("shard", shard).withColumn(
        "cell", F.pmod(F.xxhash64("doc_id", "group", "task"), F.lit(cells)).cast("int"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "group")
    return placed.withColumn("nth", F.row_number().over(inside)).join(
        F.broadcast(offsets), ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
