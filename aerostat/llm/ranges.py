"""Cuts of an ordered table into ranges of near equal bytes, the same on every run."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16  # a table's ids are summed in 2**16 to 2**17 ranges at first
FINER = 8  # bits by which a heavy range is split again

# a place in the order: 0 and 0 for a null id, 1 and the id otherwise; then the first 16 bits of the digest
Place = tuple[int, int, int]


def _sums(rows: DataFrame, shift: int) -> dict[int, int]:
    cell = F.shiftright("id", shift).alias("cell")
    named = rows.where("id IS NOT NULL")
    return {r["cell"]: r["size"] for r in named.groupBy(cell).agg(F.sum("size").alias("size")).collect()}


def _listed(rows: DataFrame, shift: int, cells: list[int]) -> DataFrame:
    frame = rows.sparkSession.createDataFrame([(c,) for c in cells], "listed_cell long")
    return rows.join(F.broadcast(frame), F.shiftright("id", shift) == F.col("listed_cell"), "left_semi")


def _cuts_within(rows: DataFrame, target: int) -> list[Place]:
    """Cuts of each id by the first bits of the digest."""
    prefix = F.conv(F.substring(F.hex("digest"), 1, 4), 16, 10).cast("int").alias("prefix")
    running = Window.partitionBy("id").orderBy("prefix")  # 65,536 rows of an id at most
    sums = rows.groupBy("id", prefix).agg(F.sum("size").alias("size"))
    before = sums.withColumn("nth", F.floor((F.sum("size").over(running) - F.col("size")) / target))
    cuts = before.withColumn("last", F.lag("nth", 1, 0).over(running)).where("nth <> last").collect()
    return [(0, 0, r["prefix"]) if r["id"] is None else (1, r["id"], r["prefix"]) for r in cuts]


def byte_ranges(rows: DataFrame, target: int) -> list[Place]:
    """First places of all ranges but the first, each of about ``target`` bytes, null ids first.

    ``rows`` has ``id`` (long, may be null), ``digest`` (binary) and
    ``size`` (long) and is read a few times. A heavy id is cut by the first
    bits of the digest, so only rows alike in both stay together. The cuts
    depend on the rows alone, not on partitions or samples.

    The driver holds some 100,000 sums, those within heavier ranges, and one
    place per ``target`` bytes; what a heavy id holds is cut on Spark.
    """
    low, high, nulls = rows.agg(F.min("id"), F.max("id"), F.count_if(F.col("id").isNull())).first()
    places: list[Place] = []
    if low is not None:
        shift = max(0, (high - low).bit_length() - CELL_BITS)
        cells = [(c << shift, shift, n) for c, n in _sums(rows, shift).items()]  # first id, bits within, bytes
        while heavy := [c[0] >> shift for c in cells if c[1] and c[1] == shift and c[2] > target]:
            some, finer = set(heavy), max(0, shift - FINER)
            inside = _sums(_listed(rows, shift, heavy), finer)
            cells = [c for c in cells if c[1] != shift or c[0] >> shift not in some] + [
                (c << finer, finer, n) for c, n in inside.items()]
            shift = finer
        held = 0
        for at, (first, _, n) in enumerate(sorted(cells)):
            if (held and held + n > target) or (nulls and not at):
                places.append((1, first, 0))
                held = 0
            held += n
        alone = [c[0] for c in cells if not c[1] and c[2] > target]
        if alone:
            places += _cuts_within(_listed(rows, 0, alone), target)
    if nulls:
        places += _cuts_within(rows.where("id IS NULL"), target)
    return sorted(set(places))


def range_of(places: list[Place], row_id: int | None, digest: bytes) -> int:
    """Number of the range that a row falls into."""
    here = (0, 0) if row_id is None else (1, row_id)
    return bisect_right(places, (*here, int.from_bytes(digest[:2], "big")))
