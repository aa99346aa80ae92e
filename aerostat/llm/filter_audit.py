"""Interaction of filters over all their orders, by wide packed counters.

A document is known by the mask of the filters that it fails. Every mask has
one big integer, whose 64-bit fields stand for all (order, step) pairs: 600
for five filters. A field is one where the document would be removed. The
integers of a part are summed as they are, one addition a document (or a
multiplication for equal masks), and no field can carry into the next, as a
long counts the rows. What each step removes, keeps and loses is unpacked
from the sums at the end.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.llm.common import sliced, small_batches, staged
from aerostat.llm.copies import with_group_value

FIELD = 64  # bits of a counter
LANES = 64  # first-level sums of a part
PARTS = 1_000  # parts that a task sums at a time


@lru_cache(maxsize=4)
def orders(n: int) -> list[tuple[int, ...]]:
    return list(permutations(range(n)))


@lru_cache(maxsize=4)
def packed_masks(n: int) -> list[int]:
    """Per mask of failed filters the integer with a one in the field of every step that removes it."""
    out = [0] * (1 << n)
    for mask in range(1 << n):
        for o, order in enumerate(orders(n)):
            step = next((s for s, f in enumerate(order) if mask >> f & 1), None)
            if step is not None:
                out[mask] += 1 << (FIELD * (o * n + step))
    return out


def unpacked(total: int, n: int) -> np.ndarray:
    """The fields of a sum: removed documents by order and step."""
    fields = len(orders(n)) * n
    return np.frombuffer(total.to_bytes(fields * FIELD // 8, "little"), "<u8").astype(np.int64).reshape(-1, n)


def _sums(lost: int) -> pa.Schema:
    return pa.schema([("part", pa.string()), ("lane", pa.int32()), ("docs", pa.int64()),
                      *[(f"sum{i}", pa.binary()) for i in range(lost + 1)]])


def _row(part, lane, docs: int, totals: list[int], width: int) -> dict:
    return {"part": part, "lane": lane, "docs": docs, **{f"sum{i}": t.to_bytes(width, "little") for i, t in enumerate(totals)}}


def _fold(n: int, lost: int):
    """Sum the integers of the documents of a task, part by part."""
    schema, width = _sums(lost), len(orders(n)) * n * FIELD // 8
    flags = [f"lost{i}" for i in range(lost)]

    def run(batches):
        packed = packed_masks(n)
        docs, totals, lane = defaultdict(int), defaultdict(lambda: [0] * (lost + 1)), 0

        def out():
            rows = [_row(p, lane, docs[p], t, width) for p, t in totals.items()]
            docs.clear()
            totals.clear()
            return pa.RecordBatch.from_pylist(rows, schema)

        for b in batches:
            if not b.num_rows:
                continue
            lane = b.column("lane")[0].as_py()
            equal = pa.Table.from_batches([b]).group_by(["part", "mask", *flags]).aggregate([("n", "sum")])
            for r in equal.to_pylist():
                n_docs, one = r["n_sum"], packed[r["mask"]]
                docs[r["part"]] += n_docs
                own = totals[r["part"]]
                own[0] += n_docs * one
                for i, flag in enumerate(flags, 1):
                    if r[flag]:
                        own[i] += n_docs * one
            if len(totals) > PARTS:
                yield out()
        yield out()

    return run


def _added(table: pa.Table, lost: int) -> tuple[int, list[int]]:
    totals = [sum(int.from_bytes(x, "little") for x in table.column(f"sum{i}").to_pylist()) for i in range(lost + 1)]
    return sum(table.column("docs").to_pylist()), totals


def _merge(n: int, lost: int):
    schema, width = _sums(lost), len(orders(n)) * n * FIELD // 8

    def run(table: pa.Table) -> pa.Table:
        docs, totals = _added(table, lost)
        return pa.Table.from_pylist([_row(table.column("part")[0].as_py(), 0, docs, totals, width)], schema)

    return run


def _report(letters: Sequence[str], names: Sequence[str]):
    n = len(letters)
    order_names = ["".join(letters[f] for f in o) for o in orders(n)]
    filters = np.array(orders(n))

    def run(table: pa.Table) -> pa.Table:
        docs, totals = _added(table, len(names))
        removed, *lost = (unpacked(t, n) for t in totals)
        fails, alone, shapley = np.zeros((3, n), np.int64)
        for f in range(n):
            fails[f] = removed[filters[:, 0] == f, 0][0]  # the first filter removes all that fail it
            alone[f] = removed[filters[:, -1] == f, -1][0]  # the last one, those that fail it only
            shapley[f] = removed[filters == f].sum()
        columns = {"part": [table.column("part")[0].as_py()] * filters.size, "filter_order": np.repeat(order_names, n),
                   "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(filters)),
                   "kept": (docs - np.cumsum(removed, axis=1)).ravel(), "removed": removed.ravel(),
                   "redundant": (fails[filters] - removed).ravel(), "unique_fails": alone[filters].ravel(),
                   **{f"{name}_lost": x.ravel() for name, x in zip(names, lost)}, "shapley": shapley[filters].ravel()}
        return pa.table({k: pa.array(v) for k, v in columns.items()})

    return run


def audit(rows: DataFrame, filters: Sequence[str], lost: Sequence[str] = (), part: str = "part", n: str | None = None) -> DataFrame:
    """What each filter removes at each step of each order, per part.

    ``filters`` names boolean columns of ``rows`` (true: fails) by their
    letters, ``lost`` boolean columns whose removed rows are counted beside,
    ``n`` a column with the number of documents that a row stands for.
    Returns ``part``, ``filter_order``, ``step``, ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``<name>_lost`` and ``shapley``.

    A null flag is no failure; a null part is the empty text; no rows, no
    parts. The number of fields is n! * n, so six filters are the most. A
    part held by all tasks is summed in two levels.
    """
    k = len(filters)
    if not 1 <= k <= 6:
        raise ValueError("one to six filters")
    mask = F.lit(0)
    for i, f in enumerate(filters):
        mask = mask + F.when(F.col(f), F.lit(1 << i)).otherwise(F.lit(0))
    some = rows.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.cast("int").alias("mask"),
        (F.col(n) if n else F.lit(1)).cast("long").alias("n"), F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("lane"),
        *[F.coalesce(F.col(c), F.lit(False)).alias(f"lost{i}") for i, c in enumerate(lost)])
    sums = "part string, lane int, docs long" + "".join(f", sum{i} binary" for i in range(len(lost) + 1))
    shape = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long" + "".join(
        f", {c}_lost long" for c in lost) + ", shapley long"
    by_task = some.mapInArrow(_fold(k, len(lost)), sums)
    by_lane = by_task.groupBy("part", "lane").applyInArrow(_merge(k, len(lost)), sums)
    return by_lane.groupBy("part").applyInArrow(_report(list(filters), list(lost)), shape)


# --- five filters on documents ----------------------------------------------------

UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOL = re.compile(rb"[#$%&*|]")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_numbers(text: bytes, step: int = 1 << 20) -> tuple[int, int]:
    """Words and distinct words of a text, of which only a step is split at a time."""
    n, seen, at = 0, set(), 0
    while at < len(text):
        border = _SPACE.search(text, min(at + step, len(text)))
        to = border.start() if border else len(text)
        words = text[at:to].split()  # at the six ASCII white-space bytes
        n += len(words)
        seen.update(words)
        at = to
    return n, len(seen)


def text_flags(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Fails A (short), B (repetitive), C (upper case), D (symbols)."""
    words, distinct = word_numbers(text)
    upper = len(text) - len(text.translate(None, UPPER))
    points = len(text) - int(((np.frombuffer(text, np.uint8) & 0xC0) == 0x80).sum())
    return words < 200, 100 * distinct < 50 * words, 100 * upper > 2 * points, bool(SYMBOL.search(text))


def document_flags(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """``doc_id``, ``part`` and the failures A to E of every document.

    Null texts count as empty. E compares digests of whole texts (SHA-256)
    over the table; null ids take no part in it, and rows that repeat an id
    are no copies of each other. Texts are read once; only digests move.
    """
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(part).cast("string").alias("part"), body.alias("text"),
                       F.unhex(F.sha2(body, 256)).alias("digest"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["part"], rows.schema["digest"],
                           *[T.StructField(c, T.BooleanType()) for c in "ABCD"]])

    def run(batches):
        for b in sliced(batches):
            flags = [text_flags(t.as_buffer().to_pybytes()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("digest"),
                 *[pa.array([f[i] for f in flags], pa.bool_()) for i in range(4)]], schema.names)

    stored = staged(rows.mapInArrow(run, schema), "audit_rows")
    first = with_group_value(stored, "digest", F.min("doc_id"), "first")
    return first.select("doc_id", "part", "A", "B", "C", "D", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).alias("E"))


def audit_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    part: str = "source") -> DataFrame:
    """The audit of the five filters per source, with the good and the toxic documents that each step loses.

    A document is good (toxic) if any label of its id has quality (toxic)
    one. Rows alike in id, part and failures are counted before they meet
    the labels, so an id that holds a third of all rows is a few rows.
    """
    alike = document_flags(docs, text, doc_id, part).groupBy("doc_id", "part", *"ABCDE").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return audit(alike.join(known, alike["doc_id"] == known["label_id"], "left"), "ABCDE", ["good", "toxic"], n="n")


AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
masks AS (
  SELECT doc_id, part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(first < doc_id, false) AS INT) AS mask
  FROM d),
known AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM masks LEFT JOIN known USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & (before + bit) = bit THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit = bit AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & (before + bit) = bit AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & (before + bit) = bit AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM m, (SELECT filter_order, step, bit, CAST(before AS BIGINT) AS before FROM steps) GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
