"""Mixing sources to target weights by hash-threshold histograms.

Each document has a fixed place between 0 and 1 in its source: a digest of
its id and text. A source is repeated a whole number of times, and the rest
of its budget is taken from the documents below a digest threshold, so a
larger budget takes a superset. The threshold is found from sums of words
by digest bucket; only the bucket that the budget ends in is split further.
Nothing is sorted and no list of documents leaves the executors: each level
returns one row per source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat.llm.common import staged, whole_row, word_count

DIGITS = 3  # hex digits added per level: 4,096 buckets a source


def targets(sizes: dict[str | None, int], weights: Sequence[int] = (1, 2, 3), most: int = 3) -> dict[str | None, float]:
    """Words to take from each source.

    Sources stand by code point, null last, and weigh ``weights`` in turn.
    All words together are shared by weight; a source gets at most ``most``
    times its own words, and what is over goes to the others by weight.
    """
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - most * sum(sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0.0
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            break
        capped |= over
    return {s: float(most * sizes[s]) if s in capped else weight[s] * level for s in order}


def _small(rows: DataFrame, n: int, most: int = 100_000) -> DataFrame:
    """One row per source; sent to all executors if there are no more than ``most``."""
    return F.broadcast(rows) if n <= most else rows


def _nearest(before: int, each: int, rows: int, rest: float) -> int:
    """How many of some equal rows bring the sum nearest to ``rest``."""
    k = min(rows, max(0, math.ceil((rest - before) / each + 0.5) - 1))
    while k < rows and 2 * before + (2 * k + 1) * each < 2 * rest:  # the k-th is taken while its middle is below
        k += 1
    while k and not 2 * before + (2 * k - 1) * each < 2 * rest:
        k -= 1
    return k


def _boundary(spark, sized: DataFrame, rest: dict[str, float]) -> dict[str, tuple[str, int, int]]:
    """Per source the digest at which ``rest`` words are reached, and how many of its rows are taken, of how many."""
    found: dict[str, tuple[str, int, int]] = {}
    state = {s: ("", 0) for s, r in rest.items() if r > 0}
    digits = 0
    while state:
        digits += DIGITS
        here = spark.createDataFrame(
            [(s, p, b, rest[s]) for s, (p, b) in state.items()], "key string, prefix string, base long, rest double")
        near = sized.join(_small(here, len(state)), "key").where(F.col("digest").startswith(F.col("prefix")))
        by_bucket = near.groupBy("key", F.substring("digest", 1, digits).alias("bucket"), "base", "rest").agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        running = Window.partitionBy("key").orderBy("bucket")  # at most 4,096 rows a source
        reached = by_bucket.withColumn("upto", F.col("base") + F.sum("size").over(running)) \
            .where(F.col("upto") > F.col("rest")).groupBy("key").agg(
                F.min(F.struct("bucket", "upto", "size", "rows", "low", "high")).alias("b")).select("key", "b.*").collect()
        state = {}
        for r in reached:
            before = r["upto"] - r["size"]
            if r["low"] == r["high"]:
                taken = _nearest(before, r["size"] // r["rows"], r["rows"], rest[r["key"]])  # equal digests, equal sizes
                found[r["key"]] = (r["low"], taken, r["rows"])
            else:
                state[r["key"]] = (r["bucket"], before)
    return found


def _marked(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    """Each row with the key of its source, its number of words and its place in the source."""
    ident = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return docs.select(
        whole_row(docs), F.col(doc_id).alias("doc_id"),
        # a source's key is never null, so that it joins
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("")).alias("key"),
        word_count(F.col(text)).alias("size"), F.md5(ident).alias("digest"))


def _plan(sized: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Per source its size, target, whole copies, and the digest up to which one more is taken.

    ``cut_taken`` of the ``cut_rows`` rows of that digest get the one more.
    """
    spark = sized.sparkSession
    size = {r["key"]: r["size"] for r in sized.groupBy("key").agg(F.sum("size").alias("size")).collect()}
    target = {("s" + s if s is not None else ""): t
              for s, t in targets({k[1:] if k else None: n for k, n in size.items()}, weights, most).items()}
    whole = {k: int(target[k] // n) if n else 0 for k, n in size.items()}
    rest = {k: target[k] - whole[k] * n if whole[k] < most else 0.0 for k, n in size.items()}
    cut = _boundary(spark, sized, rest)
    plan = spark.createDataFrame(
        [(k, n, target[k], whole[k], *cut.get(k, ("", 0, 0))) for k, n in size.items()],
        "key string, source_size long, target double, copies int, cut string, cut_taken long, cut_rows long")
    return _small(plan, len(size))


def _copies(of_cut: Column) -> Column:
    """Copies of a row; ``of_cut`` says whether a row of the boundary digest gets one more."""
    once_more = (F.col("digest") < F.col("cut")) | ((F.col("digest") == F.col("cut")) & of_cut)
    return F.col("copies") + once_more.cast("int")


def _sized(marked: DataFrame) -> DataFrame:
    # the task that wrote a row is stored with it, so that equal rows can be numbered task by task
    return staged(marked.select("doc_id", "key", "size", "digest", F.spark_partition_id().alias("task")), "mix_rows")


def _numbered(equal: DataFrame) -> DataFrame:
    """The rows of a boundary digest with a number ``nth`` (from 1) per source; no task gathers them."""
    before = Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    offsets = equal.groupBy("key", "task").agg(F.count(F.lit(1)).alias("n")).select(
        "key", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(Window.partitionBy("key", "task").orderBy("digest"))
    return equal.withColumn("local", local).join(offsets, ["key", "task"]).withColumn("nth", F.col("offset") + F.col("local"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Words that the mix takes of every document.

    Returns ``doc_id``, ``size`` (words), ``source_size``, ``target`` and
    ``taken`` (``size`` times the copies, 0 to ``most``). The outcome
    depends on the rows alone, so reruns agree.

    Null texts have no words; null sources are one source, the last; of rows
    repeating id and text as many are taken as come nearest to the target
    (which of them does not matter); an empty table gives no rows. Other
    columns of ``docs`` are ignored. The driver holds one row per source.
    """
    sized = _sized(_marked(docs, text, doc_id, source))
    planned = sized.join(_plan(sized, weights, most), "key")
    part = (F.col("digest") == F.col("cut")) & (F.col("cut_taken") > 0) & (F.col("cut_taken") < F.col("cut_rows"))
    result = lambda rows, of_cut: rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies(of_cut)).alias("taken"))
    return result(planned.where(~part), F.col("cut_taken") > 0).unionByName(
        result(_numbered(planned.where(part)), F.col("nth") <= F.col("cut_taken")))


def mix_documents(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs``, unchanged, as often as ``mix_sources`` takes it.

    Rows that repeat id and text are taken or left together here, whichever
    is nearer to the target. A document without words costs nothing; it goes by its digest like the
    others. Texts are not shuffled. Columns may have any names and types.
    """
    marked = _marked(docs, text, doc_id, source)
    taken = marked.join(_plan(_sized(marked), weights, most), "key")
    return taken.select("row", F.explode(F.array_repeat(
        F.lit(0), _copies(2 * F.col("cut_taken") > F.col("cut_rows")))).alias("copy")).select("row.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
ranked AS (  -- sources in the order in which they reach three times their size
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
         coalesce(sum(3 * source_size) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS cap_w
  FROM sources
  WINDOW o AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (  -- it peaks at the first source that stays below it
  SELECT max(CAST(total - caps AS DOUBLE) / CAST(all_w - cap_w AS DOUBLE)) AS level
  FROM ranked WHERE w * (CAST(total - caps AS DOUBLE) / CAST(all_w - cap_w AS DOUBLE)) <= 3 * source_size),
aims AS (
  SELECT source, source_size,
         CASE WHEN w * level > 3 * source_size THEN 3.0::DOUBLE * source_size ELSE w * level END AS target
  FROM sources, level),
budgets AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS copies FROM aims),
rests AS (
  SELECT *, CASE WHEN copies < 3 THEN target - copies * source_size ELSE 0 END AS rest FROM budgets),
placed AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.copies, r.rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.digest ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (copies + CASE WHEN rest > 0 AND upto + upto - size < 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""
