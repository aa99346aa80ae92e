"""Serving table maintenance from the clean dataset (entry B).

Two forms:

* ``load`` — the recommended, idempotent form: the serving table is
  partitioned by ``ingest_date`` and a run overwrites exactly the days it
  loads. Rerunning a day changes nothing.
* ``replace_day`` / ``backfill`` — the original delete-by-``date`` +
  append semantics (date derived from the arrival time, not the file day),
  including its quirks: overnight arrivals loaded one step earlier are
  deleted by the next step, and re-running a day duplicates rows dated
  other than that day. Two physical modes:

  - ``mode="version"`` (default): the whole table is rewritten as a new
    version and swapped in — atomic for readers, cost proportional to the
    table;
  - ``mode="partition"``: the table is partitioned by ``date``; a delete is
    a partition overwrite and the batch is appended, so the cost is
    proportional to the batch, never the table, but a reader (or a failure)
    between the statements sees a half-done state.

  A name keeps the mode it was created in; the other mode raises.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat import schemas
from aerostat.functions.scalars import to_day, wall_clock_timestamp
from aerostat.operators.sinks import (
    backfill_date_partitions,
    backfill_rows,
    create_table_if_absent,
    publish_version,
    replace_date_partition,
    replace_rows,
    write_partitioned,
)
from aerostat.sources.tables import scan_parquet, scan_partitions


def serving_rows(clean: DataFrame) -> DataFrame:
    """Clean rows -> the 13-column serving contract (+ ``ingest_date`` if present).

    ``arrival_time`` text becomes a wall-clock ``timestamp_ntz`` and
    ``date`` its calendar date (P6, X4, X5); blank text is null, malformed
    text fails the load (ANSI).
    """
    ts = wall_clock_timestamp(F.col("arrival_time"))
    out = clean.withColumn("arrival_time", ts).withColumn("date", to_day(ts))
    cols = [F.col(f.name).cast(f.dataType) for f in schemas.SERVING.fields]
    extra = ["ingest_date"] if "ingest_date" in clean.columns else []
    return out.select(*cols, *extra)


def read_clean(spark: SparkSession, clean_root: str, days: Sequence[str | dt.date] | None = None,
               part_glob: str | None = None) -> DataFrame:
    """Clean dataset, or only the folders of ``days``.

    A requested day that was never written fails at analysis
    (``PATH_NOT_FOUND``, S4); a day written without rows reads as no rows.
    """
    if days is None:
        return scan_parquet(spark, clean_root, part_glob, schemas.CLEAN_STORED)
    return scan_partitions(spark, clean_root, "ingest_date", days, part_glob, schemas.CLEAN_STORED)


def load(spark: SparkSession, clean_root: str, serving_root: str, days: Sequence[str | dt.date]) -> int:
    """Idempotent load: overwrite the serving partitions of ``days``.

    Raises before the first write if a day was never landed; a day landed
    without rows empties its partition. Returns the rows written, counted
    inside the write job (A8).
    """
    rows = schemas.check_sink(serving_rows(read_clean(spark, clean_root, days)), schemas.SERVING, ("ingest_date",))
    return write_partitioned(rows, serving_root, "ingest_date", days)


def ensure_serving_table(spark: SparkSession, table: str, location: str) -> None:
    """The 13-column serving table, partitioned by ``date`` (K4).

    Raises ``ValueError`` if the name shows a published version instead.
    """
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        raise ValueError(f"{table} shows a published version; use the version mode")
    create_table_if_absent(spark, table, schemas.SERVING, location, ["date"])


def replace_day(spark: SparkSession, table: str, table_root: str, clean_root: str, day: str | dt.date,
                mode: str = "version") -> str:
    """Original single-day load: delete rows with ``date = day``, append the day's batch (K2).

    Raises before the first write if the day was never landed.
    """
    batch = schemas.check_sink(serving_rows(read_clean(spark, clean_root, [day])).drop("ingest_date"), schemas.SERVING)
    if mode == "partition":
        ensure_serving_table(spark, table, table_root)
        replace_date_partition(spark, table, batch, "date", day)
        return table_root
    if mode != "version":
        raise ValueError(f"unknown mode {mode!r}")
    if spark.catalog.tableExists(table):
        existing = spark.table(table)
        new = replace_rows(existing, batch, "date", dt.date.fromisoformat(str(day)))
    else:
        new = batch
    return publish_version(spark, new, table, table_root)


def backfill(spark: SparkSession, table: str, table_root: str, clean_root: str,
             start: str | dt.date, end: str | dt.date, mode: str = "version") -> str:
    """Original backfill: ``replace_day`` for each day start..end ascending (K7).

    Computed in one set-based job by the closed form in
    ``operators.sinks.backfill_rows`` rather than one job per day. Raises
    before the first write if any day of the window was never landed.
    """
    s, e = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    days = [s + dt.timedelta(days=i) for i in range((e - s).days + 1)]
    batches = schemas.check_sink(serving_rows(read_clean(spark, clean_root, days)), schemas.SERVING, ("ingest_date",))
    batches = batches.withColumnRenamed("ingest_date", "file_day")
    if mode == "partition":
        ensure_serving_table(spark, table, table_root)
        backfill_date_partitions(spark, table, batches, "file_day", "date", s, e)
        return table_root
    if mode != "version":
        raise ValueError(f"unknown mode {mode!r}")
    if spark.catalog.tableExists(table):
        existing = spark.table(table)
        new = backfill_rows(existing, batches, "file_day", "date", s, e)
    else:
        empty = batches.drop("file_day").limit(0)
        new = backfill_rows(empty, batches, "file_day", "date", s, e)
    return publish_version(spark, new, table, table_root)
