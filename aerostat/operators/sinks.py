"""Writers and serving-table maintenance.

Plain Parquet has no row delete, so the serving table is maintained two
ways:

* by ``ingest_date`` partition with dynamic partition overwrite — a rerun
  of a day replaces exactly that day's partition, by nothing if it is now
  empty (idempotent, no read of the rest of the table);
* the original delete-by-``date`` + append semantics, either on a table
  partitioned by ``date`` (``replace_date_partition`` /
  ``backfill_date_partitions``: only the affected date partitions are
  rewritten, cost follows the batch) or as a whole new version swapped in
  (``replace_rows`` / ``backfill_rows`` + ``publish_version``; Spark
  refuses to overwrite a path it is reading).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.functions.scalars import date_literal, is_blank, wall_clock_timestamp
from aerostat.operators.aggregate import content_sums, observed_values
from aerostat.operators.filters import not_on_day
from aerostat.session import scratch_path


# --- K6 / K1 --------------------------------------------------------------

def land_json(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Land records as JSON lines (K6).

    JSON lines split across tasks on read, unlike one multi-line array.
    Without ``partition_col`` the folder is replaced; with it (normally
    ``ingest_date``) many days land in one job, one folder per day, and only
    the days present are replaced.
    """
    w = df.write.mode("overwrite")
    if partition_col:
        w = df.hint("rebalance", partition_col).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    w.json(path)


def land_arrays(df: DataFrame, path: str, file_col: str, order: Sequence[str]) -> None:
    """Land records as JSON arrays, one file per value of ``file_col``, in ``order`` (K6).

    The format of the original landing. A file is written by one task, as a
    stream: its rows are sorted (on disk where needed) and get their bracket
    or comma one by one, so no array is held. ``sources.arrays`` reads such
    files by several tasks. Null fields are left out, as in ``land_json``.
    """
    in_file = Window.partitionBy(file_col).orderBy(*order)
    first, last = F.row_number().over(in_file) == 1, F.lead(F.lit(1)).over(in_file).isNull()
    fields = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != file_col])
    line = F.concat(F.when(first, "[").otherwise(","), F.to_json(fields), F.when(last, "]").otherwise(""))
    df.select(file_col, line.alias("value")).write.mode("overwrite").partitionBy(file_col).text(path)


def write_partitioned(df: DataFrame, root: str, partition_col: str = "ingest_date",
                      days: Sequence[str | dt.date] | None = None) -> int:
    """Overwrite the partitions of ``days`` by ``df`` and return its rows.

    Dynamic partition overwrite keeps every other partition (and the null
    one) untouched. A requested day without rows is overwritten by an empty
    part file: stale rows go, and the folder records that the day was
    written. Without ``days`` only the partitions present in ``df`` change.

    The ``rebalance`` hint clusters rows by the partition column so each
    task writes few files per partition, while AQE splits a partition that
    is too large: one day holding a third of all rows is written by many
    tasks, not one. Rows and days are counted inside the write job.
    """
    counted = Observation(f"write_{uuid.uuid4().hex[:8]}")
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"),
                      F.collect_set(F.col(partition_col).cast("string")).alias("days"))
    (
        rows.hint("rebalance", partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(root)
    )
    found = observed_values(counted)
    for day in sorted({str(d) for d in days or ()} - set(found.get("days", ()))):
        df.drop(partition_col).limit(0).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{partition_col}={day}")
    return int(found.get("rows", 0))


def write_day_folders(df: DataFrame, root: str, day_col: str = "ingest_date", dataset: str = "flight_weather.parquet") -> list[str]:
    """Write every day as ``{root}/{YYYY-MM-DD}/{dataset}`` in one job (K1); returns the days.

    The layout of the original jobs, for any number of days. The rows are
    written once, clustered by day, to a folder aside; each day's folder is
    then renamed into place, one step of the file system a day, and replaces
    what was there, which goes with the folder aside. A row without a day raises before anything is replaced.
    """
    spark = df.sparkSession
    aside = f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    df.hint("rebalance", day_col).write.partitionBy(day_col).parquet(aside)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = {f.getPath().getName().partition("=")[2]: f.getPath() for f in store.listStatus(path(aside)) if f.isDirectory()}
    if bad := [d for d in folders if not _is_day(d)]:
        raise ValueError(f"rows without a day: {bad}")
    for day, folder in sorted(folders.items()):
        target = path(f"{root.rstrip('/')}/{day}/{dataset}")
        store.mkdirs(target.getParent())
        if store.exists(target):
            store.rename(target, path(f"{aside}/_old-{day}"))
        if not store.rename(folder, target):
            raise OSError(f"cannot rename {folder}")
    store.delete(path(aside), True)
    return sorted(folders)


def _is_day(text: str) -> bool:
    try:
        return str(dt.date.fromisoformat(text)) == text
    except ValueError:
        return False


# --- K4 / K3 / K5 ---------------------------------------------------------

def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, location: str,
                           partition_cols: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` with a fixed schema (K4)."""
    last = partition_cols or []
    fields = sorted(schema.fields, key=lambda f: f.name in last)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{location}'")


def create_or_replace_table(df: DataFrame, name: str, location: str) -> str:
    """Create-or-replace a table from a query result (K3); returns where its rows are.

    The result is written aside, in a folder of its own under ``location``;
    the table is only replaced once that has succeeded, so a failed query
    leaves the old table as it was. A table with the same columns changes in
    one catalog statement, so a reader finds the old rows or the new ones
    and never no table. Only other columns need a drop and a create. The old
    rows' files are left for a retention job.
    """
    spark = df.sparkSession
    path = os.path.join(location, uuid.uuid4().hex)
    df.write.mode("errorifexists").parquet(path)
    if _is_plain_table(spark, name, df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        create_table_if_absent(spark, name, df.schema, path)
    return path


def _is_plain_table(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """The name is a table without partitions that has these columns."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType == "VIEW":
        return False
    columns = spark.catalog.listColumns(name)
    return not any(c.isPartition or c.isBucket for c in columns) and [
        (c.name, c.dataType) for c in columns] == [(f.name, f.dataType.simpleString()) for f in schema.fields]


def write_audited(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> tuple[int, int]:
    """Write a dataset and return its content sums, observed in the write itself.

    See ``aggregate.content_sums``; ``content_differs`` compares them with
    what a reader of the dataset finds.
    """
    seen = Observation(f"content_{uuid.uuid4().hex[:8]}")
    rows = df.observe(seen, *content_sums(df))
    if partition_cols:
        rows = rows.hint("rebalance", *partition_cols)
    rows.write.mode("errorifexists").partitionBy(*partition_cols).parquet(path)
    found = observed_values(seen)
    return int(found.get("rows", 0)), int(found.get("content") or 0)


def content_differs(df: DataFrame, rows: int, content: int) -> bool:
    """Whether a frame's rows are others than those that were summed; order and files do not matter."""
    found = df.agg(*content_sums(df)).first()
    return (found["rows"], int(found["content"] or 0)) != (rows, content)


def store_assign(df: DataFrame, target: T.StructType) -> DataFrame:
    """Positional store assignment onto ``target`` with explicit casts (K5).

    Text going into a timestamp column is parsed as a wall-clock
    ``timestamp_ntz`` (an offset in the text is dropped, never applied);
    every other column is cast. Column ``i`` of ``df`` feeds field ``i``.
    """
    if len(df.columns) != len(target.fields):
        raise ValueError(f"insert has {len(df.columns)} columns, target has {len(target.fields)}")
    out = []
    for src, f in zip(df.columns, target.fields):
        c = F.col(f"`{src}`")
        src_type = df.schema[src].dataType
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)) and isinstance(src_type, T.StringType):
            c = wall_clock_timestamp(c)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


ACCEPTED, REJECTED = "accepted", "rejected"
OUTCOME, REASONS, SOURCE = "outcome", "reasons", "source_row"


def judged_rows(df: DataFrame, target: T.StructType) -> DataFrame:
    """``store_assign`` row by row: every row stays, with an outcome.

    Column ``i`` of ``df`` feeds field ``i`` by a cast that gives null where
    the plain one would fail the job. Returns the target's columns,
    ``reasons`` (one ``field: why`` per column that does not fit: ``bad
    value``, or ``missing`` for a field that must not be null), the row as
    it came as JSON if it is rejected, and ``outcome``.
    """
    if len(df.columns) != len(target.fields):
        raise ValueError(f"insert has {len(df.columns)} columns, target has {len(target.fields)}")
    values, why = [], []
    for name, f in zip(df.columns, target.fields):
        c = F.col(f"`{name}`")
        text = isinstance(df.schema[name].dataType, T.StringType)
        blank = F.lit(False)
        if text and isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            value, blank = F.when(~is_blank(c), c.try_cast("timestamp_ntz")), is_blank(c)  # as wall_clock_timestamp
        else:
            value = c.try_cast(f.dataType)
        value = value.cast(f.dataType)
        bad = F.when(c.isNotNull() & ~blank & value.isNull(), F.lit(f"{f.name}: bad value"))
        if not f.nullable:
            bad = F.coalesce(bad, F.when(value.isNull(), F.lit(f"{f.name}: missing")))
        values.append(value.alias(f.name))
        why.append(bad)
    reasons = F.array_compact(F.array(*why)).alias(REASONS)
    came = F.struct(*[F.col(f"`{n}`") for n in df.columns]).alias(SOURCE)
    ok = F.size(REASONS) == 0
    return df.select(*values, reasons, came).select(
        *[F.col(f"`{f.name}`") for f in target.fields], REASONS, F.when(~ok, F.to_json(SOURCE)).alias(SOURCE),
        F.when(ok, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)).alias(OUTCOME))


def load_judged(df: DataFrame, target: T.StructType, root: str) -> dict[str, int]:
    """Write good and bad rows in one pass, partitioned by outcome; returns the rows of each.

    A bad row does not fail the load and is not lost: it stands under
    ``outcome=rejected`` with its reasons. Accepted and rejected rows add up
    to the input; both are counted inside the write.
    """
    seen = Observation(f"load_{uuid.uuid4().hex[:8]}")
    ok = F.count_if(F.col(OUTCOME) == ACCEPTED)
    rows = judged_rows(df, target).observe(seen, ok.alias(ACCEPTED), (F.count(F.lit(1)) - ok).alias(REJECTED))
    rows.write.mode("errorifexists").partitionBy(OUTCOME).parquet(root)
    found = observed_values(seen)
    return {k: int(found.get(k, 0)) for k in (ACCEPTED, REJECTED)}


def judged_schema(target: T.StructType) -> T.StructType:
    """Columns of what ``load_judged`` writes."""
    more = [T.StructField(REASONS, T.ArrayType(T.StringType())), T.StructField(SOURCE, T.StringType()), T.StructField(OUTCOME, T.StringType())]
    return T.StructType([T.StructField(f.name, f.dataType) for f in target.fields] + more)


def accepted_rows(spark: SparkSession, root: str, target: T.StructType) -> DataFrame:
    """The accepted rows of a judged load, in the target's columns; the rejected ones' files are not read."""
    rows = spark.read.schema(judged_schema(target)).parquet(root).where(F.col(OUTCOME) == ACCEPTED)
    return rows.select(*[F.col(f"`{f.name}`") for f in target.fields])


def rejected_rows(spark: SparkSession, root: str, target: T.StructType) -> DataFrame:
    """The rejected rows of a judged load: reasons, and the row as it came."""
    return spark.read.schema(judged_schema(target)).parquet(root).where(F.col(OUTCOME) == REJECTED).select(REASONS, SOURCE)


def insert_typed(spark: SparkSession, df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT * FROM df`` with store-assignment casts (K5)."""
    target = spark.table(table).schema
    store_assign(df, target).write.insertInto(table)


# --- K2 / K7: the original delete-by-date semantics -----------------------

def replace_rows(existing: DataFrame, batch: DataFrame, date_col: str, day: str | dt.date) -> DataFrame:
    """Delete rows with ``date = day`` then append the batch.

    A null date is never deleted. The batch's own dates are not checked, so
    batch rows dated other than ``day`` survive beside existing rows of
    those dates — exactly the original two-statement behaviour.
    """
    return existing.where(not_on_day(date_col, day)).unionByName(batch)


def backfill_rows(
    existing: DataFrame,
    batches: DataFrame,
    file_day_col: str,
    date_col: str,
    start: str | dt.date,
    end: str | dt.date,
) -> DataFrame:
    """Result of replaying ``replace_rows`` for file days ``start..end`` ascending (K7).

    Closed form, one set-based job instead of one job per day:

    * an existing row survives iff its date is null or outside [start, end];
    * a batch row (file day f, date a) survives iff not (f < a <= end) —
      a later step of the replay would have deleted it.

    ``batches`` holds all days' batches, tagged with ``file_day_col``.
    """
    s, e = date_literal(start), date_literal(end)
    d = F.col(date_col)
    f = F.col(file_day_col)
    keep_old = d.isNull() | ~d.between(s, e)
    in_range = f.between(s, e)
    keep_new = d.isNull() | ~((d > f) & (d <= e))
    return existing.where(keep_old).unionByName(batches.where(in_range & keep_new).drop(file_day_col))


# --- K2 / K7 on a table partitioned by the delete key ----------------------

def _overwrite_date(spark: SparkSession, table: str, rows: DataFrame, date_col: str, day: dt.date) -> None:
    """Replace partition ``date_col = day`` by ``rows`` (possibly none).

    A static-partition ``INSERT OVERWRITE`` removes the partition's files
    even when ``rows`` is empty (``ALTER TABLE ... DROP PARTITION`` on an
    external table would only unregister it and leave the files behind).
    """
    view = f"__rows_{uuid.uuid4().hex[:12]}"
    rows.drop(date_col).createOrReplaceTempView(view)
    cols = ", ".join(f"`{c}`" for c in rows.columns if c != date_col)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({date_col} = DATE '{day}') SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def replace_date_partition(spark: SparkSession, table: str, batch: DataFrame, date_col: str,
                           day: str | dt.date) -> None:
    """``replace_rows`` on a table partitioned by ``date_col``, cost ∝ batch (K2).

    Partition ``date = day`` becomes the batch rows of that date; the other
    batch rows are appended to their own date partitions (the null-date
    partition is only ever appended to). Two statements, like the original
    delete + insert; use ``publish_version`` when readers must never see
    the intermediate state. The batch is computed once, into a stage under
    the shared folder, so both statements see the same rows.
    """
    d = dt.date.fromisoformat(str(day))
    c = F.col(date_col)
    batch = _staged(batch, date_col)
    _overwrite_date(spark, table, batch.where(c == date_literal(d)), date_col, d)
    batch.where(~c.eqNullSafe(date_literal(d))).hint("rebalance", date_col).write.insertInto(table)


def backfill_date_partitions(spark: SparkSession, table: str, batches: DataFrame, file_day_col: str,
                             date_col: str, start: str | dt.date, end: str | dt.date) -> None:
    """``backfill_rows`` on a table partitioned by ``date_col`` (K7).

    Every date partition in [start, end] would be deleted by its replay
    step, so each becomes exactly the surviving batch rows of that date;
    surviving rows dated outside the window (or null) are appended. The
    survivors are staged once under the shared folder; one dynamic
    overwrite replaces all window partitions that have survivors,
    and only existing partitions of the window without any are emptied one
    by one. The table is never read, and never written outside of that.
    """
    s, e = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    d, f = F.col(date_col), F.col(file_day_col)
    keep_new = f.between(date_literal(s), date_literal(e)) & (d.isNull() | ~((d > f) & (d <= date_literal(e))))
    survivors = batches.where(keep_new).drop(file_day_col)
    staged = _staged(survivors, date_col).select(*spark.table(table).columns)
    inside = d.between(date_literal(s), date_literal(e))
    in_window = staged.where(inside)
    have = {r[0] for r in in_window.select(date_col).distinct().collect()}  # at most the window's days
    if have:
        _overwrite_partitions(spark, table, in_window.hint("rebalance", date_col))
    there = {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").where(
        F.split("partition", "=")[1].between(str(s), str(e))).collect()}
    for day in sorted(there - {str(x) for x in have}):
        _overwrite_date(spark, table, staged.limit(0), date_col, dt.date.fromisoformat(day))
    staged.where(d.isNull() | ~inside).hint("rebalance", date_col).write.insertInto(table)


def _staged(rows: DataFrame, date_col: str) -> DataFrame:
    """Rows written once under the shared folder, by date, and read back.

    Clustered by date like every partitioned write: few files per date, and
    AQE splits a date holding a large share of the rows.
    """
    path = scratch_path(rows.sparkSession, "stage")
    rows.hint("rebalance", date_col).write.partitionBy(date_col).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*[F.col(f"`{c}`") for c in rows.columns])


def _overwrite_partitions(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Replace every partition that ``rows`` has rows of, in one job."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)


# --- Q14: write a new version, then swap ---------------------------------

VERSION = "aerostat.version"


def _current_version(spark: SparkSession, name: str) -> str | None:
    """Table behind a published name; None if the name is free."""
    if not spark.catalog.tableExists(name):
        return None
    if spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table of its own, not a published version; use the partition mode")
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == VERSION).collect()
    return rows[0]["value"] if rows else None


def publish_version(spark: SparkSession, df: DataFrame, name: str, root: str,
                    partition_cols: list[str] | None = None) -> str:
    """Write ``df`` as a new version under ``root`` and let ``name`` show it.

    A version is a table of its own; ``name`` is a view on it, replaced in
    one step, so readers see the old or the new version and never part of
    one. The old version's table is dropped from the catalog; its files are
    left for a retention job. Returns the new location. A ``name`` that is
    a table itself raises ``ValueError`` before anything is written.
    """
    old = _current_version(spark, name)
    version = f"v{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:8]}"
    location, own = os.path.join(root, version), f"{name}__{version}"
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = df.hint("rebalance", *partition_cols).write.mode("errorifexists").partitionBy(*partition_cols)
    w.parquet(location)
    create_table_if_absent(spark, own, df.schema, location, partition_cols)
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {own}")
    cols = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{own}') AS SELECT {cols} FROM {own}")
    if old:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return location
