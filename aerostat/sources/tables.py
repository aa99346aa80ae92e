"""Parquet datasets, catalog tables and temp views."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_parquet(spark: SparkSession, path: str, part_glob: str | None = None,
                 schema: StructType | None = None) -> DataFrame:
    """All Parquet parts of a dataset (S5); only matching parts with a glob.

    ``part_glob="part-00000*.parquet"`` reproduces the ad-hoc reader that
    looked at the first part only (and so undercounted multi-part days).
    Partition directories (``ingest_date=...``) become columns and are
    pruned by filters on them. A known ``schema`` (the dataset's contract,
    partition columns included) skips the job that reads file footers to
    infer one.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if part_glob:
        r = r.option("pathGlobFilter", part_glob)
    return r.parquet(path)


def scan_partitions(spark: SparkSession, root: str, partition_col: str, values: Sequence, part_glob: str | None = None,
                    schema: StructType | None = None) -> DataFrame:
    """The named partitions of a dataset (S3, S5); one that does not exist fails at analysis."""
    root = root.rstrip("/")
    r = spark.read.option("basePath", root)
    if schema is not None:
        r = r.schema(schema)
    if part_glob:
        r = r.option("pathGlobFilter", part_glob)
    return r.parquet(*[f"{root}/{partition_col}={v}" for v in values])


def scan_day_folders(spark: SparkSession, root: str, days: Sequence, dataset: str = "flight_weather.parquet",
                     part_glob: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Day folders ``{root}/{YYYY-MM-DD}/{dataset}/*.parquet`` with their day as ``ingest_date``.

    The layout of the original jobs. A missing day fails at analysis (S4).
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if part_glob:
        r = r.option("pathGlobFilter", part_glob)
    df = r.parquet(*[f"{root.rstrip('/')}/{d}/{dataset}" for d in days])
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/[^/]+/[^/]*$", 1)
    return df.withColumn("ingest_date", F.to_date(day))


def rows_on_days(facts: DataFrame, days: DataFrame, day_col: str = "ingest_date") -> DataFrame:
    """Rows of a day-partitioned dataset on days that are data themselves (S3, F1).

    ``days`` is any frame whose first column is a day: the result of a
    query, a calendar, a work list. It is reduced to distinct days, at most
    one row per day of the calendar, and broadcast; dynamic partition
    pruning then reads the folders of these days only. Null days select
    nothing.
    """
    chosen = days.select(F.col(f"`{days.columns[0]}`").cast("date").alias("__chosen_day")).distinct()
    # always true; pruning is only planned for a side that is filtered
    chosen = chosen.where(F.col("__chosen_day") >= F.lit("0001-01-01").cast("date"))
    return facts.join(F.broadcast(chosen), F.col(day_col) == F.col("__chosen_day"), "left_semi")


def landed_days(spark: SparkSession, root: str) -> DataFrame:
    """The days that have a folder under ``root`` (``2025-04-02`` or ``ingest_date=2025-04-02``), one row a day.

    Folder names are listed on the driver, as many as there are days. A day
    written without rows has a folder. A root that does not exist has none.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(path) if f.isDirectory()] if store.exists(path) else []
    found = [m.group(1) for m in (re.fullmatch(r"(?:\w+=)?(\d{4}-\d{2}-\d{2})", n) for n in names) if m]
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in sorted(set(found))], "day date")


def absent_days(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested days that were never landed (S4), as a report instead of a failure."""
    wanted = requested.select(F.col(f"`{requested.columns[0]}`").cast("date").alias("day")).where("day IS NOT NULL").distinct()
    return wanted.join(landed.select("day").distinct(), "day", "left_anti")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a catalog table."""
    return spark.table(name)


def scan_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int,
              properties: dict | None = None) -> DataFrame:
    """Partitioned scan of an external relational table (S7, external store).

    Reads ``partitions`` ranges of ``column`` in parallel instead of one
    connection pulling the whole table.
    """
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under a name for SQL (S8) and return it."""
    df.createOrReplaceTempView(name)
    return df
