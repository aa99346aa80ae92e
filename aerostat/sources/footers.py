"""Counts and extremes of Parquet datasets from file footers.

Spark pushes COUNT, MIN and MAX into its V2 Parquet reader, which answers
them from the statistics in the footers: no column is read. The reader and
the push-down are session settings, so these frames belong to a session of
their own that shares the context and is otherwise set like the caller's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

V1_KEY, PUSH_KEY = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
# types whose extremes Spark takes from footers
ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def footer_session(spark: SparkSession, push: bool = True) -> SparkSession:
    """A session with the caller's settings, the V2 Parquet reader and aggregate push-down."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set(V1_KEY, ",".join(x for x in spark.conf.get(V1_KEY).split(",") if x != "parquet"))
    own.conf.set(PUSH_KEY, str(push).lower())
    return own


def _stats(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], by: str | None, push: bool) -> DataFrame:
    rows = footer_session(spark, push).read.schema(schema).parquet(path)
    aggregates = [F.count(F.lit(1)).alias("n")]
    for c in columns:
        aggregates.append(F.count(c).alias(f"{c}_filled"))
        if isinstance(schema[c].dataType, ORDERED):
            aggregates += [F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high")]
    found = (rows.groupBy(by) if by else rows).agg(*aggregates)
    # a pushed count is null where there is no file, which the optimizer does not expect of a count: nullif hides it
    counts = {"n", *[f"{c}_filled" for c in columns]}
    return found.select(*[F.coalesce(F.nullif(F.col(c), F.lit(-1)), F.lit(0)).alias(c) if c in counts else F.col(c)
                          for c in found.columns])


def footer_stats(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] = (), by: str | None = None) -> DataFrame:
    """Rows, and per column the non-null values and (where ordered) the extremes, from the footers alone.

    ``by`` is a partition column: one row per partition. Text and time
    columns only get their count. Of a file that has no statistics for a
    column, or only nulls in it, Spark cannot tell the extremes and fails;
    ``column_range`` reads the column then.
    """
    return _stats(spark, path, schema, columns, by, True)


def column_range(spark: SparkSession, path: str, schema: T.StructType, column: str) -> tuple:
    """(rows, non-null values, least, greatest) of a column: from footers, or by a scan of the column where they do not tell."""
    try:
        return tuple(_stats(spark, path, schema, [column], None, True).first())
    except Exception as e:  # noqa: BLE001  the error class has no name of its own
        if "No min/max found for Parquet file" not in str(e) and "No statistics" not in str(e) and "num nulls" not in str(e).lower():
            raise
        return tuple(_stats(spark, path, schema, [column], None, False).first())


def earliest_day(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "date"):
    """The least date of a dataset (F7's default selection); null if it has none. One value reaches the driver."""
    return column_range(spark, path, schema, date_col)[2]
