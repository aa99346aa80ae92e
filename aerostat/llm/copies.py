"""A value of each group of equal rows, brought back to the rows without gathering a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_HOT = 100_000  # keys that are sent to all executors


def with_group_value(rows: DataFrame, key: str, value: Column, name: str, least: int = 64) -> DataFrame:
    """``rows`` with the aggregate ``value`` of their key as ``name``; null where the key stands alone.

    ``rows`` should be narrow and stored: they are read three times. Keys
    with many rows (``least``, or a 100,000th of all rows if that is more,
    so at most 100,000 keys) go to all executors and their rows stay where
    they are; the rest are joined by a shuffle. Null keys match nothing.
    """
    count, enough = "__group_rows", "__group_enough"
    groups = rows.where(F.col(key).isNotNull()).groupBy(key).agg(value.alias(name), F.count(F.lit(1)).alias(count)) \
        .where(F.col(count) > 1)
    bound = F.greatest(F.lit(least).cast("long"), F.ceil(rows.agg(F.count(F.lit(1))).scalar() / MOST_HOT))
    groups = groups.withColumn(enough, bound)
    hot = F.broadcast(groups.where(F.col(count) >= F.col(enough)).select(key, name))
    cold = groups.where(F.col(count) < F.col(enough)).select(key, name)
    columns = [*rows.columns, name]
    return rows.join(hot, key).select(*columns).unionByName(
        rows.join(hot, key, "left_anti").join(cold, key, "left").select(*columns))
