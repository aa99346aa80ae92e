"""Preview and per-key caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows in a deterministic order (L4).

    Planned as ``TakeOrderedAndProject``: each task keeps its own top ``n``
    and only those reach the final merge.
    """
    cols = list(order_by) if order_by else df.columns
    return df.orderBy(*cols).limit(n)


def cap_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    k: int,
    fanout: int = 32,
) -> DataFrame:
    """At most ``k`` rows per key, the first ``k`` by ``order_by``.

    Exact two-level reduction so one hot key never lands whole in a task:

    1. rows are grouped by (key, bucket) with ``bucket`` the input task's
       partition id modulo ``fanout``; each (key, bucket) keeps its first k
       (Spark inserts a partial per-key limit before the shuffle, so every
       input task ships at most k rows per key);
    2. survivors are grouped by key and cut to k again.

    The first k of a key are among the union of each bucket's first k, so
    the result equals a single ``row_number() <= k`` over the key. A task
    sees at most ``k * max(tasks/fanout, fanout)`` rows of one key.
    ``order_by`` should be a total order (add a unique tie-break).

    The bucket must be the input task (a hash bucket would let every task
    feed every bucket), and a partition id is nondeterministic to Catalyst:
    filters written after the cap are not pushed below it, so filter
    before capping.
    """
    keys = list(keys)
    order = list(order_by)
    bucket = "__cap_bucket"
    staged = df.withColumn(bucket, F.pmod(F.spark_partition_id(), F.lit(fanout)))
    rn = "__cap_rn"
    w1 = Window.partitionBy(*keys, bucket).orderBy(*order)
    first = staged.withColumn(rn, F.row_number().over(w1)).where(F.col(rn) <= k).drop(rn, bucket)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return first.withColumn(rn, F.row_number().over(w2)).where(F.col(rn) <= k).drop(rn)
