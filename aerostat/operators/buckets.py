"""Fact and dimension tables bucketed alike, for joins that do not shuffle the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART, PARTS = "part_of_key", "__parts"
MOST_HOT = 100_000  # hot keys that are sent to all executors


def _hot_keys(facts: DataFrame, key: str, rows_per_part: int) -> DataFrame:
    """Keys with more rows than a part should hold, and their parts; 100,000 keys at most."""
    enough = F.greatest(F.lit(rows_per_part).cast("long"), F.ceil(facts.agg(F.count(F.lit(1))).scalar() / MOST_HOT))
    counts = facts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.withColumn("__enough", enough).where("__n > __enough")
    return F.broadcast(hot.select("__key", F.ceil(F.col("__n") / F.col("__enough")).cast("int").alias(PARTS)))


def _write(df: DataFrame, name: str, location: str, key: str, buckets: int) -> None:
    # dealt like the buckets, so a task writes whole buckets, one file each
    dealt = df.repartition(buckets, key, PART)
    dealt.write.mode("errorifexists").format("parquet").option("path", location).bucketBy(buckets, key, PART).sortBy(key, PART) \
        .saveAsTable(name)


def create_bucketed_tables(facts: DataFrame, dimension: DataFrame, fact_table: str, dimension_table: str, fact_location: str,
                           dimension_location: str, fact_key: str, dimension_key: str, spread_by: Sequence[str],
                           buckets: int = 64, rows_per_part: int = 1_000_000) -> None:
    """Write both sides of a join as tables bucketed and sorted by the key (K4).

    A key with more than ``rows_per_part`` facts is dealt into parts by a
    hash of ``spread_by``, and its dimension rows are repeated once a part,
    so no bucket gets a hot key whole. Null keys match nothing and are dealt
    over all buckets. Both tables have the part as column ``part_of_key``.
    A name that exists raises.
    """
    hot = _hot_keys(facts, fact_key, rows_per_part)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]), F.col(PARTS)).cast("int")

    def marked(df: DataFrame, key: str) -> DataFrame:
        found = df.join(hot, F.col(f"`{key}`") == F.col("__key"), "left").drop("__key")
        return found.withColumn(PARTS, F.when(F.col(f"`{key}`").isNull(), F.lit(buckets)).otherwise(F.coalesce(PARTS, F.lit(1))))

    _write(marked(facts, fact_key).withColumn(PART, salt).drop(PARTS), fact_table, fact_location, fact_key, buckets)
    kind = facts.schema[fact_key].dataType  # other types are hashed to other buckets
    dimension = dimension.withColumn(dimension_key, F.col(f"`{dimension_key}`").cast(kind))
    whole = marked(dimension.where(F.col(f"`{dimension_key}`").isNotNull()), dimension_key)
    repeated = whole.withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1))).drop(PARTS)
    _write(repeated, dimension_table, dimension_location, dimension_key, buckets)


def bucketed_left_join(spark: SparkSession, fact_table: str, dimension_table: str, fact_key: str, dimension_key: str) -> DataFrame:
    """Facts with their dimension rows, bucket by bucket: neither side is shuffled.

    The same rows as ``joins.left_join`` on the frames that the tables were
    made of, in the columns of both without the part.
    """
    facts, dimension = spark.table(fact_table), spark.table(dimension_table).withColumnRenamed(PART, "__dimension_part")
    on: Column = (facts[fact_key] == dimension[dimension_key]) & (facts[PART] == dimension["__dimension_part"])
    return facts.join(dimension.hint("merge"), on, "left").drop(PART, "__dimension_part")
