"""Grouped counts and means, distinct values, row-count audit.

Every aggregate is a partial (map-side) + final hash aggregate, so a hot
group is pre-reduced in each task before the shuffle and never gathered
whole in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_by_group(df: DataFrame, key: str, name: str = "n", ordered: bool = True) -> DataFrame:
    """SQL-style ``COUNT(*) GROUP BY key``: the null group is kept (A1, A2).

    Ordered by count descending with the key as tie-break (L1).
    """
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), F.asc_nulls_first(key)) if ordered else out


def value_counts(df: DataFrame, key: str, name: str = "n", ordered: bool = True) -> DataFrame:
    """pandas-style ``value_counts``: the null group is dropped (A3)."""
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), F.asc(key)) if ordered else out


def mean_by_group(df: DataFrame, key: str, value: str, name: str | None = None, ordered: bool = True) -> DataFrame:
    """pandas ``groupby(key)[value].mean()`` (A4, L3).

    Null inputs are skipped, the null key is dropped, an all-null group
    yields null; output in key order.
    """
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(name or value))
    return out.orderBy(key) if ordered else out


def count_and_mean(
    df: DataFrame,
    key: str,
    count_col: str,
    mean_col: str,
    count_name: str = "count",
    mean_name: str = "mean",
    ordered: bool = True,
) -> DataFrame:
    """Non-null count of one column and mean of another per key (A5)."""
    out = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(count_col).alias(count_name), F.avg(mean_col).alias(mean_name))
    )
    return out.orderBy(key) if ordered else out


def distinct_values(df: DataFrame, col: str, drop_null: bool = True, ordered: bool = True) -> DataFrame:
    """Sorted distinct values of one column."""
    out = df.select(col)
    if drop_null:
        out = out.where(F.col(col).isNotNull())
    out = out.distinct()
    return out.orderBy(col) if ordered else out


# name -> (key column, column whose non-null values are counted, "*" or None, column of the mean or None)
Frames = Mapping[str, tuple[str, str | None, str | None]]


def frames_in_one_pass(df: DataFrame, frames: Frames) -> DataFrame:
    """Several grouped frames from one scan and one shuffle (A3-A5).

    Returns ``frame``, ``key``, ``n`` and ``mean``, one row per frame and
    key. Grouping sets compute every distinct key column once, however many
    frames use it; ``grouping_id`` tells its rows from those of the others.
    Null keys are dropped (pandas semantics). Each task sends one partial
    row a key, so a hot key costs no more than another.
    """
    keys = list(dict.fromkeys(k for k, _, _ in frames.values()))
    counts = [F.count(F.lit(1) if c == "*" else F.col(f"`{c}`")).alias(f"n{i}") if c else F.lit(None).cast("long").alias(f"n{i}")
              for i, (_, c, _) in enumerate(frames.values())]
    means = [F.avg(f"`{m}`").alias(f"m{i}") if m else F.lit(None).cast("double").alias(f"m{i}")
             for i, (_, _, m) in enumerate(frames.values())]
    aggregates = [a for a, (_, c, _) in zip(counts, frames.values()) if c] + [
        a for a, (_, _, m) in zip(means, frames.values()) if m]
    by = [F.col(f"`{k}`") for k in keys]
    grouped = df.groupingSets([[c] for c in by], *by).agg(F.grouping_id().alias("set"), *aggregates)
    all_sets = (1 << len(keys)) - 1
    rows = []
    for i, (name, (key, c, m)) in enumerate(frames.items()):
        own = F.col("set") == all_sets - (1 << (len(keys) - 1 - keys.index(key)))
        key_text = F.col(f"`{key}`").cast("string")
        rows.append(F.when(own & key_text.isNotNull(), F.struct(
            F.lit(name).alias("frame"), key_text.alias("key"), (F.col(f"n{i}") if c else F.lit(None).cast("long")).alias("n"),
            (F.col(f"m{i}") if m else F.lit(None).cast("double")).alias("mean"))))
    return grouped.select(F.explode(F.array_compact(F.array(*rows))).alias("row")).select("row.*")


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row that tells nulls from other values and columns from each other."""
    parts: list[Column] = []
    for c in df.columns:
        parts += [F.col(f"`{c}`").isNull(), F.col(f"`{c}`")]
    return F.xxhash64(*parts)


def content_sums(df: DataFrame) -> list[Column]:
    """``rows`` and ``content`` of a frame's rows as a multiset: their number and the sum of their hashes.

    The sum does not depend on the order or the partitions, and a repeated
    row counts as often as it stands. One changed, lost or doubled row
    changes it; changes that cancel out have a chance of 2**-64.
    """
    return [F.count(F.lit(1)).alias("rows"), F.sum(row_hash(df).cast("decimal(38,0)")).alias("content")]


def profile(df: DataFrame, by: Sequence[str] = (), log_k: int = 12) -> DataFrame:
    """Per column the rows, nulls, extremes and a sketch of the distinct values, in one pass.

    Returns the ``by`` columns, ``position``, ``name``, ``type``, ``n``,
    ``nulls``, ``low``, ``high`` (as text; null for types without an order)
    and ``sketch`` (HyperLogLog, 2**log_k registers). Profiles of parts, such
    as days, merge by ``merged_profile`` without reading a row again. A
    column of a type that cannot be sketched has a null sketch.
    """
    rest = [f for f in df.schema.fields if f.name not in by]
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(rest):
        c = F.col(f"`{f.name}`")
        ordered = not isinstance(f.dataType, (T.MapType, T.VariantType, T.ArrayType, T.StructType))
        text = profile_text(c, f.dataType) if ordered else F.lit(None).cast("string")
        sketched = text if ordered else F.to_json(c) if isinstance(f.dataType, T.VariantType) else c.cast("string")
        low, high = (profile_text(x, f.dataType) if ordered else F.lit(None).cast("string") for x in (
            (F.min(c), F.max(c)) if ordered else (None, None)))
        aggregates.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.count(c).alias("filled"), low.alias("low"), high.alias("high"),
            F.hll_sketch_agg(sketched, log_k).alias("sketch")).alias(f"c{i}"))
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*aggregates)
    wide = grouped.select(*[F.col(f"`{c}`") for c in by], "n", F.explode(F.array(*[f"c{i}" for i in range(len(rest))])).alias("c"))
    return wide.select(*[F.col(f"`{c}`") for c in by], "c.position", "c.name", "c.type", "n", (F.col("n") - F.col("c.filled")).alias("nulls"),
                       "c.low", "c.high", "c.sketch")


def profile_text(value: Column, kind: T.DataType) -> Column:
    """A value as text whose order is that of the values, where numbers are kept as such by ``merged_profile``."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return value.cast("string")


def merged_profile(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of parts as one (or as one per ``by``), with ``distinct``, the estimated number of values.

    Rows and nulls add up, extremes are those of the parts (compared as the
    column's type), sketches are united. The estimate is within about
    1.04 / sqrt(2**log_k) of the truth (one standard error).
    """
    numeric = F.regexp_like("type", F.lit("^(tinyint|smallint|int|bigint|float|double|decimal.*)$"))
    place = lambda c: F.struct(F.when(numeric, F.col(c).try_cast("double")), F.when(numeric, F.col(c).try_cast("decimal(38,10)")), F.col(c))
    return profiles.groupBy(*[F.col(f"`{c}`") for c in by], "position", "name", "type").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"),
        F.min_by("low", F.when(F.col("low").isNotNull(), place("low"))).alias("low"),
        F.max_by("high", F.when(F.col("high").isNotNull(), place("high"))).alias("high"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct"))


def row_counts(frames: Mapping[str, DataFrame], label: str = "t", name: str = "n") -> DataFrame:
    """One ``(label, count)`` row per named frame, as a DataFrame."""
    parts = [f.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias(label), name) for t, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed_values(obs: Observation) -> dict:
    """What an observation saw in the action that has run; nothing if its plan was removed.

    Spark drops an input that proves empty together with the observation on
    it, which then never reports.
    """
    try:
        return obs.get
    except Py4JJavaError as e:
        if "AssertionError" in str(e.java_exception):
            return {}
        raise


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs ``df``.

    Unlike a separate ``count()`` this costs no extra job: read
    ``observed_values(obs).get("rows", 0)`` after the write/collect.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
