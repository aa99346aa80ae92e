"""Joins: fact-to-dimension left join, lookup, route grid, route semi join.

The operators state the join and nothing about its physical form, so rows,
columns and types are the same at every size. Spark broadcasts a side whose
files are under ``spark.sql.autoBroadcastJoinThreshold`` or whose finished
stage AQE has measured as small, and shuffles otherwise (``session``). Left
rows with a null key take no part in the shuffle; AQE splits a hot left key;
``left_join_split`` also splits hot keys of the right side, which AQE cannot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(left_keys: str | Sequence[str], right_keys: str | Sequence[str] | None):
    lk = [left_keys] if isinstance(left_keys, str) else list(left_keys)
    if right_keys is None:
        rk = lk
    else:
        rk = [right_keys] if isinstance(right_keys, str) else list(right_keys)
    if len(lk) != len(rk):
        raise ValueError("left and right key lists differ in length")
    return lk, rk


def _cond(left: DataFrame, right: DataFrame, lk, rk) -> Column:
    cond = None
    for a, b in zip(lk, rk):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


def _any_null(df: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [df[k].isNull() for k in keys])


def _with_unmatched(joined: DataFrame, left: DataFrame, right: DataFrame, lk: Sequence[str]) -> DataFrame:
    """``joined`` plus the left rows with a null key, which match nothing."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    rest = left.where(_any_null(left, lk)).select(*[F.col(f"`{c}`") for c in left.columns], *nulls)
    return joined.union(rest)


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str] | None = None,
    null_keys_apart: bool = True,
) -> DataFrame:
    """Left outer equi-join keeping both key columns.

    Null keys never match; duplicate right keys fan a left row out; no
    dedup. Left rows with a null key are united with the result instead of
    joined, so they are neither shuffled nor gathered in the partition of
    the null key; both reads of the left side push their null test to the
    scan. A left column that cannot be null costs no second read. Without
    ``null_keys_apart`` the left side is read once and they are joined like
    others: the form for a left side that is costly to read, such as JSON,
    and a right side that is broadcast. The rows are the same.
    """
    lk, rk = _keys(left_keys, right_keys)
    if not null_keys_apart:
        return left.join(right, _cond(left, right, lk, rk), "left")
    keyed = left.where(~_any_null(left, lk))
    return _with_unmatched(keyed.join(right, _cond(keyed, right, lk, rk), "left"), left, right, lk)


PART, PARTS = "__part", "__parts"
MOST_HOT = 100_000  # hot keys that are sent to all executors


def left_join_split(
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str] | None = None,
    *,
    spread_by: Sequence[str],
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """``left_join`` for a right side that may hold hot keys.

    AQE cannot split the right side of a left outer join. A right key with
    more than ``rows_per_task`` rows is dealt into as many parts as its rows
    need, by a hash of the right columns ``spread_by`` (an id, say); a left
    row of that key is repeated once a part, and each pair meets in exactly
    one part. Repeats that match nothing in their part are dropped: a hot
    key exists on the right, so its left rows match somewhere.

    The same rows and columns as ``left_join`` for any data and parameters.
    Costs a count and an aggregate of the right keys. A key is hot from
    ``rows_per_task`` rows or a 100,000th of all rows, whichever is more, so
    the list of hot keys that is broadcast has 100,000 at most.
    """
    lk, rk = _keys(left_keys, right_keys)
    names = [f"__k{i}" for i in range(len(rk))]
    shared = {c: f"__right_{i}" for i, c in enumerate(right.columns)}
    right = right.select(*[F.col(f"`{c}`").alias(n) for c, n in shared.items()])
    rk, spread = [shared[k] for k in rk], [shared[c] for c in spread_by]
    # so that no more than MOST_HOT keys can be hot, whatever the data
    enough = F.greatest(F.lit(rows_per_task).cast("long"), F.ceil(right.agg(F.count(F.lit(1))).scalar() / MOST_HOT))
    hot = right.where(~_any_null(right, rk)).groupBy(*[F.col(k).alias(n) for k, n in zip(rk, names)]).agg(
        F.count(F.lit(1)).alias("__n")).withColumn("__enough", enough).where("__n > __enough").select(
        *names, F.ceil(F.col("__n") / F.col("__enough")).cast("int").alias(PARTS))
    hot = F.broadcast(hot)

    def marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.join(hot, _cond(df, hot, keys, names), "left").drop(*names).withColumn(PARTS, F.coalesce(PARTS, F.lit(1)))

    # dealt out by key and part, also where the input comes dealt out by key
    r = marked(right, rk).select(*right.columns, F.pmod(F.xxhash64(*spread), F.col(PARTS)).cast("int").alias("__right_part"))
    r = r.repartition(*rk, "__right_part")
    keyed = left.where(~_any_null(left, lk))
    lx = marked(keyed, lk).withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1)))
    lx = lx.repartition(*[lx[k] for k in lk], PART)
    joined = lx.join(r, _cond(lx, r, lk, rk) & (lx[PART] == r["__right_part"]), "left")
    joined = joined.where((F.col(PARTS) == 1) | F.col("__right_part").isNotNull())
    out = joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(n).alias(c) for c, n in shared.items()])
    named = right.select(*[F.col(n).alias(c) for c, n in shared.items()])
    return _with_unmatched(out, left, named, lk)


def semi_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``left`` with a key present in ``right`` (F6 as a set filter).

    Only the right keys are used, reduced to distinct keys first: a partial
    aggregate in every map task, so a hot key on the right arrives as one
    row a task, and the aggregate's partitioning is the one a shuffled join
    needs.
    """
    lk, rk = _keys(left_keys, right_keys)
    r = right.select(*rk).distinct()
    return left.join(r, _cond(left, r, lk, rk), "left_semi")


def route_grid(
    routes: DataFrame,
    facts: DataFrame,
    route_cols: Sequence[str],
    count_col: str | None = None,
    name: str = "n",
) -> DataFrame:
    """Records per requested route, zero for a route with none (J3 + A9).

    ``routes`` lists the requested (departure, arrival) pairs. Facts are
    aggregated per route first (partial + final aggregate, so a hot route
    never gathers its rows in one task); only the per-route counts meet the
    route list. The per-route side is sized by the route list, not the
    facts; no probe is run on it (that would execute the aggregate twice) —
    AQE sees its real size after the aggregate stage and re-plans the join
    as a broadcast at runtime.
    """
    cols = list(route_cols)
    counted = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    per_route = facts.groupBy(*cols).agg(counted.alias(name))
    joined = routes.join(per_route, cols, "left")
    keep = [c for c in routes.columns if c != name]
    return joined.select(*keep, F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name))


def routes_from_lists(spark, departures: Sequence[str], arrivals: Sequence[str]) -> DataFrame:
    """The requested route list from configured departure/arrival codes.

    Configuration-sized (the feed requests 1 x 8 routes); built on the
    driver exactly as the request loop enumerates it.
    """
    rows = [(d, a) for d in departures for a in arrivals]
    return spark.createDataFrame(rows, "dep string, arr string")
