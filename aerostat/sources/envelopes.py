"""Landed HTTP response envelopes -> accepted records + rejects.

Fetching is out of scope; responses are landed as rows
``(dep, arr, status, body)`` and processed set-wise: a ``status = 200``
body with a ``data`` array is exploded into records; everything else is a
reject with one reason. ``accepted + rejected envelopes = all envelopes``.
Bodies are parsed as variants, so one bad element or leaf costs only itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reject reasons.
NO_DATA = "no_data"          # 200 but the body has no "data" array
HTTP_ERROR = "http_error"    # any non-200 status
REQUEST_FAILED = "request_failed"  # no response at all (null status), or a 200 body that is not JSON
NOT_AN_OBJECT = "not_an_object"  # an element of "data" that is no object
BAD_FIELD = "bad_field"      # an element with a value that its field cannot hold


def reject_reason(status: Column, body: Column, data: Column) -> Column:
    """Reason an envelope is rejected, null when it is accepted.

    ``body`` is the parsed body (null when it does not parse), ``data`` its
    array of elements (null when there is none).
    """
    return (
        F.when(status.isNull(), F.lit(REQUEST_FAILED))
        .when(status != 200, F.lit(HTTP_ERROR))
        .when(body.isNull(), F.lit(REQUEST_FAILED))
        .when(data.isNull(), F.lit(NO_DATA))
    )


def _parsed(env: DataFrame, keys, status: str, body: str) -> DataFrame:
    """Envelope keys, status, reason and the elements of ``data``.

    The body is parsed once per row, in a projection of its own: Catalyst
    does not inline a costly expression that is used more than once.
    """
    v = env.select(*keys, F.col(status).alias("__status"), F.try_parse_json(F.col(body)).alias("__body"))
    v = v.withColumn("__data", F.try_variant_get("__body", "$.data", "array<variant>"))
    reason = reject_reason(F.col("__status"), F.col("__body"), F.col("__data"))
    return v.select(*keys, "__status", "__data", reason.alias("__reason"))


def _elements(env: DataFrame, keys, status: str, body: str) -> DataFrame:
    """One row per element of ``data`` in each accepted envelope."""
    data = F.when(F.col("__reason").isNull(), F.col("__data"))
    return _parsed(env, keys, status, body).select(*keys, F.explode(data).alias("__r"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _field(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{escaped}']"


def accepted_records(env: DataFrame, record: T.StructType, keys=("dep", "arr"),
                     status: str = "status", body: str = "body") -> DataFrame:
    """One row per object in ``data`` of each accepted envelope.

    Output: the envelope ``keys`` followed by the record's fields, each cast
    by itself; a value that its field cannot hold is null and the rest of
    the record stays. An accepted envelope whose array is empty gives no
    rows, as the request loop appended nothing for it. ``element_rejects``
    counts what is left out or nulled.
    """
    objects = _elements(env, keys, status, body).where(_is_object(F.col("__r")))
    return objects.select(*keys, *[
        F.try_variant_get("__r", _field(f.name), f.dataType.simpleString()).alias(f.name) for f in record.fields])


def element_rejects(env: DataFrame, record: T.StructType, keys=("dep", "arr"),
                    status: str = "status", body: str = "body") -> DataFrame:
    """Elements of accepted envelopes that are no objects or hold a bad value, with their reason (D3)."""
    bad = F.lit(False)
    for f in record.fields:
        there = F.try_variant_get("__r", _field(f.name), "string").isNotNull()
        bad = bad | (there & F.try_variant_get("__r", _field(f.name), f.dataType.simpleString()).isNull())
    reason = F.when(~_is_object(F.col("__r")), F.lit(NOT_AN_OBJECT)).when(bad, F.lit(BAD_FIELD))
    return _elements(env, keys, status, body).select(*keys, reason.alias("reason")).where(F.col("reason").isNotNull())


def rejected(env: DataFrame, keys=("dep", "arr"), status: str = "status", body: str = "body") -> DataFrame:
    """Rejected envelopes with their reason (S9 reject branch, D3)."""
    p = _parsed(env, keys, status, body)
    return p.select(*keys, F.col("__status").alias(status), F.col("__reason").alias("reason")).where(
        F.col("reason").isNotNull())


def reject_summary(rejects: DataFrame, name: str = "n") -> DataFrame:
    """Reject accounting by reason (D3)."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias(name))


def per_route_status(env: DataFrame, keys=("dep", "arr"), status: str = "status", body: str = "body") -> DataFrame:
    """Records and outcome per requested route (A9): count of objects, reason."""
    p = _parsed(env, keys, status, body)
    objects = F.size(F.filter("__data", _is_object))
    n = F.when(F.col("__reason").isNull(), objects).otherwise(F.lit(0))
    return p.select(*keys, n.cast("bigint").alias("records"), F.coalesce("__reason", F.lit("ok")).alias("outcome"))


def _weather(env: DataFrame, key: str, query: str, status: str, body: str) -> DataFrame:
    v = env.select(F.col(key).alias("city"), F.col(query).alias("query"), F.col(status).alias("__status"),
                   F.try_parse_json(F.col(body)).alias("data"))
    reason = reject_reason(F.col("__status"), F.col("data"), F.col("data"))
    return v.withColumn("reason", reason)


def wrap_responses(env: DataFrame, key: str = "city", query: str = "query",
                   status: str = "status", body: str = "body") -> DataFrame:
    """Accepted weather responses as ``{city, query, data}`` wrappers.

    Any ``200`` response that parses is kept; its body becomes a variant, so
    loosely typed leaves stay as they were sent.
    """
    return _weather(env, key, query, status, body).where(F.col("reason").isNull()).select("city", "query", "data")


def weather_rejects(env: DataFrame, key: str = "city", query: str = "query",
                    status: str = "status", body: str = "body") -> DataFrame:
    """Weather responses that give no wrapper, with their reason."""
    r = _weather(env, key, query, status, body).where(F.col("reason").isNotNull())
    return r.select("city", "query", F.col("__status").alias(status), "reason")


def missing_routes(routes: DataFrame, env: DataFrame, keys=("dep", "arr")) -> DataFrame:
    """Requested routes with no landed response at all (completeness check).

    The envelopes are first reduced to their distinct routes (a partial
    aggregate, bounded by the route list), so the anti join never moves the
    envelopes themselves.
    """
    seen = env.select(*keys).distinct()
    return routes.join(seen, list(keys), "left_anti")


def missing_days(routes: DataFrame, seen: DataFrame, start: Column, end: Column, keys=("dep", "arr"), day: str = "day") -> DataFrame:
    """Runs of days from ``start`` to ``end`` on which a route has no response (S9, A9 over days).

    Returns the keys, ``first_day``, ``last_day`` and ``days`` of every
    run; a route that was never seen is one run. ``seen`` has the keys and
    the day of each response and is first reduced to distinct pairs, at most
    one row per route and day of the calendar; a run then lies between
    neighbouring days, so the grid of routes and days is never made.
    """
    keys = list(keys)
    wanted = routes.select(*keys).distinct().withColumns({"__start": start, "__end": end})
    days = seen.select(*keys, F.col(day).alias("__day")).distinct()
    known = wanted.join(days, keys).where(F.col("__day").between(F.col("__start"), F.col("__end")))
    # so that a run at the beginning, and a route without any day, has a neighbour
    every = known.unionByName(wanted.withColumn("__day", F.date_sub("__start", 1)))
    following = F.lead("__day").over(Window.partitionBy(*keys).orderBy("__day"))
    gaps = every.withColumn("first_day", F.date_add("__day", 1)).withColumn(
        "last_day", F.date_sub(F.coalesce(following, F.date_add("__end", 1)), 1))
    return gaps.where("first_day <= last_day").select(
        *keys, "first_day", "last_day", (F.date_diff("last_day", "first_day") + 1).alias("days"))


def land_wrappers(env: DataFrame, path: str, key: str = "city", query: str = "query", status: str = "status", body: str = "body") -> None:
    """Land the accepted weather responses as Parquet with a variant column.

    Spark shreds the variant: paths that most bodies share become typed
    columns of the file, the rest of a body stays beside them. A reader
    (``feeds.read_landed_weather``) then scans the paths that it uses.
    """
    wrap_responses(env, key, query, status, body).write.mode("errorifexists").parquet(path)
