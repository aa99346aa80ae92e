"""Registered queries on the test tables, each with an equivalent DuckDB SQL.

Stand-ins for the feed concepts (see FIXTURES.md §3):

* ``events`` is the flight fact — ``event_type`` ~ airline, ``user_id`` ~
  arrival code, ``ts`` ~ arrival time;
* ``customer`` without the ``BUILDING`` segment is the weather dimension —
  ``c_mktsegment`` ~ city, ``c_acctbal`` ~ temperature;
* ``documents`` left-joined to ``labels`` supplies null join keys;
* ``events.props`` is the loosely typed JSON.

Every query reads whole tables through the library operators; parameters
(the day ``D``, the backfill window) are fixed values of the test.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.functions.lookup import lookup
from aerostat.functions.scalars import (
    array_first,
    day_range,
    days_ago_in_zone,
    default_unknown,
    float_or_null,
    format_day,
    json_path,
    json_path_default,
    to_day,
    wall_clock_timestamp,
)
from aerostat.operators import aggregate as agg
from aerostat.operators import buckets, filters, joins, sinks, topk
from aerostat.operators.flatten import flatten
from aerostat.operators.setops import union_all
from aerostat.plans import reports
from aerostat.schemas import check_sink
from aerostat.session import scratch_path
from aerostat.sources import envelopes, footers
from aerostat.sources.feeds import read_flights, read_landed_weather
from aerostat.sources.feeds import weather as shape_weather
from aerostat.sources.tables import absent_days, as_view, landed_days, rows_on_days, scan_day_folders, scan_parquet, scan_table
from aerostat.testdata import SCHEMAS, table

# Fixed test parameters.
D = dt.date(2024, 1, 3)
BACKFILL_START, BACKFILL_END = dt.date(2024, 1, 8), dt.date(2024, 1, 15)
CITIES = ("MACHINERY", "FURNITURE")

Query = Callable[[SparkSession, str], DataFrame]


# --- shared building blocks -------------------------------------------------

def _weather_dim(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return c.select("c_custkey", F.col("c_mktsegment").alias("city"), F.col("c_acctbal").cast("float").alias("temp"))


def wide(spark: SparkSession, sf: str) -> DataFrame:
    """Flights (events) left-joined to the weather dimension."""
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    j = joins.left_join(e, _weather_dim(spark, sf), "user_id", "c_custkey")
    return j.withColumn("date", to_day("ts"))


WIDE_SQL = """WITH wide AS (
  SELECT e.event_id, e.event_type, e.user_id, e.ts, CAST(e.ts AS DATE) AS date,
         c.c_custkey, c.c_mktsegment AS city, CAST(c.c_acctbal AS FLOAT) AS temp
  FROM events e
  LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON e.user_id = c.c_custkey)
"""

D_SQL = f"DATE '{D}'"


def _events_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """One landed response per event: route (event_type, user_id).

    status: 500 for ``error`` events, no response (null) when value < 5,
    else 200. Bodies by value: cut off below 10, HTML below 15, without
    ``data`` below 20, a text beside the record below 25, an id that is no
    number below 30, else one good record.
    """
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", F.lit(500)).when(F.col("value") < 5, F.lit(None)).otherwise(F.lit(200))
    record = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("value")))
    v = F.col("value")
    body = (
        F.when(v < 10, F.lit('{"data": [{"id": '))
        .when(v < 15, F.lit("<html><body>busy</body></html>"))
        .when(v < 20, F.lit('{"error": {"code": 104}}'))
        .when(v < 25, F.concat(F.lit('{"data": ['), record, F.lit(', "oops"]}')))
        .when(v < 30, F.concat(F.lit('{"data": [{"id": "x", "value": '), v.cast("string"), F.lit("}]}")))
        .otherwise(F.concat(F.lit('{"data": ['), record, F.lit("]}")))
    )
    return e.select(
        F.col("event_type").alias("dep"),
        F.col("user_id").cast("string").alias("arr"),
        status.cast("int").alias("status"),
        body.alias("body"),
    )


ENVELOPE_RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType())])


# --- queries ----------------------------------------------------------------

def q_json_path(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", json_path(F.try_parse_json("props"), "$.k", "int").alias("k"))


def q_json_path_default(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", json_path_default(F.try_parse_json("props"), "$.main.temp", "Unknown").alias("w"))


def q_array_first(spark, sf):
    d = table(spark, sf, "documents")
    # limit 2: the first element equals a full split's, the second holds the
    # whole rest of the text, so no per-word array is built for long texts
    return d.select("doc_id", array_first(F.split("text", " ", 2)).alias("first_word"))


def _float_text() -> F.Column:
    size, price = F.col("p_size"), F.col("p_retailprice")
    return (
        F.when(size <= 12, F.col("p_brand"))
        .when(size <= 25, F.concat(F.lit(" "), price.cast("string"), F.lit(" ")))
        .when(size <= 37, size.cast("string"))
        .otherwise(F.lit(""))
    )


def q_float_or_null(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", float_or_null(_float_text()).cast("double").alias("f"))


def q_lookup_map(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", lookup("c_mktsegment", {"MACHINERY": "MAC", "FURNITURE": "FUR"}).alias("code"))


def q_left_join(spark, sf):
    return wide(spark, sf).select("event_id", "user_id", "c_custkey", "city", F.col("temp").cast("double").alias("temp"))


def q_left_join_fanout(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    # orders is the fan-out side; with eight rows a task most customers are
    # hot and are split, at every size
    return joins.left_join_split(c, o, "c_custkey", "o_custkey", spread_by=["o_orderkey"], rows_per_task=8) \
        .select("c_custkey", "o_orderkey")


def q_left_join_merge(spark, sf):
    """The left join with the shuffled plan forced."""
    e = table(spark, sf, "events").select("event_id", "user_id")
    j = joins.left_join(e, _weather_dim(spark, sf).hint("merge"), "user_id", "c_custkey")
    return j.select("event_id", "user_id", "c_custkey", "city", F.col("temp").cast("double").alias("temp"))


def _doc_label_keys(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("k"))
    return joins.left_join(d, lab, "doc_id", "k")


def q_left_join_null_key(spark, sf):
    a = _doc_label_keys(spark, sf)
    b = _doc_label_keys(spark, sf).select(F.col("doc_id").alias("m"), F.col("k").alias("bk"))
    return joins.left_join(a, b.hint("merge"), "k", "bk").select("doc_id", "m")


def q_filter_day_in(spark, sf):
    w = wide(spark, sf)
    return filters.select_day_cities(w, "date", D, "city", CITIES).select("event_id", "city")


def q_count_by_group(spark, sf):
    return agg.count_by_group(wide(spark, sf), "city", "n")


def q_value_counts(spark, sf):
    w = wide(spark, sf).where(F.col("date") == F.lit(D))
    return agg.value_counts(w, "city", "n")


def q_mean_by_group(spark, sf):
    m = agg.mean_by_group(wide(spark, sf), "city", "temp", "temp")
    return m.select("city", F.round("temp", 4).alias("temp"))


def q_count_and_mean(spark, sf):
    w = wide(spark, sf).where(F.col("date") == F.lit(D))
    m = agg.count_and_mean(w, "city", "c_custkey", "temp", "flight_count", "avg_temp")
    return m.select("city", "flight_count", F.round("avg_temp", 4).alias("avg_temp"))


def q_distinct_dates(spark, sf):
    e = table(spark, sf, "events").select(to_day("ts").alias("date"))
    return agg.distinct_values(e, "date", drop_null=True)


def q_distinct_nonnull(spark, sf):
    return agg.distinct_values(wide(spark, sf), "city", drop_null=True)


def q_preview_limit(spark, sf):
    return topk.preview(table(spark, sf, "orders"), 5, ["o_orderkey"])


def q_route_grid(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    routes = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("r_name").alias("dep"), F.col("n_name").alias("arr"), "n_nationkey")
    e = table(spark, sf, "events").select("event_id", "user_id")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    facts = e.join(c, e.user_id == c.c_custkey).select("event_id", "n_nationkey")
    grid = joins.route_grid(routes, facts, ["n_nationkey"], count_col="event_id", name="n")
    return grid.select("dep", "arr", "n")


def q_route_cap(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id")
    return topk.cap_per_key(e, ["event_type"], ["event_id"], 100)


def q_replace_day(spark, sf):
    e = table(spark, sf, "events")
    existing = e.select("event_id", to_day("ts").alias("date"))
    batch = e.where(to_day("ts").between(F.lit(D), F.lit(D + dt.timedelta(days=1)))).select(
        (F.col("event_id") + 1000000).alias("event_id"), to_day("ts").alias("date"))
    return sinks.replace_rows(existing, batch, "date", D)


def q_row_count_audit(spark, sf):
    return agg.row_counts({"orders": table(spark, sf, "orders"), "events": table(spark, sf, "events")}, "t", "n")


def _offset_text(o: DataFrame) -> F.Column:
    late = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    suffix = F.when(late, F.lit("T23:30:00-09:00")).otherwise(F.lit("T00:30:00+07:00"))
    return F.concat(format_day("o_orderdate"), suffix)


def q_derive_date(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", to_day(wall_clock_timestamp(_offset_text(o))).alias("date"))


def _backfill_src(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    hours = (F.floor(F.col("value") / 10) - 12).cast("int")
    arrival = F.when(F.col("value") < 10, F.lit(None).cast("date")).otherwise(
        F.to_date(F.timestamp_add("HOUR", hours, F.col("ts"))))
    return e.select("event_id", to_day("ts").alias("f"), arrival.alias("a"))


def q_backfill_replay(spark, sf):
    src = _backfill_src(spark, sf)
    in_window = F.col("f").between(F.lit(BACKFILL_START), F.lit(BACKFILL_END))
    existing = src.where(~in_window).select("event_id", "a")
    batches = src.where(in_window)
    return sinks.backfill_rows(existing, batches, "f", "a", BACKFILL_START, BACKFILL_END)


def q_flatten_nested(spark, sf):
    o = table(spark, sf, "orders")
    nested = o.select(F.struct(F.col("o_orderkey").alias("k"),
                               F.struct(F.col("o_orderstatus").alias("s")).alias("st")).alias("o"))
    return flatten(nested, {"order_key": "o.k", "order_status": "o.st.s"})


def q_scan_all(spark, sf):
    return scan_parquet(spark, f"{sf.rstrip('/')}/orders.parquet")  # the columns as the files have them


def q_temp_view_scan(spark, sf):
    name = f"supplier_{uuid.uuid4().hex[:12]}"
    as_view(table(spark, sf, "supplier"), name)
    try:
        return spark.sql(f"SELECT s_suppkey, s_name FROM {name}")
    finally:
        spark.catalog.dropTempView(name)  # the frame holds the resolved plan


def q_default_unknown(spark, sf):
    c = table(spark, sf, "customer")
    bal = F.col("c_acctbal")
    v = F.when(bal < 0, F.lit(None).cast("string")).when(bal < 1000, F.lit("  ")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", default_unknown(v).alias("v"))


def q_count_by_condition(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("l_doc_id"), F.col("quality").alias("condition"))
    j = joins.left_join(d, lab, "doc_id", "l_doc_id")
    return agg.count_by_group(j, "condition", "n")


def q_default_selection(spark, sf):
    dated = table(spark, sf, "events").select(to_day("ts").alias("date"))
    return filters.default_selection(wide(spark, sf), "date", "city", dated).select("event_id")


def q_route_semi_join(spark, sf):
    e = table(spark, sf, "events").where(filters.in_list("event_type", ["click", "view"]))
    m = table(spark, sf, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    return joins.semi_join(e, m, "user_id", "c_custkey").select("event_id")


def q_union_routes(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type")
    return union_all(e.where(F.col("event_type") == t) for t in ("click", "view"))


def _then_dropped(spark: SparkSession, name: str, kind: str = "TABLE") -> DataFrame:
    """Rows of a table that leaves the catalog now; its files stay under the shared folder."""
    back = spark.table(name)
    back.schema  # noqa: B018  resolves the relation
    spark.sql(f"DROP {kind} {name}")
    return back


def q_ctas_replace(spark, sf):
    o = table(spark, sf, "orders")
    name = f"ctas_{uuid.uuid4().hex[:12]}"
    loc = scratch_path(spark, "tables", name)
    first = agg.count_by_group(o.where(F.col("o_orderstatus") == "F"), "o_orderstatus", "n", ordered=False)
    sinks.create_or_replace_table(first, name, loc)
    sinks.create_or_replace_table(agg.count_by_group(o, "o_orderstatus", "n", ordered=False), name, loc)
    return _then_dropped(spark, name)


def q_typed_insert(spark, sf):
    o = table(spark, sf, "orders")
    name = f"typed_{uuid.uuid4().hex[:12]}"
    loc = scratch_path(spark, "tables", name)
    target = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("arrival_time", T.TimestampNTZType())])
    sinks.create_table_if_absent(spark, name, target, loc)
    text = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("t"))
    sinks.insert_typed(spark, text, name)
    return _then_dropped(spark, name)


def q_envelope_accept(spark, sf):
    env = _events_envelopes(spark, sf)
    return envelopes.accepted_records(env, ENVELOPE_RECORD)


def q_envelope_rejects(spark, sf):
    env = _events_envelopes(spark, sf)
    return envelopes.reject_summary(envelopes.rejected(env), "n")


def q_element_rejects(spark, sf):
    env = _events_envelopes(spark, sf)
    return envelopes.reject_summary(envelopes.element_rejects(env, ENVELOPE_RECORD), "n")


def _weather_envelopes(spark, sf) -> DataFrame:
    """One weather response per customer: by balance no response, an error status, a cut-off body, or a good one."""
    c = table(spark, sf, "customer")
    bal = F.col("c_acctbal")
    status = F.when(bal < 0, F.lit(None)).when(bal < 2000, F.lit(401)).otherwise(F.lit(200)).cast("int")
    body = F.when(bal < 4000, F.lit('{"main": {"temp": ')).otherwise(F.lit('{"main": {"temp": 3}}'))
    return c.select(F.col("c_mktsegment").alias("city"), F.col("c_name").alias("query"), status.alias("status"), body.alias("body"))


def q_weather_rejects(spark, sf):
    return envelopes.reject_summary(envelopes.weather_rejects(_weather_envelopes(spark, sf)), "n")


def q_weather_wrappers(spark, sf):
    w = envelopes.wrap_responses(_weather_envelopes(spark, sf))
    return w.select("city", "query", json_path("data", "$.main.temp", "int").alias("temp"))


def q_route_status(spark, sf):
    per_env = envelopes.per_route_status(_events_envelopes(spark, sf))
    return per_env.groupBy("dep", "outcome").agg(
        F.count(F.lit(1)).alias("responses"), F.sum("records").alias("records"))


def q_days_ago(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", days_ago_in_zone("ts", 7, "Asia/Bangkok").alias("day"))


def q_flight_feed_roundtrip(spark, sf):
    """events as nested flight records, landed as JSON lines, read back and flattened."""
    e = table(spark, sf, "events")
    path = scratch_path(spark, "landing", "flight")
    sinks.land_json(_nested_flights(e).select("record.*"), path)
    return read_flights(spark, path, multiline=False)


def _nested_flights(e: DataFrame, *more: F.Column) -> DataFrame:
    """``event_id``, further columns and the event as a nested flight ``record``."""
    return e.select("event_id", *more, F.struct(
        F.struct(F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("iata")).alias("flight"),
        F.struct(F.lit("BKK").alias("iata")).alias("departure"),
        F.struct(F.col("user_id").cast("string").alias("iata"),
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("scheduled"),
                 F.concat(F.col("event_type"), F.lit(" Intl")).alias("airport")).alias("arrival"),
        F.struct(F.col("event_type").alias("name")).alias("airline"),
    ).alias("record"))


def q_partition_roundtrip(spark, sf):
    """events written by day, one day rewritten again (idempotent), counts read back."""
    e = table(spark, sf, "events").select("event_id", to_day("ts").alias("ingest_date"))
    root = scratch_path(spark, "partitioned", "events")
    sinks.write_partitioned(e, root, "ingest_date")
    sinks.write_partitioned(e.where(F.col("ingest_date") == F.lit(D)), root, "ingest_date")
    back = scan_parquet(spark, root, schema=e.schema)
    return back.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


def q_partition_emptied(spark, sf):
    """events written by day; two days written again, one of them now without rows."""
    e = table(spark, sf, "events").select("event_id", to_day("ts").alias("ingest_date"))
    root = scratch_path(spark, "partitioned", "events")
    sinks.write_partitioned(e, root, "ingest_date")
    again = e.where(F.col("ingest_date") == F.lit(D + dt.timedelta(days=1)))
    sinks.write_partitioned(again, root, "ingest_date", [D, D + dt.timedelta(days=1)])
    back = scan_parquet(spark, root, schema=e.schema)
    return back.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


def _dated_table(spark: SparkSession, rows: DataFrame) -> str:
    """A table of (event_id, date), partitioned by date, that holds ``rows``."""
    name = f"dated_{uuid.uuid4().hex[:12]}"
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("date", T.DateType())])
    sinks.create_table_if_absent(spark, name, schema, scratch_path(spark, "tables", name), ["date"])
    rows.select("event_id", "date").hint("rebalance", "date").write.insertInto(name)
    return name


def _table_rows(spark: SparkSession, name: str) -> DataFrame:
    """Rows of a partitioned table that leaves the catalog now."""
    location = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return scan_parquet(spark, location, schema=schema)


def _replacement(e: DataFrame) -> DataFrame:
    return e.where(to_day("ts").between(F.lit(D), F.lit(D + dt.timedelta(days=1)))).select(
        (F.col("event_id") + 1000000).alias("event_id"), to_day("ts").alias("date"))


def q_replace_day_table(spark, sf):
    """``replace_day`` on a table partitioned by date."""
    e = table(spark, sf, "events")
    name = _dated_table(spark, e.select("event_id", to_day("ts").alias("date")))
    sinks.replace_date_partition(spark, name, _replacement(e), "date", D)
    return _table_rows(spark, name)


def q_replace_day_version(spark, sf):
    """``replace_day`` as a new partitioned version, published twice."""
    e = table(spark, sf, "events")
    name, root = f"versioned_{uuid.uuid4().hex[:12]}", scratch_path(spark, "versions")
    sinks.publish_version(spark, e.select("event_id", to_day("ts").alias("date")), name, root, ["date"])
    location = sinks.publish_version(spark, sinks.replace_rows(spark.table(name), _replacement(e), "date", D), name, root, ["date"])
    back = scan_parquet(spark, location, schema=spark.table(name).schema)
    version = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == sinks.VERSION).first()["value"]
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {version}")
    return back


def q_backfill_table(spark, sf):
    """``backfill_replay`` on a table partitioned by date."""
    src = _backfill_src(spark, sf)
    in_window = F.col("f").between(F.lit(BACKFILL_START), F.lit(BACKFILL_END))
    name = _dated_table(spark, src.where(~in_window).select("event_id", F.col("a").alias("date")))
    sinks.backfill_date_partitions(spark, name, src.where(in_window).withColumnRenamed("a", "date"), "f", "date",
                                   BACKFILL_START, BACKFILL_END)
    return _table_rows(spark, name).select("event_id", F.col("date").alias("a"))


DAY_ROW = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])


def _day_folders(spark, sf) -> tuple[str, list[str]]:
    """All days of events as the original lays them out, written in one job."""
    e = table(spark, sf, "events").select("event_id", "event_type", to_day("ts").alias("ingest_date"))
    root = scratch_path(spark, "day-folders")
    return root, sinks.write_day_folders(e, root)


def q_day_folders(spark, sf):
    root, days = _day_folders(spark, sf)
    return scan_day_folders(spark, root, days, schema=DAY_ROW).select("event_id", "event_type", "ingest_date")


def q_day_folders_first_part(spark, sf):
    """Rows of each day, and whether the part glob finds just those in files of that name."""
    root, days = _day_folders(spark, sf)
    named = F.col("_metadata.file_name").startswith("part-00000")
    every = scan_day_folders(spark, root, days, schema=DAY_ROW).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(named).alias("named"))
    first = scan_day_folders(spark, root, days, part_glob="part-00000*", schema=DAY_ROW).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("found"))
    return every.join(first, "ingest_date", "left").select(
        "ingest_date", "n", (F.coalesce("found", F.lit(0)) == F.col("named")).alias("parts_agree"))


def _by_day(spark, sf, *columns: str) -> tuple[str, T.StructType]:
    """events partitioned by day: where, and with which columns."""
    e = table(spark, sf, "events").select(*columns, to_day("ts").alias("ingest_date"))
    root = scratch_path(spark, "partitioned", "events")
    sinks.write_partitioned(e, root, "ingest_date")
    return root, e.schema


def q_days_by_query(spark, sf):
    """Events on the days that have more errors than the mean day; only their folders are read."""
    root, schema = _by_day(spark, sf, "event_id", "event_type")
    per_day = table(spark, sf, "events").where("event_type = 'error'").groupBy(to_day("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    busy = per_day.where(F.col("n") > per_day.select(F.avg("n")).scalar()).select("day")
    return rows_on_days(scan_parquet(spark, root, schema=schema), busy).select("event_id", "event_type", "ingest_date")


def q_absent_days(spark, sf):
    """Days from three before the first event to three after the last that have no folder."""
    root, _ = _by_day(spark, sf, "event_id")
    span = table(spark, sf, "events").agg(F.min(to_day("ts")).alias("s"), F.max(to_day("ts")).alias("e"))
    wanted = span.select(F.explode(F.sequence(F.date_sub("s", 3), F.date_add("e", 3))).alias("day"))
    return absent_days(wanted, landed_days(spark, root))


def q_flight_array_ranges(spark, sf):
    """events landed as one JSON array a day, read by byte ranges."""
    e = table(spark, sf, "events")
    path = scratch_path(spark, "landing", "day-arrays")
    nested = _nested_flights(e, to_day("ts").alias("day"))
    sinks.land_arrays(nested.select("day", "event_id", "record.*"), path, "day", ["event_id"])
    return read_flights(spark, path, split=True)


SERVING_ROW = T.StructType([T.StructField("airline", T.StringType()), T.StructField("flight_iata", T.StringType()),
                            T.StructField("city", T.StringType()), T.StructField("temp", T.FloatType()), T.StructField("date", T.DateType())])


def q_dashboard_frames(spark, sf):
    """The three dashboard frames of the default selection, from one scan of a serving dataset."""
    rows = wide(spark, sf).select(F.col("event_type").alias("airline"), F.concat(F.lit("EV"), F.col("event_id")).alias("flight_iata"),
                                  "city", "temp", "date", "event_id")
    path = scratch_path(spark, "serving")
    rows.repartitionByRange("date", "event_id").drop("event_id").write.parquet(path)
    return reports.default_dashboard(spark, path, SERVING_ROW).withColumn("mean", F.round("mean", 4))


FOOTER_COLUMNS = {"orders": "o_orderkey", "events": "event_id", "customer": "c_custkey", "lineitem": "l_orderkey"}


def q_footer_audit(spark, sf):
    """Rows, non-null keys and the least and greatest key of the large tables, from their footers."""
    parts = []
    for name, c in FOOTER_COLUMNS.items():
        stats = footers.footer_stats(spark, f"{sf.rstrip('/')}/{name}.parquet", table(spark, sf, name).schema, [c])
        parts.append(stats.select(F.lit(name).alias("t"), "n", F.col(f"{c}_filled").alias("filled"), F.col(f"{c}_low").alias("low"),
                                  F.col(f"{c}_high").alias("high")))
    return union_all(parts)


def q_footer_days(spark, sf):
    """Rows and ids of each day folder, from the footers of its files."""
    root, schema = _by_day(spark, sf, "event_id", "user_id")
    stats = footers.footer_stats(spark, root, schema, ["event_id", "user_id"], by="ingest_date")
    return stats.select("ingest_date", "n", F.col("user_id_filled").alias("users"), F.col("event_id_low").alias("low"),
                        F.col("event_id_high").alias("high"))


def _loose_orders(spark, sf) -> DataFrame:
    """Orders as text, some of it bad: keys of returned orders, urgent dates, small prices; blank low dates."""
    o = table(spark, sf, "orders")
    key = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("K"), F.col("o_orderkey"))).otherwise(F.col("o_orderkey").cast("string"))
    day = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("2001-13-45T00:00:00")).when(
        F.col("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    price = F.when(F.col("o_totalprice") < 50000, F.lit("n/a")).when(F.col("o_totalprice") < 90000, F.lit(None)).otherwise(
        F.col("o_totalprice").cast("string"))
    return o.select(key.alias("key"), day.alias("at"), price.alias("price"))


LOOSE_TARGET = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("arrival_time", T.TimestampNTZType()),
                             T.StructField("o_totalprice", T.DoubleType(), False)])


def _judged(spark, sf) -> str:
    root = scratch_path(spark, "judged")
    sinks.load_judged(_loose_orders(spark, sf), LOOSE_TARGET, root)
    return root


def q_judged_accepted(spark, sf):
    return sinks.accepted_rows(spark, _judged(spark, sf), LOOSE_TARGET)


def q_judged_rejects(spark, sf):
    rejects = sinks.rejected_rows(spark, _judged(spark, sf), LOOSE_TARGET)
    return rejects.groupBy(F.concat_ws("; ", "reasons").alias("reasons")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.get_json_object("source_row", "$.at")).alias("with_time"))


def q_content_audit(spark, sf):
    """Copies of three tables, and whether what is read back has the content that was written."""
    parts = []
    for name, by in (("orders", ["o_orderstatus"]), ("events", []), ("customer", ["c_mktsegment"])):
        df, path = table(spark, sf, name), scratch_path(spark, "audited", name)
        rows, content = sinks.write_audited(df, path, by)
        back = scan_parquet(spark, path, schema=df.schema).select(*df.columns).agg(*agg.content_sums(df))
        parts.append(back.select(F.lit(name).alias("t"), F.lit(rows).cast("long").alias("written"), F.col("rows").alias("read"),
                                 (F.col("content") == F.lit(str(content)).cast("decimal(38,0)")).alias("same")))
    return union_all(parts)


def q_weather_shredded(spark, sf):
    """The weather frame from bodies landed as shredded variants."""
    w = _weather_bodies(spark, sf)
    env = w.select("city", F.col("c_name").alias("query"), F.lit(200).alias("status"), "body")
    path = scratch_path(spark, "landing", "weather")
    envelopes.land_wrappers(env, path)
    return _rounded_weather(read_landed_weather(spark, path, "intent", SEGMENT_CODES, keep=["query"]), "query")


def q_route_gaps(spark, sf):
    """Runs of days without an event, per route of event type and user, over the days of all events."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("dep"), F.col("user_id").alias("arr"), to_day("ts").alias("day"))
    start, end = e.select(F.min("day")).scalar(), e.select(F.max("day")).scalar()
    return envelopes.missing_days(e.select("dep", "arr"), e, start, end)


def q_missing_routes(spark, sf):
    """Configured routes without any record."""
    facts = wide(spark, sf).select(F.col("event_type").alias("dep"), F.col("city").alias("arr"))
    return envelopes.missing_routes(joins.routes_from_lists(spark, ROUTE_DEPARTURES, ROUTE_ARRIVALS), facts)


def q_column_profile(spark, sf):
    """Exact parts of the profile of events, merged from one profile a day."""
    e = table(spark, sf, "events").withColumn("day", to_day("ts"))
    return agg.merged_profile(agg.profile(e, ["day"])).drop("distinct")


def q_bucketed_join(spark, sf):
    """``left_join`` on tables bucketed by the arrival code."""
    facts, dimension = f"facts_{uuid.uuid4().hex[:12]}", f"dimension_{uuid.uuid4().hex[:12]}"
    e = table(spark, sf, "events").select("event_id", "user_id")
    # with eight rows a part many users are hot, at every size
    buckets.create_bucketed_tables(e, _weather_dim(spark, sf), facts, dimension, scratch_path(spark, "tables", facts),
                                   scratch_path(spark, "tables", dimension), "user_id", "c_custkey", ["event_id"], 16, 8)
    out = buckets.bucketed_left_join(spark, facts, dimension, "user_id", "c_custkey").select(
        "event_id", "user_id", "c_custkey", "city", F.col("temp").cast("double").alias("temp"))
    out.schema  # noqa: B018  resolves the relations
    for name in (facts, dimension):
        spark.sql(f"DROP TABLE {name}")  # leaves the files
    return out


def q_scan_table(spark, sf):
    name = f"supplier_{uuid.uuid4().hex[:12]}"
    sinks.create_or_replace_table(table(spark, sf, "supplier"), name, scratch_path(spark, "tables", name))
    back = scan_table(spark, name).select("s_suppkey", "s_name", "s_nationkey")
    spark.sql(f"DROP TABLE {name}")
    return back


def q_schema_fields(spark, sf):
    """Columns of a table in order, as its files have them, with the values that its rows have in them."""
    fields = agg.merged_profile(agg.profile(scan_parquet(spark, f"{sf.rstrip('/')}/events.parquet")))
    return fields.select("position", "name", "type", (F.col("n") - F.col("nulls")).alias("filled"))


ORDER_CONTRACT = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.DateType()),
                               T.StructField("o_totalprice", T.DoubleType())])


def q_contract(spark, sf):
    """Rows shaped to a fixed contract and checked against it."""
    o = table(spark, sf, "orders")
    return check_sink(o.select(*[F.col(f.name).cast(f.dataType) for f in ORDER_CONTRACT.fields]), ORDER_CONTRACT)


ROUTE_DEPARTURES, ROUTE_ARRIVALS = ("click", "view", "refund"), ("MACHINERY", "FURNITURE", "NOWHERE")


def q_route_list_grid(spark, sf):
    """Counts of a configured route list; some of its routes have no records."""
    facts = wide(spark, sf).select(F.col("event_type").alias("dep"), F.col("city").alias("arr"), "event_id")
    routes = joins.routes_from_lists(spark, ROUTE_DEPARTURES, ROUTE_ARRIVALS)
    return joins.route_grid(routes, facts, ["dep", "arr"], count_col="event_id", name="n")


def q_flight_array_feed(spark, sf):
    """events as JSON arrays of a thousand records, one array a file, read as multi-line JSON."""
    e = table(spark, sf, "events")
    arrays = _nested_flights(e).groupBy(F.floor(F.col("event_id") / 1000).alias("file")).agg(
        F.to_json(F.collect_list("record")).alias("value"))
    path = scratch_path(spark, "landing", "arrays")
    # one array a file: the option bounds a file to one row
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_flights(spark, path, multiline=True)


def q_format_day(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", format_day("ts").alias("day"))


def q_day_range(spark, sf):
    e = table(spark, sf, "events").agg(F.max(to_day("ts")).alias("e"))
    return e.select(F.explode(day_range("e", 7)).alias("day"))


# Segment -> code lookup standing in for city -> airport code (BUILDING unmapped).
SEGMENT_CODES = {"AUTOMOBILE": "AUT", "FURNITURE": "FUR", "HOUSEHOLD": "HOU", "MACHINERY": "MAC"}


def _weather_bodies(spark, sf) -> DataFrame:
    """Bodies of weather responses built from customer rows, with loosely typed leaves.

    temp is a JSON number (AUTOMOBILE), a numeric string (FURNITURE), a
    blank-padded numeric string (HOUSEHOLD), a boolean (MACHINERY) or junk
    text (BUILDING); wind is absent for a negative balance; the condition
    list holds the customer name for a positive balance (a number instead
    for every third nation) and is empty else.
    """
    c = table(spark, sf, "customer")
    bal = F.col("c_acctbal").cast("string")
    seg = F.col("c_mktsegment")
    temp = (
        F.when(seg == "AUTOMOBILE", bal)
        .when(seg == "FURNITURE", F.concat(F.lit('"'), bal, F.lit('"')))
        .when(seg == "HOUSEHOLD", F.concat(F.lit('" '), bal, F.lit(' "')))
        .when(seg == "MACHINERY", F.when(F.col("c_acctbal") > 0, F.lit("true")).otherwise(F.lit("false")))
        .otherwise(F.lit('"n/a"'))
    )
    nk = F.col("c_nationkey").cast("string")
    wind = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit('"wind": {"speed": '), nk, F.lit("}, ")))
    main = F.when(F.col("c_nationkey") % 3 == 0, nk).otherwise(F.concat(F.lit('"'), F.col("c_name"), F.lit('"')))
    cond = F.when(F.col("c_acctbal") > 0, F.concat(F.lit('[{"main": '), main, F.lit("}]")))
    body = F.concat(F.lit('{"main": {"temp": '), temp, F.lit(', "humidity": '), nk, F.lit("}, "), wind,
                    F.lit('"weather": '), F.coalesce(cond, F.lit("[]")), F.lit("}"))
    return c.select("c_custkey", "c_name", seg.alias("city"), body.alias("body"))


def _rounded_weather(w: DataFrame, key: str) -> DataFrame:
    return w.select(key, "city", "iata", F.round(F.col("temp").cast("double"), 2).alias("temp"),
                    F.col("humidity").cast("double").alias("humidity"), "weather",
                    F.col("wind_speed").cast("double").alias("wind_speed"))


def q_weather_shape(spark, sf):
    bodies = _weather_bodies(spark, sf)
    wrappers = bodies.select("c_custkey", "city", F.col("city").alias("query"), F.try_parse_json("body").alias("data"))
    return _rounded_weather(shape_weather(wrappers, "intent", SEGMENT_CODES, keep=["c_custkey"]), "c_custkey")


QUERIES: dict[str, Query] = {
    "json_path": q_json_path,
    "json_path_default": q_json_path_default,
    "array_first": q_array_first,
    "float_or_null": q_float_or_null,
    "lookup_map": q_lookup_map,
    "left_join": q_left_join,
    "left_join_fanout": q_left_join_fanout,
    "left_join_null_key": q_left_join_null_key,
    "filter_day_in": q_filter_day_in,
    "count_by_group": q_count_by_group,
    "value_counts": q_value_counts,
    "mean_by_group": q_mean_by_group,
    "count_and_mean": q_count_and_mean,
    "distinct_dates": q_distinct_dates,
    "distinct_nonnull": q_distinct_nonnull,
    "preview_limit": q_preview_limit,
    "route_grid": q_route_grid,
    "route_cap": q_route_cap,
    "replace_day": q_replace_day,
    "row_count_audit": q_row_count_audit,
    "derive_date": q_derive_date,
    "backfill_replay": q_backfill_replay,
    "flatten_nested": q_flatten_nested,
    "scan_all": q_scan_all,
    "temp_view_scan": q_temp_view_scan,
    "default_unknown": q_default_unknown,
    "count_by_condition": q_count_by_condition,
    "default_selection": q_default_selection,
    "route_semi_join": q_route_semi_join,
    "union_routes": q_union_routes,
    "ctas_replace": q_ctas_replace,
    "typed_insert": q_typed_insert,
    "envelope_accept": q_envelope_accept,
    "envelope_rejects": q_envelope_rejects,
    "format_day": q_format_day,
    "days_ago": q_days_ago,
    "flight_feed_roundtrip": q_flight_feed_roundtrip,
    "partition_roundtrip": q_partition_roundtrip,
    "day_range": q_day_range,
    "weather_shape": q_weather_shape,
    "route_status": q_route_status,
    "left_join_merge": q_left_join_merge,
    "element_rejects": q_element_rejects,
    "weather_rejects": q_weather_rejects,
    "weather_wrappers": q_weather_wrappers,
    "partition_emptied": q_partition_emptied,
    "replace_day_table": q_replace_day_table,
    "replace_day_version": q_replace_day_version,
    "backfill_table": q_backfill_table,
    "day_folders": q_day_folders,
    "day_folders_first_part": q_day_folders_first_part,
    "scan_table": q_scan_table,
    "schema_fields": q_schema_fields,
    "contract": q_contract,
    "route_list_grid": q_route_list_grid,
    "flight_array_feed": q_flight_array_feed,
    "days_by_query": q_days_by_query,
    "absent_days": q_absent_days,
    "flight_array_ranges": q_flight_array_ranges,
    "dashboard_frames": q_dashboard_frames,
    "footer_audit": q_footer_audit,
    "footer_days": q_footer_days,
    "judged_accepted": q_judged_accepted,
    "judged_rejects": q_judged_rejects,
    "content_audit": q_content_audit,
    "weather_shredded": q_weather_shredded,
    "route_gaps": q_route_gaps,
    "missing_routes": q_missing_routes,
    "column_profile": q_column_profile,
    "bucketed_join": q_bucketed_join,
}


# --- oracle SQL (DuckDB) ----------------------------------------------------

_S, _E = f"DATE '{BACKFILL_START}'", f"DATE '{BACKFILL_END}'"

ORACLE_SQL: dict[str, str] = {
    "json_path": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "json_path_default": "SELECT event_id, COALESCE(json_extract_string(props, '$.main.temp'), 'Unknown') AS w FROM events",
    "array_first": "SELECT doc_id, string_split(text, ' ')[1] AS first_word FROM documents",
    "float_or_null": """SELECT p_partkey, CAST(TRY_CAST(
        CASE WHEN p_size <= 12 THEN p_brand
             WHEN p_size <= 25 THEN ' ' || CAST(p_retailprice AS VARCHAR) || ' '
             WHEN p_size <= 37 THEN CAST(p_size AS VARCHAR)
             ELSE '' END AS FLOAT) AS DOUBLE) AS f FROM part""",
    "lookup_map": "SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'MAC' WHEN 'FURNITURE' THEN 'FUR' END AS code FROM customer",
    "left_join": WIDE_SQL + "SELECT event_id, user_id, c_custkey, city, CAST(temp AS DOUBLE) AS temp FROM wide",
    "left_join_fanout": "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey",
    "left_join_null_key": """WITH x AS (SELECT d.doc_id, l.doc_id AS k FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
        SELECT a.doc_id, b.doc_id AS m FROM x a LEFT JOIN x b ON a.k = b.k""",
    "filter_day_in": WIDE_SQL + f"SELECT event_id, city FROM wide WHERE date = {D_SQL} AND city IN ('MACHINERY', 'FURNITURE')",
    "count_by_group": WIDE_SQL + "SELECT city, COUNT(*) AS n FROM wide GROUP BY city ORDER BY n DESC, city NULLS FIRST",
    "value_counts": WIDE_SQL + f"SELECT city, COUNT(*) AS n FROM wide WHERE date = {D_SQL} AND city IS NOT NULL GROUP BY city ORDER BY n DESC, city",
    "mean_by_group": WIDE_SQL + "SELECT city, ROUND(AVG(temp), 4) AS temp FROM wide WHERE city IS NOT NULL GROUP BY city ORDER BY city",
    "count_and_mean": WIDE_SQL + f"""SELECT city, COUNT(c_custkey) AS flight_count, ROUND(AVG(temp), 4) AS avg_temp
        FROM wide WHERE date = {D_SQL} AND city IS NOT NULL GROUP BY city ORDER BY city""",
    "distinct_dates": "SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE ts IS NOT NULL ORDER BY 1",
    "distinct_nonnull": WIDE_SQL + "SELECT DISTINCT city FROM wide WHERE city IS NOT NULL ORDER BY 1",
    "preview_limit": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "route_grid": """SELECT r.r_name AS dep, n.n_name AS arr, COUNT(f.event_id) AS n
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (SELECT e.event_id, c.c_nationkey FROM events e JOIN customer c ON e.user_id = c.c_custkey) f
          ON f.c_nationkey = n.n_nationkey
        GROUP BY r.r_name, n.n_name""",
    "route_cap": """SELECT event_type, event_id FROM (
        SELECT event_type, event_id, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) x
        WHERE rn <= 100""",
    "replace_day": f"""SELECT event_id, date FROM (SELECT event_id, CAST(ts AS DATE) AS date FROM events) x
        WHERE date IS DISTINCT FROM {D_SQL}
        UNION ALL
        SELECT event_id + 1000000 AS event_id, CAST(ts AS DATE) AS date FROM events
        WHERE CAST(ts AS DATE) BETWEEN {D_SQL} AND {D_SQL} + INTERVAL 1 DAY""",
    "row_count_audit": "SELECT 'orders' AS t, COUNT(*) AS n FROM orders UNION ALL SELECT 'events' AS t, COUNT(*) AS n FROM events",
    "derive_date": """SELECT o_orderkey, CAST(SUBSTRING(s, 1, 10) AS DATE) AS date FROM (
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') ||
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'T23:30:00-09:00' ELSE 'T00:30:00+07:00' END AS s
        FROM orders) x""",
    "backfill_replay": f"""WITH src AS (
          SELECT event_id, CAST(ts AS DATE) AS f,
                 CASE WHEN value < 10 THEN NULL
                      ELSE CAST(ts + to_hours(CAST(FLOOR(value / 10) - 12 AS BIGINT)) AS DATE) END AS a
          FROM events)
        SELECT event_id, a FROM src WHERE (f < {_S} OR f > {_E}) AND (a IS NULL OR a NOT BETWEEN {_S} AND {_E})
        UNION ALL
        SELECT event_id, a FROM src WHERE f BETWEEN {_S} AND {_E} AND (a IS NULL OR NOT (a > f AND a <= {_E}))""",
    "flatten_nested": "SELECT o_orderkey AS order_key, o_orderstatus AS order_status FROM orders",
    "scan_all": "SELECT * FROM orders",
    "temp_view_scan": "SELECT s_suppkey, s_name FROM supplier",
    "default_unknown": """SELECT c_custkey, CASE WHEN v IS NULL OR TRIM(v) = '' THEN 'Unknown' ELSE v END AS v FROM (
        SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '  ' ELSE c_mktsegment END AS v
        FROM customer) x""",
    "count_by_condition": """SELECT l.quality AS condition, COUNT(*) AS n
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    "default_selection": WIDE_SQL + "SELECT event_id FROM wide WHERE date = (SELECT MIN(CAST(ts AS DATE)) FROM events) AND city IS NOT NULL",
    "route_semi_join": """SELECT event_id FROM events WHERE event_type IN ('click', 'view')
        AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
    "union_routes": """SELECT event_id, event_type FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'view'""",
    "ctas_replace": "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1",
    "typed_insert": "SELECT o_orderkey, o_orderdate AS arrival_time FROM orders",
    "envelope_accept": """SELECT event_type AS dep, CAST(user_id AS VARCHAR) AS arr, CASE WHEN value >= 25 AND value < 30 THEN NULL ELSE event_id END AS id, value
        FROM events WHERE event_type <> 'error' AND value >= 20""",
    "envelope_rejects": """SELECT CASE WHEN event_type = 'error' THEN 'http_error'
                    WHEN value < 15 THEN 'request_failed' ELSE 'no_data' END AS reason, COUNT(*) AS n
        FROM events WHERE event_type = 'error' OR value < 20 GROUP BY 1""",
    "element_rejects": """SELECT CASE WHEN value < 25 THEN 'not_an_object' ELSE 'bad_field' END AS reason, COUNT(*) AS n
        FROM events WHERE event_type <> 'error' AND value >= 20 AND value < 30 GROUP BY 1""",
    "weather_rejects": """SELECT CASE WHEN c_acctbal >= 0 AND c_acctbal < 2000 THEN 'http_error' ELSE 'request_failed' END AS reason,
          COUNT(*) AS n FROM customer WHERE c_acctbal < 4000 GROUP BY 1""",
    "weather_wrappers": "SELECT c_mktsegment AS city, c_name AS query, 3 AS temp FROM customer WHERE c_acctbal >= 4000",
    "format_day": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
    # Asia/Bangkok has kept UTC+7 without daylight saving since 1920
    "days_ago": "SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS DATE) - 7 AS day FROM events",
    "flight_feed_roundtrip": """SELECT 'EV' || CAST(event_id AS VARCHAR) AS flight_iata, 'BKK' AS departure_iata,
          CAST(user_id AS VARCHAR) AS arrival_iata, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS arrival_time,
          event_type AS airline, event_type || ' Intl' AS arr_airport
        FROM events""",
    "partition_roundtrip": "SELECT CAST(ts AS DATE) AS ingest_date, COUNT(*) AS n FROM events GROUP BY 1",
    "day_range": """SELECT CAST(unnest(generate_series(CAST(e AS TIMESTAMP) - INTERVAL 7 DAY, CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT MAX(CAST(ts AS DATE)) AS e FROM events) m""",
    "route_status": """SELECT dep, outcome, COUNT(*) AS responses, CAST(SUM(records) AS BIGINT) AS records FROM (
          SELECT event_type AS dep,
                 CASE WHEN event_type <> 'error' AND value >= 20 THEN 1 ELSE 0 END AS records,
                 CASE WHEN event_type = 'error' THEN 'http_error' WHEN value < 15 THEN 'request_failed'
                      WHEN value < 20 THEN 'no_data' ELSE 'ok' END AS outcome
          FROM events) x GROUP BY dep, outcome""",
    "weather_shape": """SELECT c_custkey, c_mktsegment AS city,
          CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUT' WHEN 'FURNITURE' THEN 'FUR'
                            WHEN 'HOUSEHOLD' THEN 'HOU' WHEN 'MACHINERY' THEN 'MAC' END AS iata,
          ROUND(CAST(CASE c_mktsegment WHEN 'BUILDING' THEN NULL
                                       WHEN 'MACHINERY' THEN CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END
                                       ELSE CAST(c_acctbal AS FLOAT) END AS DOUBLE), 2) AS temp,
          CAST(c_nationkey AS DOUBLE) AS humidity,
          CASE WHEN c_acctbal > 0 AND c_nationkey % 3 <> 0 THEN c_name ELSE 'Unknown' END AS weather,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS wind_speed
        FROM customer""",
}

ORACLE_SQL |= {
    "left_join_merge": ORACLE_SQL["left_join"],
    "replace_day_table": ORACLE_SQL["replace_day"],
    "replace_day_version": ORACLE_SQL["replace_day"],
    "backfill_table": ORACLE_SQL["backfill_replay"],
    "flight_array_feed": ORACLE_SQL["flight_feed_roundtrip"],
    "partition_emptied": f"""SELECT CAST(ts AS DATE) AS ingest_date, COUNT(*) AS n FROM events
        WHERE CAST(ts AS DATE) IS DISTINCT FROM {D_SQL} GROUP BY 1""",
    "day_folders": "SELECT event_id, event_type, CAST(ts AS DATE) AS ingest_date FROM events",
    "day_folders_first_part": "SELECT CAST(ts AS DATE) AS ingest_date, COUNT(*) AS n, TRUE AS parts_agree FROM events GROUP BY 1",
    "scan_table": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "contract": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders",
    "route_list_grid": WIDE_SQL + """SELECT d.dep, a.arr, COUNT(w.event_id) AS n
        FROM (VALUES ('click'), ('view'), ('refund')) d(dep) CROSS JOIN (VALUES ('MACHINERY'), ('FURNITURE'), ('NOWHERE')) a(arr)
        LEFT JOIN wide w ON w.event_type = d.dep AND w.city = a.arr GROUP BY d.dep, a.arr""",
}

_EVENT_FIELDS = [f.split() for f in SCHEMAS["events"].split(", ")]


def _event_fields(columns: Callable[[str, str], str]) -> str:
    """One row per column of events, with what ``columns`` says of it."""
    rows = [f"SELECT {i} AS position, '{c}' AS name, '{t}' AS type, {columns(c, t)} FROM events"
            for i, (c, t) in enumerate(_EVENT_FIELDS)]
    return " UNION ALL ".join(rows)


def _as_text(column: str, kind: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')" if kind == "timestamp_ntz" else f"CAST({column} AS VARCHAR)"


_JUDGED = """WITH loose AS (
          SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus = 'P' AS bad_key, o_orderpriority = '1-URGENT' AS bad_time,
                 o_orderpriority = '5-LOW' AS no_time, o_totalprice < 50000 AS bad_price, o_totalprice >= 50000 AND o_totalprice < 90000 AS no_price
          FROM orders)
"""

ORACLE_SQL |= {
    "schema_fields": _event_fields(lambda c, t: f"COUNT({c}) AS filled"),
    "column_profile": _event_fields(lambda c, t: f"""COUNT(*) AS n, COUNT(*) - COUNT({c}) AS nulls,
          {_as_text(f"MIN({c})", t)} AS low, {_as_text(f"MAX({c})", t)} AS high"""),
    "days_by_query": """WITH errors AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
        SELECT event_id, event_type, CAST(ts AS DATE) AS ingest_date FROM events
        WHERE CAST(ts AS DATE) IN (SELECT day FROM errors WHERE n > (SELECT AVG(n) FROM errors))""",
    "absent_days": """SELECT day FROM (SELECT CAST(unnest(generate_series(MIN(CAST(ts AS DATE)) - INTERVAL 3 DAY,
          MAX(CAST(ts AS DATE)) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM events) w
        WHERE day NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE ts IS NOT NULL)""",
    "flight_array_ranges": ORACLE_SQL["flight_feed_roundtrip"],
    "dashboard_frames": WIDE_SQL + """, picked AS (
          SELECT * FROM wide WHERE date = (SELECT MIN(CAST(ts AS DATE)) FROM events) AND city IS NOT NULL)
        SELECT 'flights_per_airline' AS frame, event_type AS key, COUNT(*) AS n, CAST(NULL AS DOUBLE) AS mean
        FROM picked WHERE event_type IS NOT NULL GROUP BY event_type
        UNION ALL SELECT 'avg_temp_by_city', city, NULL, ROUND(AVG(temp), 4) FROM picked GROUP BY city
        UNION ALL SELECT 'flights_vs_temp', city, COUNT(event_id), ROUND(AVG(temp), 4) FROM picked GROUP BY city""",
    "footer_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS t, COUNT(*) AS n, COUNT({c}) AS filled, MIN({c}) AS low, MAX({c}) AS high FROM {t}"
        for t, c in FOOTER_COLUMNS.items()),
    "footer_days": """SELECT CAST(ts AS DATE) AS ingest_date, COUNT(*) AS n, COUNT(user_id) AS users, MIN(event_id) AS low,
          MAX(event_id) AS high FROM events GROUP BY 1""",
    "judged_accepted": _JUDGED + """SELECT o_orderkey, CASE WHEN no_time THEN NULL ELSE o_orderdate END AS arrival_time, o_totalprice
        FROM loose WHERE NOT (bad_key OR bad_time OR bad_price OR no_price)""",
    "judged_rejects": _JUDGED + """SELECT concat_ws('; ', CASE WHEN bad_key THEN 'o_orderkey: bad value' END,
            CASE WHEN bad_time THEN 'arrival_time: bad value' END, CASE WHEN bad_price THEN 'o_totalprice: bad value'
            WHEN no_price THEN 'o_totalprice: missing' END) AS reasons, COUNT(*) AS n, COUNT(*) AS with_time
        FROM loose WHERE bad_key OR bad_time OR bad_price OR no_price GROUP BY 1""",
    "content_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS t, COUNT(*) AS written, COUNT(*) AS read, TRUE AS same FROM {t}" for t in ("orders", "events", "customer")),
    "weather_shredded": ORACLE_SQL["weather_shape"].replace("SELECT c_custkey,", "SELECT c_name AS query,"),
    "route_gaps": """WITH seen AS (SELECT DISTINCT event_type AS dep, user_id AS arr, CAST(ts AS DATE) AS day FROM events),
        span AS (SELECT MIN(day) AS s, MAX(day) AS e FROM seen),
        grid AS (SELECT dep, arr, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
                 FROM (SELECT DISTINCT dep, arr FROM seen) r, span),
        missing AS (SELECT g.*, day - CAST(row_number() OVER (PARTITION BY dep, arr ORDER BY day) AS INT) AS run
                    FROM grid g ANTI JOIN seen USING (dep, arr, day))
        SELECT dep, arr, MIN(day) AS first_day, MAX(day) AS last_day, CAST(COUNT(*) AS INT) AS days FROM missing GROUP BY dep, arr, run""",
    "missing_routes": WIDE_SQL + """SELECT d.dep, a.arr
        FROM (VALUES ('click'), ('view'), ('refund')) d(dep) CROSS JOIN (VALUES ('MACHINERY'), ('FURNITURE'), ('NOWHERE')) a(arr)
        WHERE NOT EXISTS (SELECT 1 FROM wide w WHERE w.event_type = d.dep AND w.city = a.arr)""",
    "bucketed_join": ORACLE_SQL["left_join"],
}

assert set(QUERIES) == set(ORACLE_SQL), set(QUERIES) ^ set(ORACLE_SQL)

FLAGSHIP = "count_and_mean"
