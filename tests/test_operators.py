"""Operators against brute force, and the plan shapes they must produce."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerostat.functions import (
    array_first, day_range, days_ago_in_zone, default_unknown, float_or_null, format_day, is_string, json_path,
    json_path_default, lookup,
)
from aerostat.operators import aggregate as agg
from aerostat.operators import filters, topk
from aerostat.testdata import table
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cap_per_key_equals_row_number_with_hot_key(spark):
    # key 0 holds a third of all rows; order by a unique id
    df = spark.range(0, 30000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id"))
    got = topk.cap_per_key(df, ["k"], ["id"], 7, fanout=4)
    w = Window.partitionBy("k").orderBy("id")
    want = df.withColumn("rn", F.row_number().over(w)).where("rn <= 7").drop("rn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "WindowGroupLimit" in _plan(got)


def test_preview_is_take_ordered(spark):
    df = topk.preview(table(spark, SF_SMALL, "orders"), 5, ["o_orderkey"])
    assert "TakeOrderedAndProject" in _plan(df)
    assert [r.o_orderkey for r in df.collect()] == sorted(r.o_orderkey for r in df.collect())


def test_day_filter_is_pushed_to_scan(spark):
    ev = table(spark, SF_SMALL, "events")
    plan = _plan(ev.where(filters.on_day("ts", "2024-01-03")).select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_aggregates_are_partial_then_final(spark):
    ev = table(spark, SF_SMALL, "events")
    plan = _plan(agg.count_by_group(ev, "event_type", ordered=False))
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan


def test_observed_counts_in_same_job(spark, workdir):
    df, obs = agg.observed(spark.range(42), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 42


def test_scalars(spark):
    df = spark.createDataFrame(
        [('{"k": 3, "a": {"b": "x"}}', "alpha beta", " 2.5 ", "  ", "2024-01-03 17:30:00")],
        "j string, t string, f string, b string, now string")
    v = F.try_parse_json("j")
    r = df.select(
        json_path(v, "$.k", "int").alias("k"),
        json_path(v, "$.a.b").alias("ab"),
        json_path(v, "$.a.b.c").alias("missing"),
        json_path_default(v, "$.nope", "Unknown").alias("d"),
        is_string(v, "$.a.b").alias("s1"),
        is_string(v, "$.k").alias("s2"),
        array_first(F.split("t", " ")).alias("first"),
        array_first(F.array().cast("array<string>")).alias("none"),
        float_or_null("f").alias("f"),
        float_or_null("b").alias("fb"),
        default_unknown("b").alias("u"),
        lookup(F.lit("Taipei")).alias("tpe"),
        format_day(F.to_timestamp_ntz("now")).alias("day"),
        days_ago_in_zone(F.to_timestamp_ntz("now"), 7).alias("ago"),
        day_range(F.lit(dt.date(2024, 1, 15)), 7).alias("rng"),
    ).first()
    assert (r.k, r.ab, r.missing, r.d) == (3, "x", None, "Unknown")
    assert (r.s1, r.s2, r.first, r.none) == (True, False, "alpha", None)
    assert (r.f, r.fb, r.u, r.tpe) == (2.5, None, "Unknown", "TPE")
    # 17:30 UTC is 00:30 next day in Bangkok (UTC+7)
    assert r.day == "2024-01-03" and r.ago == dt.date(2024, 1, 4) - dt.timedelta(days=7)
    assert r.rng == [dt.date(2024, 1, 8) + dt.timedelta(days=i) for i in range(8)]


def test_wall_clock_timestamp_blank_null_malformed_fails(spark):
    import pytest
    from aerostat.functions import wall_clock_timestamp
    ok = spark.createDataFrame([("2025-04-02T23:30:00-09:00",), ("  ",), (None,)], "s string")
    got = [r.t for r in ok.select(wall_clock_timestamp("s").alias("t")).collect()]
    assert got == [dt.datetime(2025, 4, 2, 23, 30), None, None]
    bad = spark.createDataFrame([("garbage",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        bad.select(wall_clock_timestamp("s")).collect()


@settings(max_examples=10, deadline=None)
@given(keys_=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=0, max_size=60),
       k=st.integers(1, 5), fanout=st.integers(1, 6), parts=st.integers(1, 7))
def test_cap_per_key_property(spark, keys_, k, fanout, parts):
    rows = [(key, i) for i, key in enumerate(keys_)]
    df = spark.createDataFrame(rows, "key int, id int").repartition(parts)
    got = sorted(map(tuple, topk.cap_per_key(df, ["key"], ["id"], k, fanout=fanout).collect()), key=str)
    want = []
    for key in set(keys_):
        want += sorted([r for r in rows if r[0] == key], key=lambda r: r[1])[:k]
    assert got == sorted(want, key=str)
