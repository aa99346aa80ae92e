"""Counts and extremes from footers, the one-pass dashboard, profiles and content sums."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.operators import aggregate as agg
from aerostat.operators import sinks
from aerostat.plans import reports
from aerostat.sources import footers
from tests.test_daily_plan import plan_of

D = dt.date(2024, 1, 1)


@pytest.fixture()
def numbers(spark, workdir):
    rows = [(i if i % 3 else None, i / 4 if i % 3 != 1 else None, f"t{i}" if i % 5 else None, D + dt.timedelta(days=i % 4), i % 2 == 0, f"p{i % 2}")
            for i in range(100)]
    df = spark.createDataFrame(rows, "a long, b double, t string, d date, f boolean, p string")
    df.repartition(3).write.partitionBy("p").parquet(f"{workdir}/n")
    return f"{workdir}/n", df


def test_stats_are_pushed_to_the_footers(spark, numbers):
    path, df = numbers
    stats = footers.footer_stats(spark, path, df.schema, ["a", "b", "t", "d", "f"])
    plan = plan_of(stats)
    assert "PushedAggregation: [COUNT(*)" in plan and "BatchScan parquet" in plan
    want = df.agg(F.count("*"), F.count("a"), F.min("a"), F.max("a"), F.count("b"), F.min("b"), F.max("b"), F.count("t"),
                  F.count("d"), F.min("d"), F.max("d"), F.count("f"), F.min("f"), F.max("f")).first()
    assert tuple(stats.first()) == tuple(want) and want[1] < want[0]
    by = footers.footer_stats(spark, path, df.schema, ["a"], by="p")
    assert "PushedGroupBy: [p]" in plan_of(by)
    assert sorted(map(tuple, by.collect())) == sorted(map(tuple, df.groupBy("p").agg(F.count("*"), F.count("a"), F.min("a"), F.max("a")).collect()))
    assert "BatchScan" not in plan_of(spark.read.parquet(path).agg(F.count("*")))  # the caller's session is as before


def test_only_nulls_and_no_rows(spark, workdir):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("date", T.DateType())])
    spark.createDataFrame([(1, None), (2, None)], schema).coalesce(1).write.parquet(f"{workdir}/x")
    assert footers.column_range(spark, f"{workdir}/x", schema, "date") == (2, 0, None, None)
    spark.createDataFrame([(1, D), (2, None)], schema).coalesce(1).write.mode("append").parquet(f"{workdir}/x")
    assert footers.column_range(spark, f"{workdir}/x", schema, "date") == (4, 1, D, D)
    spark.createDataFrame([], schema).write.parquet(f"{workdir}/none")
    assert footers.column_range(spark, f"{workdir}/none", schema, "date") == (0, 0, None, None)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        footers.column_range(spark, f"{workdir}/missing", schema, "date")


SERVING = "airline string, city string, flight_iata string, temp float, date date"


def test_dashboard_in_one_scan(spark, workdir):
    rng = random.Random(1)
    rows = [(rng.choice(["A", "B", None]), rng.choice(["x", "y", "z", None]), rng.choice(["f", None]), rng.choice([1.5, 7.0, None]),
             D + dt.timedelta(days=rng.randrange(3))) for _ in range(300)] + [("A", "x", "f", 1.0, None)]
    df = spark.createDataFrame(rows, SERVING)
    df.write.parquet(f"{workdir}/s")
    for cities in (None, ["x", "y"], []):
        frames = reports.dashboard_frames(spark.read.parquet(f"{workdir}/s"), D, cities)
        scans = 0 if cities == [] else 1
        assert plan_of(frames).count("FileScan parquet") == scans and plan_of(frames).count("Exchange") == scans
        apart = reports.dashboard(df, D, cities)
        want = {("flights_per_airline", r["Airline"], r["Count"], None) for r in apart["flights_per_airline"].collect()}
        want |= {("avg_temp_by_city", r["city"], None, r["temp"]) for r in apart["avg_temp_by_city"].collect()}
        want |= {("flights_vs_temp", r["city"], r["flight_count"], r["avg_temp"]) for r in apart["flights_vs_temp"].collect()}
        got = [tuple(r) for r in frames.collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    schema = df.schema
    assert sorted(map(str, reports.default_dashboard(spark, f"{workdir}/s", schema).collect())) == sorted(
        map(str, reports.dashboard_frames(df, D).collect()))
    df.limit(0).write.parquet(f"{workdir}/none")
    assert reports.default_dashboard(spark, f"{workdir}/none", schema).collect() == []


def test_content_sums_find_one_changed_row(spark, workdir):
    rows = [(i % 7, None if i % 3 else f"v{i % 5}", i / 2) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    written = sinks.write_audited(df, f"{workdir}/w", ["a"])
    assert written[0] == 200
    read = lambda: spark.read.schema(df.schema).parquet(f"{workdir}/w").select(*df.columns)
    assert not sinks.content_differs(read(), *written) and not sinks.content_differs(read().repartition(5, "c"), *written)
    changes = [read().where("c <> 7.5"), read().union(read().where("c = 7.5")), read().withColumn("b", F.when(F.col("c") == 7.5, "no").otherwise(F.col("b"))),
               read().withColumn("c", F.when(F.col("c") == 7.5, F.lit(None)).otherwise(F.col("c"))), read().limit(0)]
    assert all(sinks.content_differs(c, *written) for c in changes)
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "p string, q string")
    assert len({r[0] for r in swapped.select(agg.row_hash(swapped)).collect()}) == 2  # a null has a place of its own
    assert sinks.write_audited(df.limit(0), f"{workdir}/none") == (0, 0)


def test_profiles_merge_over_days(spark):
    rng = random.Random(2)
    rows = [(D + dt.timedelta(days=rng.randrange(5)), rng.choice([None, *range(-5, 3000)]), rng.choice([None, "a", "b"]),
             rng.choice([None, 9.5, 10.25, -3.0]), None, [1], dt.datetime(2024, 1, 1, 2) + dt.timedelta(seconds=rng.randrange(9))) for _ in range(6_000)]
    df = spark.createDataFrame(rows, "day date, n long, s string, x double, e string, l array<int>, at timestamp_ntz")
    got = {r["name"]: r for r in agg.merged_profile(agg.profile(df, ["day"])).collect()}
    whole = {r["name"]: r for r in agg.merged_profile(agg.profile(df.drop("day"))).collect()}
    assert got == whole and [whole[c]["position"] for c in ("n", "s", "x", "e", "l", "at")] == list(range(6))
    for i, c in enumerate(df.columns[1:], 1):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[c]["n"] == 6_000 and got[c]["nulls"] == 6_000 - len(values)
        true = len({str(v) for v in values})
        assert abs(got[c]["distinct"] - true) <= max(1, 0.06 * true)
    numbers = [r[1] for r in rows if r[1] is not None]
    assert (got["n"]["low"], got["n"]["high"]) == (str(min(numbers)), str(max(numbers)))  # as numbers, not as text
    assert (got["x"]["low"], got["x"]["high"]) == ("-3.0", "10.25") and got["e"]["low"] is None and got["l"]["high"] is None
    assert got["at"]["low"] == "2024-01-01 02:00:00.000000" and got["n"]["type"] == "bigint"
    per_day = agg.merged_profile(agg.profile(df, ["day"]), ["day"])
    assert per_day.where("name = 'n'").agg(F.sum("n")).first()[0] == 6_000 and per_day.count() == 30
