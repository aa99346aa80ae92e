"""Judged loads, one-step table replacement, bucketed joins, missing days and shredded bodies."""

from __future__ import annotations

import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.operators import buckets, joins, sinks
from aerostat.sources import envelopes
from aerostat.sources.feeds import read_landed_weather
from tests.test_daily_plan import plan_of

TARGET = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("at", T.TimestampNTZType()), T.StructField("x", T.FloatType())])


def test_good_and_bad_rows_add_up(spark, workdir):
    rows = [("1", "2025-04-02T23:30:00-09:00", "1.5"), ("2", None, None), ("3", "  ", " 7 "), ("x4", "2025-04-02", "1"), (None, "2025-04-02", "1"),
            ("6", "yesterday", "n/a"), ("", "", ""), ("9" * 30, "2025-02-30", "1e3")]
    df = spark.createDataFrame(rows, "id string, `the time` string, value string")
    counts = sinks.load_judged(df, TARGET, f"{workdir}/l")
    assert counts == {"accepted": 3, "rejected": 5}
    good = sinks.accepted_rows(spark, f"{workdir}/l", TARGET)
    assert [f.name for f in good.schema.fields] == ["k", "at", "x"]
    assert sorted(map(tuple, good.collect())) == [(1, dt.datetime(2025, 4, 2, 23, 30), 1.5), (2, None, None), (3, None, 7.0)]
    bad = {json.loads(r["source_row"]).get("id"): list(r["reasons"]) for r in sinks.rejected_rows(spark, f"{workdir}/l", TARGET).collect()}
    assert bad == {"x4": ["k: bad value"], None: ["k: missing"], "6": ["at: bad value", "x: bad value"], "": ["k: bad value", "x: bad value"],
                   "9" * 30: ["k: bad value", "at: bad value"]}
    assert "outcome=accepted" in str(good.inputFiles()) or "PartitionFilters: [isnotnull(outcome" in plan_of(good)
    with pytest.raises(ValueError):
        sinks.judged_rows(df.drop("id"), TARGET)
    assert sinks.load_judged(df.limit(0), TARGET, f"{workdir}/none") == {"accepted": 0, "rejected": 0}


def test_accepted_rows_are_those_of_the_strict_insert(spark, workdir):
    df = spark.createDataFrame([(str(i), f"2025-04-{1 + i % 28:02d}T01:02:03", str(i / 3)) for i in range(50)], "a string, b string, c string")
    assert sinks.load_judged(df, TARGET, f"{workdir}/l")["rejected"] == 0
    strict = sinks.store_assign(df, TARGET)
    assert sorted(map(tuple, sinks.accepted_rows(spark, f"{workdir}/l", TARGET).collect())) == sorted(map(tuple, strict.collect()))


def test_a_table_is_replaced_in_one_step(spark, workdir):
    name = f"one_{uuid.uuid4().hex[:8]}"
    said = []
    first = sinks.create_or_replace_table(spark.range(3), name, f"{workdir}/t")
    run = spark.sql
    try:
        spark.sql = lambda q, *a, **k: said.append(q.split()[0]) or run(q, *a, **k)
        second = sinks.create_or_replace_table(spark.range(5), name, f"{workdir}/t")
    finally:
        del spark.sql
    assert said == ["ALTER"] and first != second and spark.table(name).count() == 5
    spark.range(2).write.insertInto(name)
    assert spark.table(name).count() == 7
    sinks.create_or_replace_table(spark.range(4).withColumn("b", F.lit("x")), name, f"{workdir}/t")  # other columns
    assert spark.table(name).columns == ["id", "b"] and spark.table(name).count() == 4
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("rows_per_part", [3, 1_000])
def test_bucketed_join_equals_the_plain_one_and_moves_nothing(spark, workdir, rows_per_part):
    rng = random.Random(5)
    facts = spark.createDataFrame([(i, rng.choice([None, 1, 1, 1, 2, 3, 4, 50])) for i in range(400)], "id long, k long")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None), (9, "z"), (None, "n")], "dk int, v string")  # another type
    f, d = (f"{x}_{uuid.uuid4().hex[:8]}" for x in ("f", "d"))
    buckets.create_bucketed_tables(facts, dim, f, d, f"{workdir}/f", f"{workdir}/d", "k", "dk", ["id"], 6, rows_per_part)
    got = buckets.bucketed_left_join(spark, f, d, "k", "dk")
    assert "Exchange" not in plan_of(got) and "SortMergeJoin" in plan_of(got)
    want = joins.left_join(facts, dim, "k", "dk").collect()
    assert got.columns == ["id", "k", "dk", "v"] and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want)))
    sizes = spark.table(f).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes < (200 if rows_per_part == 3 else 401)  # the hot key is spread
    for name in (f, d):
        spark.sql(f"DROP TABLE {name}")


def test_missing_days(spark):
    day = lambda k: dt.date(2024, 1, k)
    routes = spark.createDataFrame([("B", "X"), ("B", "Y"), ("B", "Z"), ("B", "X")], "dep string, arr string")
    seen = spark.createDataFrame([("B", "X", day(2)), ("B", "X", day(2)), ("B", "X", day(5)), ("B", "X", day(20)), ("B", "Z", day(1)), ("B", "Z", day(6)),
                                  ("B", "Z", None), ("C", "X", day(3)), ("B", "Y", day(9))], "dep string, arr string, day date")
    got = envelopes.missing_days(routes, seen, F.lit(day(1)), F.lit(day(6))).collect()
    assert sorted(map(tuple, got)) == [("B", "X", day(1), day(1), 1), ("B", "X", day(3), day(4), 2), ("B", "X", day(6), day(6), 1),
                                       ("B", "Y", day(1), day(6), 6), ("B", "Z", day(2), day(5), 4)]


def test_shredded_bodies_are_read_by_path(spark, workdir):
    bodies = [('{"main": {"temp": 3.5, "humidity": "60"}, "wind": {"speed": 2}, "weather": [{"main": "Rain"}], "big": "%s"}' % ("x" * 500), 200),
              ('{"main": {"temp": "n/a"}, "weather": []}', 200), ("cut {", 200), ('{"main": {"temp": true}}', 200), ("{}", 404)] * 20
    env = spark.createDataFrame([("Tokyo", f"q{i}", s, b) for i, (b, s) in enumerate(bodies)], "city string, query string, status int, body string")
    envelopes.land_wrappers(env, f"{workdir}/w")
    got = read_landed_weather(spark, f"{workdir}/w", keep=["query"])
    plan = plan_of(got)
    read = plan[plan.index("ReadSchema"):]
    assert "data:variant" not in read and "data:struct<0:float" in read  # the paths, not the bodies
    rows = {r["query"]: (r["temp"], r["humidity"], r["weather"], r["wind_speed"]) for r in got.collect()}
    assert len(rows) == 60 and rows["q0"] == (3.5, 60.0, "Rain", 2.0) and rows["q1"] == (None, None, "Unknown", None) and rows["q3"][0] == 1.0
