"""Joins against brute force, alike on every physical path, and the plans they must give."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostat.operators import filters, joins
from aerostat.testdata import table
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def setting(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled(spark):
    return setting(spark, spark__sql__adaptive__autoBroadcastJoinThreshold="-1", spark__sql__autoBroadcastJoinThreshold="-1",
                   spark__sql__adaptive__coalescePartitions__enabled="false")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_keys_and_fanout(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 99)], "rk string, v int")
    want = sorted([(1, "a", "a", 10), (1, "a", "a", 11), (2, None, None, None), (3, "b", None, None)], key=str)
    assert rows(joins.left_join(left, right, "k", "rk")) == want
    assert rows(joins.left_join_split(left, right, "k", "rk", spread_by=["v"], rows_per_task=1)) == want


def test_small_files_are_broadcast(spark):
    e, c = table(spark, SF_SMALL, "events"), table(spark, SF_SMALL, "customer")
    assert "BroadcastHashJoin" in _plan(joins.left_join(e, c, "user_id", "c_custkey"))


def test_map_and_variant_columns_on_both_paths(spark):
    left = spark.createDataFrame([(1, 1, {"a": 1}), (2, None, {"b": 2}), (3, 9, None)], "id int, k int, m map<string,int>") \
        .withColumn("v", F.parse_json(F.lit('{"x": 1}')))
    right = spark.createDataFrame([(1, {"r": 1}), (1, {"r": 2}), (2, None)], "rk int, rm map<string,int>").withColumn(
        "n", F.monotonically_increasing_id())
    want = [(1, 1), (1, 2), (2, None), (3, None)]

    def seen(df):
        assert df.schema["m"].dataType == left.schema["m"].dataType and df.schema["v"].dataType == left.schema["v"].dataType
        got = df.select("id", F.col("rm")["r"].alias("r"), F.variant_get("v", "$.x", "int").alias("x")).collect()
        assert all(r.x == 1 for r in got)
        return sorted(((r.id, r.r) for r in got), key=str)

    assert seen(joins.left_join(left, right, "k", "rk")) == want
    with shuffled(spark):
        assert seen(joins.left_join(left, right, "k", "rk")) == want
        assert seen(joins.left_join_split(left, right, "k", "rk", spread_by=["n"], rows_per_task=1)) == want


def test_shared_column_names_on_both_paths(spark):
    left = spark.createDataFrame([(1, "l1"), (None, "l2")], "k int, name string")
    right = spark.createDataFrame([(1, "r1"), (1, "r2")], "k int, name string")
    want = sorted([(1, "l1", 1, "r1"), (1, "l1", 1, "r2"), (None, "l2", None, None)], key=str)
    for df in (joins.left_join(left, right, "k"), joins.left_join_split(left, right, "k", spread_by=["name"], rows_per_task=1)):
        assert df.columns == ["k", "name", "k", "name"] and rows(df) == want


@pytest.mark.parametrize("split", [False, True])
def test_one_column_select_prunes_the_scan(spark, split):
    e = table(spark, SF_SMALL, "events")
    c = table(spark, SF_SMALL, "customer")
    with shuffled(spark):
        if split:
            j = joins.left_join_split(e, c, "user_id", "c_custkey", spread_by=["c_custkey"], rows_per_task=1)
        else:
            j = joins.left_join(e, c, "user_id", "c_custkey")
        plan = j.select("user_id", "c_mktsegment")._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.split("\n") if "FileScan" in ln]
    assert scans
    for ln in scans:
        read = ln.partition("ReadSchema: struct<")[2].partition(">")[0]
        assert {f.split(":")[0] for f in read.split(",") if f} <= {"user_id", "c_custkey", "c_mktsegment"}


def test_filters_reach_both_reads(spark):
    e = table(spark, SF_SMALL, "events").select("event_id", "user_id", "ts")
    c = table(spark, SF_SMALL, "customer").select("c_custkey", "c_mktsegment")
    j = joins.left_join(e, c, "user_id", "c_custkey").where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    scans = [ln for ln in _plan(j).split("\n") if "FileScan" in ln and "ts:" in ln]
    assert len(scans) == 2 and all("GreaterThanOrEqual(ts," in ln for ln in scans)
    assert "IsNotNull(user_id)" in scans[0] + scans[1] and "IsNull(user_id)" in scans[0] + scans[1]


def test_null_keys_are_not_shuffled(spark):
    left = spark.range(0, 3000, numPartitions=6).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 40).alias("k"))
    right = spark.createDataFrame([(i, i * 10) for i in range(30)] + [(None, -1)], "rk long, v long")
    want = rows(left.join(right, left.k == right.rk, "left"))
    assert rows(joins.left_join(left, right, "k", "rk")) == want
    with shuffled(spark):
        got = joins.left_join(left, right, "k", "rk")
        assert rows(got) == want
        # each input task's null-key rows stay in a task of their own
        assert got.where("k IS NULL").select(F.spark_partition_id().alias("p")).distinct().count() == 6


def test_hot_right_keys_are_split(spark):
    # right: key 3 holds a third of the rows; left: keys 0..59, a null key, keys without right rows
    right = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(3)).when(F.col("id") % 97 == 0, F.lit(None))
        .otherwise(F.col("id") % 40).alias("rk"), F.col("id").alias("rv"))
    left = spark.range(0, 120, numPartitions=4).select(
        "id", F.when(F.col("id") == 7, F.lit(None)).otherwise(F.col("id") % 60).alias("k"))
    want = rows(left.join(right, left.k == right.rk, "left"))
    with shuffled(spark):
        got = joins.left_join_split(left, right, "k", "rk", spread_by=["rv"], rows_per_task=200)
        assert got.columns == ["id", "k", "rk", "rv"] and rows(got) == want
        assert got.where("rk = 3").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    r2 = right.select((F.col("rk") % 2).alias("a"), F.col("rk").alias("b"), "rv")
    l2 = left.select("id", (F.col("k") % 2).alias("la"), F.col("k").alias("lb"))
    assert rows(joins.left_join_split(l2, r2, ["la", "lb"], ["a", "b"], spread_by=["rv"], rows_per_task=200)) == rows(
        l2.join(r2, (l2.la == r2.a) & (l2.lb == r2.b), "left"))


keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=12, deadline=None)
@given(left=st.lists(keys, max_size=15), right=st.lists(keys, max_size=15), rows_per_task=st.integers(1, 4))
def test_every_left_row_stays_and_every_pair_meets_once(spark, left, right, rows_per_task):
    ldf = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "id int, k int")
    rdf = spark.createDataFrame([(100 + j, k) for j, k in enumerate(right)], "rid int, rk int")
    want = []
    for i, k in enumerate(left):
        m = [100 + j for j, rk in enumerate(right) if k is not None and rk == k]
        want += [(i, r) for r in m] or [(i, None)]
    for out in (joins.left_join(ldf, rdf, "k", "rk"),
                joins.left_join_split(ldf, rdf, "k", "rk", spread_by=["rid"], rows_per_task=rows_per_task)):
        assert sorted(((r.id, r.rid) for r in out.collect()), key=str) == sorted(want, key=str)


def test_semi_join_reduces_right_keys_first(spark):
    left = spark.range(0, 2000, numPartitions=4).select("id", (F.col("id") % 50).alias("k"))
    right = spark.range(0, 6000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 40).alias("rk"))
    assert rows(joins.semi_join(left, right, "k", "rk")) == rows(left.join(right, left.k == right.rk, "left_semi"))
    with shuffled(spark):
        plan = _plan(joins.semi_join(left, right, "k", "rk"))
    assert "LeftSemi" in plan and plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_semi_join_and_membership(spark):
    e = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, c string")
    assert e.where(filters.in_list("c", [])).count() == 0
    assert sorted(r.id for r in e.where(filters.in_list("c", ["x", "y"])).collect()) == [1, 2]
    m = spark.createDataFrame([("y",), (None,)], "c2 string")
    assert [r.id for r in joins.semi_join(e, m, "c", "c2").collect()] == [2]


def test_route_grid_zero_counts(spark):
    routes = joins.routes_from_lists(spark, ["BKK"], ["NRT", "HND", "ICN"])
    facts = spark.createDataFrame([("BKK", "NRT", 1), ("BKK", "NRT", 2), ("BKK", "ICN", 3), ("DMK", "NRT", 4)],
                                  "dep string, arr string, id int")
    got = {(r.dep, r.arr): r.n for r in joins.route_grid(routes, facts, ["dep", "arr"], "id").collect()}
    assert got == {("BKK", "NRT"): 2, ("BKK", "HND"): 0, ("BKK", "ICN"): 1}
