"""Writers: partition overwrite, closed-form backfill vs replay, typed insert."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.operators import sinks

BASE = dt.date(2024, 1, 1)


def test_dynamic_overwrite_keeps_other_partitions(spark, workdir):
    root = f"{workdir}/p"
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None)], "id int, ingest_date date")
    sinks.write_partitioned(df, root)
    sinks.write_partitioned(spark.createDataFrame([(9, dt.date(2024, 1, 2))], "id int, ingest_date date"), root)
    got = sorted((r.id, r.ingest_date) for r in spark.read.parquet(root).collect())
    assert got == sorted([(1, dt.date(2024, 1, 1)), (9, dt.date(2024, 1, 2)), (3, None)], key=str)


def _replay(existing, batches, start, end):
    """Sequential reference semantics: for each day, delete date=day, append batch."""
    table = list(existing)
    d = start
    while d <= end:
        table = [r for r in table if r[1] != d]
        table += [(i, a) for (i, f, a) in batches if f == d]
        d += dt.timedelta(days=1)
    return sorted(table, key=str)


days = st.one_of(st.none(), st.integers(0, 12).map(lambda k: BASE + dt.timedelta(days=k)))


@settings(max_examples=15, deadline=None)
@given(
    existing=st.lists(days, max_size=12),
    batch=st.lists(st.tuples(st.integers(2, 9).map(lambda k: BASE + dt.timedelta(days=k)), days), max_size=25),
)
def test_backfill_closed_form_equals_replay(spark, existing, batch):
    start, end = BASE + dt.timedelta(days=2), BASE + dt.timedelta(days=9)
    ex = [(i, a) for i, a in enumerate(existing)]
    bt = [(1000 + i, f, a) for i, (f, a) in enumerate(batch)]
    ex_df = spark.createDataFrame(ex, "id int, date date")
    bt_df = spark.createDataFrame(bt, "id int, file_day date, date date")
    got = sorted(((r.id, r.date) for r in sinks.backfill_rows(ex_df, bt_df, "file_day", "date", start, end).collect()), key=str)
    assert got == _replay(ex, bt, start, end)


def test_replace_rows_matches_single_step(spark):
    d = dt.date(2024, 1, 3)
    ex = [(1, d), (2, None), (3, dt.date(2024, 1, 4))]
    bt = [(10, d), (11, dt.date(2024, 1, 4))]
    out = sinks.replace_rows(spark.createDataFrame(ex, "id int, date date"), spark.createDataFrame(bt, "id int, date date"), "date", d)
    assert sorted(r.id for r in out.collect()) == [2, 3, 10, 11]


def test_typed_insert_and_ctas(spark, workdir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    target = T.StructType([T.StructField("k", T.LongType()), T.StructField("arrival_time", T.TimestampNTZType())])
    sinks.create_table_if_absent(spark, name, target, f"{workdir}/{name}")
    sinks.create_table_if_absent(spark, name, target, f"{workdir}/{name}")  # no-op second time
    src = spark.createDataFrame([(1, "2025-04-02T23:30:00-09:00"), (2, None)], "id int, t string")
    sinks.insert_typed(spark, src, name)
    got = sorted((r.k, r.arrival_time) for r in spark.table(name).collect())
    assert got == sorted([(1, dt.datetime(2025, 4, 2, 23, 30)), (2, None)], key=str)
    ctas = f"c_{uuid.uuid4().hex[:8]}"
    sinks.create_or_replace_table(spark.range(3), ctas, f"{workdir}/{ctas}")
    sinks.create_or_replace_table(spark.range(5), ctas, f"{workdir}/{ctas}")
    assert spark.table(ctas).count() == 5


def test_publish_version_swaps(spark, workdir):
    name = f"v_{uuid.uuid4().hex[:8]}"
    l1 = sinks.publish_version(spark, spark.range(3), name, f"{workdir}/v")
    assert spark.table(name).count() == 3
    l2 = sinks.publish_version(spark, spark.table(name).where(F.col("id") > 0), name, f"{workdir}/v")
    assert l1 != l2 and spark.table(name).count() == 2


def test_partition_backfill_equals_replay(spark, workdir):
    import random
    rnd = random.Random(7)

    def day(k):
        return None if k is None else BASE + dt.timedelta(days=k)

    ex = [(i, day(rnd.choice([None, *range(0, 13)]))) for i in range(40)]
    bt = [(1000 + i, day(rnd.randint(2, 9)), day(rnd.choice([None, *range(0, 13)]))) for i in range(60)]
    start, end = BASE + dt.timedelta(days=2), BASE + dt.timedelta(days=9)
    name = f"bf_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (id int, date date) USING parquet PARTITIONED BY (date) LOCATION '{workdir}/{name}'")
    spark.createDataFrame(ex, "id int, date date").write.insertInto(name)
    sinks.backfill_date_partitions(spark, name, spark.createDataFrame(bt, "id int, file_day date, date date"),
                                   "file_day", "date", start, end)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stage_")]
    got = sorted(((r.id, r.date) for r in spark.table(name).collect()), key=str)
    assert got == _replay(ex, bt, start, end)


def test_backfill_jobs_do_not_grow_with_the_window(spark, workdir):
    sc = spark.sparkContext

    def jobs(n):
        name = f"bf_{uuid.uuid4().hex[:8]}"
        spark.sql(f"CREATE TABLE {name} (id int, date date) USING parquet PARTITIONED BY (date) LOCATION '{workdir}/{name}'")
        days = [BASE + dt.timedelta(days=i) for i in range(n)]
        batches = spark.createDataFrame([(i, d, d) for i, d in enumerate(days)], "id int, file_day date, date date")
        sc.setJobGroup(name, "backfill")
        try:
            sinks.backfill_date_partitions(spark, name, batches, "file_day", "date", days[0], days[-1])
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert spark.table(name).count() == n
        return len(sc.statusTracker().getJobIdsForGroup(name))

    assert jobs(2) == jobs(9)


def test_backfill_empties_a_day_without_survivors(spark, workdir):
    name = f"bf_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (id int, date date) USING parquet PARTITIONED BY (date) LOCATION '{workdir}/{name}'")
    old = [(1, BASE), (2, BASE + dt.timedelta(days=1)), (3, BASE + dt.timedelta(days=5)), (4, None)]
    spark.createDataFrame(old, "id int, date date").write.insertInto(name)
    batches = spark.createDataFrame([(10, BASE, BASE)], "id int, file_day date, date date")
    sinks.backfill_date_partitions(spark, name, batches, "file_day", "date", BASE, BASE + dt.timedelta(days=1))
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 4, 10]


def test_empty_rerun_clears_the_day(spark, workdir):
    root = f"{workdir}/p"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = spark.createDataFrame([(1, d1), (2, d2), (3, None)], "id int, ingest_date date")
    assert sinks.write_partitioned(df, root, days=[d1, d2]) == 3
    assert sinks.write_partitioned(df.where("id = 2"), root, days=[d1, d2]) == 1
    assert sorted(r.id for r in spark.read.schema(df.schema).parquet(root).collect()) == [2, 3]
    assert sinks.write_partitioned(df.where("id > 5"), root, days=[d2]) == 0
    assert [r.id for r in spark.read.schema(df.schema).parquet(root).collect()] == [3]


def test_partitioned_versions_read_back_exactly(spark, workdir):
    name = f"v_{uuid.uuid4().hex[:8]}"
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    two = spark.createDataFrame([(10, "a"), (30, "c")], "id int, p string")
    sinks.publish_version(spark, one, name, f"{workdir}/v", ["p"])
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b")]
    sinks.publish_version(spark, two, name, f"{workdir}/v", ["p"])
    assert sorted(map(tuple, spark.table(name).collect())) == [(10, "a"), (30, "c")]
    sinks.publish_version(spark, two.limit(0), name, f"{workdir}/v", ["p"])
    assert spark.table(name).count() == 0
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]) == 1  # old versions leave the catalog


def test_a_table_is_not_replaced_by_a_version(spark, workdir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    sinks.create_or_replace_table(spark.range(3), name, f"{workdir}/t")
    with pytest.raises(ValueError, match="table of its own"):
        sinks.publish_version(spark, spark.range(5), name, f"{workdir}/v")
    assert spark.table(name).count() == 3


def test_failed_replace_keeps_the_old_table(spark, workdir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    sinks.create_or_replace_table(spark.range(3), name, f"{workdir}/t")
    bad = spark.range(4).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.create_or_replace_table(bad, name, f"{workdir}/t")
    assert spark.table(name).count() == 3
