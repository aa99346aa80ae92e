"""Plans of the daily job and of day selections: what is scanned, and how often."""

from __future__ import annotations

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from aerostat.operators import sinks
from aerostat.plans import daily
from aerostat.sources.tables import absent_days, landed_days, rows_on_days, scan_day_folders, scan_parquet
from tests.conftest import flight, weather, write_feed

DAY = "2025-04-02"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _land(workdir, days=(DAY,)):
    for day in days:
        write_feed(workdir, "flight", day, [
            flight("NH1", "BKK", "NRT", f"{day}T08:00:00", "ANA \"{[\\"), flight("XX1", "BKK", None, None, None),
            flight("SQ1", "BKK", "SIN", f"{day}T23:30:00-09:00", "SQ }")] * 40)
        write_feed(workdir, "weather", day, [weather("Tokyo", temp=18.5), weather("Singapore", temp="30.5")])


def test_flights_are_scanned_once(spark, workdir):
    _land(workdir)
    plan = plan_of(daily.transform(spark, workdir, [DAY]))
    assert plan.count("FileScan json") == 2 and plan.count("/flight/") == 1


@pytest.mark.parametrize("split", [False, True])
def test_split_arrays_give_the_same_rows(spark, workdir, split):
    _land(workdir, (DAY, "2025-04-03"))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "3000" if split else before)
    try:
        n = daily.run(spark, workdir, f"{workdir}/clean", [DAY, "2025-04-03"], split_arrays=split)
        rows = spark.read.parquet(f"{workdir}/clean").groupBy("ingest_date", "flight_iata", "airline", "temp").count().collect()
    finally:
        spark.conf.set(key, before)
    days = (dt.date(2025, 4, 2), dt.date(2025, 4, 3))
    assert n == 240 and sorted(map(str, map(tuple, rows))) == sorted(map(str, [
        x for d in days for x in ((d, "NH1", "ANA \"{[\\", 18.5, 40), (d, "SQ1", "SQ }", 30.5, 40), (d, "XX1", None, None, 40))]))


def test_landed_arrays(spark, workdir):
    rows = [(i, f"d{i % 3}", "q\"}" * (i % 4), None if i % 5 else i) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, day string, t string, n int")
    sinks.land_arrays(df, f"{workdir}/a", "day", ["id"])
    files = glob.glob(f"{workdir}/a/day=*/part-*.txt")
    assert len(files) == 3
    got = [r for f in files for r in json.load(open(f))]
    assert sorted(r["id"] for r in got) == list(range(50)) and all(("n" in r) == (r["id"] % 5 == 0) for r in got)
    assert all([r["id"] for r in json.load(open(f))] == sorted(r["id"] for r in json.load(open(f))) for f in files)


def test_chosen_days_prune_the_scan(spark, workdir):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    df = spark.createDataFrame([(i, days[i % 6]) for i in range(60)] + [(99, None)], "id int, ingest_date date")
    sinks.write_partitioned(df, f"{workdir}/p")
    spark.createDataFrame([(d, i) for i, d in enumerate(days)] * 3, "d date, load int").write.parquet(f"{workdir}/load")
    chosen = spark.read.parquet(f"{workdir}/load").groupBy("d").agg(F.sum("load").alias("n")).where("n > 9").select("d")
    got = rows_on_days(scan_parquet(spark, f"{workdir}/p", schema=df.schema), chosen)
    assert "dynamicpruning" in plan_of(got)
    for day in days[:4]:  # other folders are never opened
        for part in glob.glob(f"{workdir}/p/ingest_date={day}/part-*"):
            open(part, "wb").write(b"no parquet")
    assert sorted(r.id for r in got.collect()) == [i for i in range(60) if i % 6 >= 4]
    assert rows_on_days(scan_parquet(spark, f"{workdir}/p", schema=df.schema), chosen.where("d IS NULL")).collect() == []


def test_day_folders_in_one_job(spark, workdir):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    df = spark.createDataFrame([(i, days[i % 2]) for i in range(10)], "id int, ingest_date date")
    assert sinks.write_day_folders(df, f"{workdir}/d") == ["2024-01-01", "2024-01-02"]
    again = df.where("id < 3 AND id % 2 = 0").select((F.col("id") + 100).alias("id"), "ingest_date")
    assert sinks.write_day_folders(again, f"{workdir}/d") == ["2024-01-01"]
    got = scan_day_folders(spark, f"{workdir}/d", days).select("id", "ingest_date").collect()
    assert sorted(map(tuple, got)) == [(1, days[1]), (3, days[1]), (5, days[1]), (7, days[1]), (9, days[1]), (100, days[0]), (102, days[0])]
    with pytest.raises(ValueError, match="without a day"):
        sinks.write_day_folders(df.union(spark.createDataFrame([(1, None)], df.schema)), f"{workdir}/d")
    assert scan_day_folders(spark, f"{workdir}/d", days).count() == 7


def test_absent_days(spark, workdir):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 4)), (3, None)], "id int, ingest_date date")
    sinks.write_partitioned(df, f"{workdir}/p", days=[dt.date(2024, 1, 3)])  # written without rows
    wanted = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS d UNION ALL SELECT DATE '2024-01-05'")
    found = landed_days(spark, f"{workdir}/p")
    assert [r.day for r in found.collect()] == [dt.date(2024, 1, d) for d in (2, 3, 4)]
    assert sorted(r.day for r in absent_days(wanted, found).collect()) == [dt.date(2024, 1, 1), dt.date(2024, 1, 5)]
    assert absent_days(wanted, landed_days(spark, f"{workdir}/none")).count() == 5
