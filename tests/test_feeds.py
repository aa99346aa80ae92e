"""Golden mini-feeds: every edge row of FIXTURES.md §2 (cases 1-10, 15)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerostat import schemas
from aerostat.plans import daily
from aerostat.sources.feeds import day_path, read_flights, read_weather
from aerostat.sources.tables import scan_parquet
from tests.conftest import flight, weather, write_feed

DAY = "2025-04-02"


def _rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=str)


def test_flight_flatten_and_null_object(spark, workdir):
    write_feed(workdir, "flight", DAY, [
        flight("TG640", "BKK", "NRT", "2025-04-02T08:00:00+00:00", "Thai Airways"),
        flight(None, "BKK", "ICN", "2025-04-02T09:00:00+00:00", "Korean Air"),  # case 5
    ])
    df = read_flights(spark, day_path(workdir, "flight", DAY))
    assert df.columns == list(schemas.FLIGHT_FIELDS)
    got = _rows(df, "flight_iata", "arrival_iata", "airline")
    assert got == sorted([("TG640", "NRT", "Thai Airways"), (None, "ICN", "Korean Air")], key=str)


def test_empty_array_gives_zero_rows(spark, workdir):  # case 6
    write_feed(workdir, "flight", DAY, [])
    write_feed(workdir, "weather", DAY, [])
    assert read_flights(spark, day_path(workdir, "flight", DAY)).count() == 0
    assert read_weather(spark, day_path(workdir, "weather", DAY)).count() == 0


def test_truncated_file_fails(spark, workdir):  # case 7
    write_feed(workdir, "flight", DAY, '[{"flight": {"iata": "TG1"}, "arrival": {"iata": "NR')
    with pytest.raises(Exception):
        read_flights(spark, day_path(workdir, "flight", DAY)).collect()


def test_missing_file_fails(spark, workdir):  # S4
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_flights(spark, day_path(workdir, "flight", "1999-01-01")).collect()


def test_lenient_floats(spark, workdir):  # case 8
    temps = [21, 21.5, "21.5", " 21.5 ", True, "x", None, "MISSING"]
    recs = []
    for i, t in enumerate(temps):
        w = weather(f"C{i}")
        if t == "MISSING":
            del w["data"]["main"]["temp"]
        else:
            w["data"]["main"]["temp"] = t
        recs.append(w)
    write_feed(workdir, "weather", DAY, recs)
    df = read_weather(spark, day_path(workdir, "weather", DAY))
    got = dict((r.city, r.temp) for r in df.collect())
    want = [21.0, 21.5, 21.5, 21.5, 1.0, None, None, None]
    assert [got[f"C{i}"] for i in range(len(temps))] == want
    assert dict(df.dtypes)["temp"] == "float"


def test_condition_first_element(spark, workdir):  # case 9 + Q1
    recs = [weather("A", cond="Rain"), weather("B"), weather("C", cond=None), weather("D", cond=" "),
            weather("E"), weather("F", cond="Snow")]
    recs[1]["data"]["weather"] = []
    recs[4]["data"]["weather"] = [{"main": 7}]
    recs[5]["data"]["weather"].append({"main": "Mist"})
    write_feed(workdir, "weather", DAY, recs)
    p = day_path(workdir, "weather", DAY)
    got = dict((r.city, r.weather) for r in read_weather(spark, p).collect())
    assert got == {"A": "Rain", "B": "Unknown", "C": "Unknown", "D": "Unknown", "E": "Unknown", "F": "Snow"}
    ref = read_weather(spark, p, condition_mode="reference").select("weather").distinct().collect()
    assert [r.weather for r in ref] == ["Unknown"]


def test_city_lookup(spark, workdir):  # J2
    write_feed(workdir, "weather", DAY, [weather("Tokyo"), weather("Atlantis")])
    got = dict((r.city, r.iata) for r in read_weather(spark, day_path(workdir, "weather", DAY)).collect())
    assert got == {"Tokyo": "NRT", "Atlantis": None}


def _land_day(root, day=DAY):
    write_feed(root, "flight", day, [
        flight("TG640", "BKK", "NRT", f"{day}T08:00:00+00:00", "Thai Airways"),       # case 1
        flight("NH800", "BKK", "HND", f"{day}T09:00:00+09:00", "ANA"),                # case 2
        flight("XX001", "BKK", None, f"{day}T10:00:00+00:00", "Mystery Air"),         # case 3
        flight("SQ711", "BKK", "SIN", f"{day}T23:30:00-09:00", "Singapore Airlines"), # case 4 + 10
    ])
    write_feed(root, "weather", day, [
        weather("Tokyo", temp=18.5), weather("Singapore", temp=31), weather("Singapore", temp="30.5"),
        weather("Atlantis", temp=1),                                                  # case 3: null iata
    ])


def test_clean_join_edges(spark, workdir):
    _land_day(workdir)
    clean = daily.transform(spark, workdir, [DAY])
    assert clean.columns == [f.name for f in schemas.CLEAN.fields] + ["ingest_date"]
    rows = clean.collect()
    by = {}
    for r in rows:
        by.setdefault(r.flight_iata, []).append(r)
    assert len(rows) == 5
    assert by["TG640"][0].city == "Tokyo" and by["TG640"][0].temp == pytest.approx(18.5)
    assert by["NH800"][0].city is None and by["NH800"][0].temp is None
    assert by["XX001"][0].iata is None
    assert sorted(r.temp for r in by["SQ711"]) == [30.5, 31.0]
    assert {r.ingest_date for r in rows} == {dt.date(2025, 4, 2)}


def test_transform_plan_broadcasts_weather(spark, workdir):
    _land_day(workdir)
    plan = daily.transform(spark, workdir, [DAY])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_multi_day_join_never_mixes_days(spark, workdir):
    _land_day(workdir, "2025-04-01")
    _land_day(workdir, "2025-04-02")
    clean = daily.transform(spark, workdir, ["2025-04-01", "2025-04-02"])
    per_day = {(r.ingest_date, r.n) for r in clean.groupBy("ingest_date").agg(F.count("*").alias("n")).collect()}
    assert per_day == {(dt.date(2025, 4, 1), 5), (dt.date(2025, 4, 2), 5)}


def test_part_glob_reads_subset(spark, workdir):  # case 15 / S6 / Q10
    out = f"{workdir}/ds"
    spark.range(20).repartition(3).write.parquet(out)
    assert scan_parquet(spark, out).count() == 20
    sub = scan_parquet(spark, out, part_glob="part-00000*.parquet").count()
    assert 0 < sub < 20


def test_run_writes_partition_and_counts(spark, workdir):
    _land_day(workdir)
    n = daily.run(spark, workdir, f"{workdir}/clean", [DAY])
    assert n == 5
    back = spark.read.parquet(f"{workdir}/clean")
    assert back.count() == 5 and "ingest_date" in back.columns


def test_day_partitioned_jsonlines_landing(spark, workdir):
    """Many days landed as JSON lines in one write each, transformed in one job."""
    import json as _json

    from aerostat.operators.sinks import land_json
    fl_rows, wx_rows = [], []
    for day in ("2025-04-01", "2025-04-02"):
        for i in range(3):
            fl_rows.append((_json.dumps(flight(f"F{day[-1]}{i}", "BKK", "NRT", f"{day}T0{i}:00:00", "ANA")), day))
        wx_rows.append((_json.dumps(weather("Tokyo", temp=int(day[-1]))), day))
    flights_df = spark.createDataFrame(fl_rows, "j string, ingest_date string").select(
        F.from_json("j", schemas.FLIGHT_RAW).alias("r"), "ingest_date").select("r.*", "ingest_date")
    weather_df = spark.createDataFrame(wx_rows, "j string, ingest_date string").select(
        F.from_json("j", "city string, query string, data string").alias("r"), "ingest_date") \
        .select("r.city", "r.query", F.parse_json("r.data").alias("data"), "ingest_date")
    land_json(flights_df, f"{workdir}/flight", "ingest_date")
    land_json(weather_df, f"{workdir}/weather", "ingest_date")
    clean = daily.transform(spark, workdir, ["2025-04-01", "2025-04-02"], multiline=False)
    got = sorted((r.flight_iata, r.ingest_date, r.temp) for r in clean.collect())
    assert len(got) == 6
    assert {(d, t) for _, d, t in got} == {(dt.date(2025, 4, 1), 1.0), (dt.date(2025, 4, 2), 2.0)}
