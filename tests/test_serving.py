"""Serving load, replace-by-date, backfill and dashboard frames (cases 11-14, 16)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest

from aerostat import schemas
from aerostat.plans import daily, reports, serving
from tests.conftest import flight, weather, write_feed


def _land(root, day, flights, weathers=None):
    write_feed(root, "flight", day, flights)
    write_feed(root, "weather", day, weathers if weathers is not None else [weather("Tokyo", temp=20)])


def _table():
    return f"fw_{uuid.uuid4().hex[:10]}"


def test_serving_contract_and_wall_clock_date(spark, workdir):
    _land(workdir, "2025-04-02", [
        flight("A1", "BKK", "NRT", "2025-04-02T23:30:00-09:00", "X"),
        flight("A2", "BKK", "NRT", "2025-04-02T23:30:00+00:00", "X"),
        flight("A3", "BKK", "NRT", None, "X"),                           # case 12
    ])
    daily.run(spark, workdir, f"{workdir}/clean", ["2025-04-02"])
    rows = serving.serving_rows(serving.read_clean(spark, f"{workdir}/clean")).drop("ingest_date")
    schemas.check_contract(rows, schemas.SERVING)
    got = {r.flight_iata: r.date for r in rows.collect()}
    assert got == {"A1": dt.date(2025, 4, 2), "A2": dt.date(2025, 4, 2), "A3": None}


def test_load_is_idempotent_by_ingest_date(spark, workdir):  # case 11 kept
    _land(workdir, "2025-04-01", [flight("N1", "BKK", "NRT", "2025-04-02T01:00:00+00:00", "X")])
    _land(workdir, "2025-04-02", [flight("D2", "BKK", "NRT", "2025-04-02T09:00:00+00:00", "X")])
    clean, srv = f"{workdir}/clean", f"{workdir}/serving"
    daily.run(spark, workdir, clean, ["2025-04-01", "2025-04-02"])
    assert serving.load(spark, clean, srv, ["2025-04-01"]) == 1
    assert serving.load(spark, clean, srv, ["2025-04-02"]) == 1
    serving.load(spark, clean, srv, ["2025-04-02"])  # rerun: no change
    got = sorted(r.flight_iata for r in spark.read.parquet(srv).collect())
    assert got == ["D2", "N1"]


@pytest.mark.parametrize("mode", ["partition", "version"])
def test_replay_form_loses_overnight_arrival(spark, workdir, mode):  # case 11 lost, Q2
    _land(workdir, "2025-04-01", [flight("N1", "BKK", "NRT", "2025-04-02T01:00:00+00:00", "X")])
    _land(workdir, "2025-04-02", [flight("D2", "BKK", "NRT", "2025-04-02T09:00:00+00:00", "X")])
    clean = f"{workdir}/clean"
    daily.run(spark, workdir, clean, ["2025-04-01", "2025-04-02"])
    t, root = _table(), f"{workdir}/tbl"
    serving.replace_day(spark, t, root, clean, "2025-04-01", mode=mode)
    serving.replace_day(spark, t, root, clean, "2025-04-02", mode=mode)
    step = sorted(r.flight_iata for r in spark.table(t).collect())
    assert step == ["D2"]
    t2 = _table()
    serving.backfill(spark, t2, f"{workdir}/tbl2", clean, "2025-04-01", "2025-04-02", mode=mode)
    assert sorted(r.flight_iata for r in spark.table(t2).collect()) == step


@pytest.mark.parametrize("mode", ["partition", "version"])
def test_rerun_duplicates_rows_dated_other_day(spark, workdir, mode):  # Q2
    _land(workdir, "2025-04-01", [flight("N1", "BKK", "NRT", "2025-04-02T01:00:00+00:00", "X")])
    clean = f"{workdir}/clean"
    daily.run(spark, workdir, clean, ["2025-04-01"])
    t, root = _table(), f"{workdir}/tbl"
    serving.replace_day(spark, t, root, clean, "2025-04-01", mode=mode)
    serving.replace_day(spark, t, root, clean, "2025-04-01", mode=mode)
    assert spark.table(t).count() == 2


@pytest.mark.parametrize("mode", ["partition", "version"])
def test_null_date_never_deleted_and_not_an_option(spark, workdir, mode):  # case 12, Q6
    _land(workdir, "2025-04-02", [flight("Z", "BKK", "NRT", None, "X"),
                                  flight("Y", "BKK", "NRT", "2025-04-02T05:00:00", "X")])
    clean = f"{workdir}/clean"
    daily.run(spark, workdir, clean, ["2025-04-02"])
    t, root = _table(), f"{workdir}/tbl"
    serving.replace_day(spark, t, root, clean, "2025-04-02", mode=mode)
    serving.replace_day(spark, t, root, clean, "2025-04-02", mode=mode)
    got = sorted(r.flight_iata for r in spark.table(t).collect())
    assert got == ["Y", "Z", "Z"]
    opts = reports.options(spark.table(t))
    assert [r.date for r in opts["dates"].collect()] == [dt.date(2025, 4, 2)]


def test_report_null_group_conventions(spark, workdir):  # cases 13, 14, Q5
    _land(workdir, "2025-04-02", [
        flight("F1", "BKK", "NRT", "2025-04-02T05:00:00", None),
        flight("F2", "BKK", "NRT", "2025-04-02T06:00:00", "ANA"),
        flight("F3", "BKK", "ICN", "2025-04-02T07:00:00", "ANA"),
    ], [weather("Tokyo", temp=20), weather("Seoul", temp=None)])
    clean = f"{workdir}/clean"
    daily.run(spark, workdir, clean, ["2025-04-02"])
    c = serving.read_clean(spark, clean)
    by_airline = {r.airline: r.total_flights for r in reports.adhoc(c)["by_airline"].collect()}
    assert by_airline == {None: 1, "ANA": 2}
    srv = serving.serving_rows(c)
    frames = reports.dashboard(srv)
    vc = {r.Airline: r.Count for r in frames["flights_per_airline"].collect()}
    assert vc == {"ANA": 2}
    means = {r.city: r.temp for r in frames["avg_temp_by_city"].collect()}
    assert means == {"Seoul": None, "Tokyo": 20.0}
    fvt = {r.city: (r.flight_count, r.avg_temp) for r in frames["flights_vs_temp"].collect()}
    assert fvt == {"Seoul": (1, None), "Tokyo": (2, 20.0)}
    sel = reports.dashboard(srv, "2025-04-02", [])
    assert sel["flights_per_airline"].count() == 0


def test_envelopes_three_reasons(spark):  # case 16, S9, D3
    from pyspark.sql import types as T
    from aerostat.sources import envelopes as ev
    rec = T.StructType([T.StructField("id", T.LongType())])
    env = spark.createDataFrame([
        ("BKK", "NRT", 200, '{"data": [{"id": 1}, {"id": 2}]}'),
        ("BKK", "HND", 200, '{"data": []}'),
        ("BKK", "ICN", 500, '{"error": "boom"}'),
        ("BKK", "SIN", 200, '{"pagination": {}}'),
        ("BKK", "KUL", None, None),
    ], schemas.ENVELOPE)
    acc = ev.accepted_records(env, rec)
    assert sorted((r.arr, r.id) for r in acc.collect()) == [("NRT", 1), ("NRT", 2)]
    rej = {r.arr: r.reason for r in ev.rejected(env).collect()}
    assert rej == {"ICN": ev.HTTP_ERROR, "SIN": ev.NO_DATA, "KUL": ev.REQUEST_FAILED}
    status = {r.arr: (r.records, r.outcome) for r in ev.per_route_status(env).collect()}
    assert status["NRT"] == (2, "ok") and status["HND"] == (0, "ok") and status["KUL"] == (0, ev.REQUEST_FAILED)
    # each body is parsed once per row, though reason and count both read it
    for df in (ev.per_route_status(env), acc):
        assert df._jdf.queryExecution().executedPlan().toString().count("AS __body") == 1
    routes = spark.createDataFrame([("BKK", a) for a in ["NRT", "HND", "ICN", "SIN", "KUL", "TPE"]], "dep string, arr string")
    assert sorted(r.arr for r in ev.missing_routes(routes, env).collect()) == ["TPE"]
    wrapped = ev.wrap_responses(spark.createDataFrame(
        [("Tokyo", "Tokyo,JP", 200, '{"main": {"temp": 3}}'), ("Seoul", "Seoul,KR", 401, "{}")],
        schemas.WEATHER_ENVELOPE))
    assert [r.city for r in wrapped.collect()] == ["Tokyo"]


def test_landed_wrappers_roundtrip_to_weather(spark, workdir):  # S10 + K6 + S2
    from aerostat.operators.sinks import land_json
    from aerostat.sources.envelopes import wrap_responses
    from aerostat.sources.feeds import read_weather
    env = spark.createDataFrame(
        [("Tokyo", "Tokyo,JP", 200, '{"main": {"temp": "12.5"}, "weather": [{"main": "Rain"}]}')],
        schemas.WEATHER_ENVELOPE)
    path = os.path.join(workdir, "weather", "2025-04-02")
    land_json(wrap_responses(env), path)
    w = read_weather(spark, path + "/*.json", multiline=False).collect()
    assert [(r.city, r.iata, r.temp, r.weather) for r in w] == [("Tokyo", "NRT", 12.5, "Rain")]


def test_sink_contract_check(spark):
    ok = spark.createDataFrame([], schemas.SERVING)
    assert schemas.check_sink(ok, schemas.SERVING) is ok
    assert "arrival_time: timestamp_ntz" in schemas.schema_tree(ok)
    missing_date = ok.drop("date")  # the notebook load that lost `date` (Q13)
    with pytest.raises(ValueError, match="contract"):
        schemas.check_sink(missing_date, schemas.SERVING)


def test_bad_bodies_lose_nothing_else(spark):  # S9, S10, D3
    from pyspark.sql import types as T
    from aerostat.sources import envelopes as ev
    rec = T.StructType([T.StructField("id", T.LongType()), T.StructField("flight", T.StructType([T.StructField("iata", T.StringType())]))])
    env = spark.createDataFrame([
        ("BKK", "MIX", 200, '{"data": [{"id": 7, "flight": {"iata": "A"}}, "oops", null, 3]}'),
        ("BKK", "LEAF", 200, '{"data": [{"id": "x", "flight": {"iata": "B"}}, {"id": 8}]}'),
        ("BKK", "CUT", 200, '{"data": [{"id": '),
        ("BKK", "HTML", 200, "<html></html>"),
        ("BKK", "NULL", 200, None),
        ("BKK", "OBJ", 200, '{"data": {"id": 1}}'),
    ], schemas.ENVELOPE)
    got = sorted(((r.arr, r.id, r.flight and r.flight.iata) for r in ev.accepted_records(env, rec).collect()), key=str)
    assert got == sorted([("MIX", 7, "A"), ("LEAF", None, "B"), ("LEAF", 8, None)], key=str)
    assert sorted((r.arr, r.reason) for r in ev.element_rejects(env, rec).collect()) == [
        ("LEAF", ev.BAD_FIELD), ("MIX", ev.NOT_AN_OBJECT), ("MIX", ev.NOT_AN_OBJECT), ("MIX", ev.NOT_AN_OBJECT)]
    assert {r.arr: r.reason for r in ev.rejected(env).collect()} == {
        "CUT": ev.REQUEST_FAILED, "HTML": ev.REQUEST_FAILED, "NULL": ev.REQUEST_FAILED, "OBJ": ev.NO_DATA}
    assert {r.arr: r.records for r in ev.per_route_status(env).collect()}["MIX"] == 1
    w = spark.createDataFrame([("Tokyo", "q", 200, '{"main": {'), ("Seoul", "q", 200, "{}"), ("Rome", "q", 401, "{}"),
                               ("Oslo", "q", None, None)], schemas.WEATHER_ENVELOPE)
    assert [r.city for r in ev.wrap_responses(w).collect()] == ["Seoul"]
    assert {r.city: r.reason for r in ev.weather_rejects(w).collect()} == {
        "Tokyo": ev.REQUEST_FAILED, "Rome": ev.HTTP_ERROR, "Oslo": ev.REQUEST_FAILED}


@pytest.mark.parametrize("mode", ["partition", "version"])
def test_missing_day_raises_before_any_write(spark, workdir, mode):  # K2, K7, S4
    for day in ("2025-04-01", "2025-04-03"):
        _land(workdir, day, [flight(f"F{day[-1]}", "BKK", "NRT", f"{day}T05:00:00", "X")])
    clean, t = f"{workdir}/clean", _table()
    daily.run(spark, workdir, clean, ["2025-04-01", "2025-04-03"])
    serving.replace_day(spark, t, f"{workdir}/tbl", clean, "2025-04-01", mode=mode)
    for call in (lambda: serving.replace_day(spark, t, f"{workdir}/tbl", clean, "2025-04-02", mode=mode),
                 lambda: serving.backfill(spark, t, f"{workdir}/tbl", clean, "2025-04-01", "2025-04-03", mode=mode),
                 lambda: serving.load(spark, clean, f"{workdir}/srv", ["2025-04-02"])):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            call()
    assert [r.flight_iata for r in spark.table(t).collect()] == ["F1"]
    assert not os.path.exists(f"{workdir}/srv")


def test_empty_days(spark, workdir):  # K1, A8
    _land(workdir, "2025-04-02", [flight("F", "BKK", "NRT", "2025-04-02T05:00:00", "X")])
    clean, srv = f"{workdir}/clean", f"{workdir}/srv"
    assert daily.run(spark, workdir, clean, ["2025-04-02"]) == 1 and serving.load(spark, clean, srv, ["2025-04-02"]) == 1
    _land(workdir, "2025-04-02", [])
    assert daily.run(spark, workdir, clean, ["2025-04-02"]) == 0 and serving.read_clean(spark, clean).count() == 0
    assert serving.load(spark, clean, srv, ["2025-04-02"]) == 0
    assert spark.read.schema(schemas.SERVING).parquet(f"{srv}/ingest_date=2025-04-02").count() == 0
    _land(workdir, "2025-04-05", [])  # empty from the start
    assert daily.run(spark, workdir, clean, ["2025-04-05"]) == 0
    assert serving.read_clean(spark, clean, ["2025-04-05"]).count() == 0
    t = _table()
    serving.replace_day(spark, t, f"{workdir}/tbl", clean, "2025-04-05", mode="partition")
    assert spark.table(t).count() == 0


def test_a_name_keeps_its_mode(spark, workdir):
    _land(workdir, "2025-04-02", [flight("F", "BKK", "NRT", "2025-04-02T05:00:00", "X")])
    clean = f"{workdir}/clean"
    daily.run(spark, workdir, clean, ["2025-04-02"])
    for first, second in (("partition", "version"), ("version", "partition")):
        t = _table()
        serving.replace_day(spark, t, f"{workdir}/{t}", clean, "2025-04-02", mode=first)
        with pytest.raises(ValueError):
            serving.replace_day(spark, t, f"{workdir}/{t}", clean, "2025-04-02", mode=second)
        assert spark.table(t).count() == 1


def test_default_selection_and_sample_prune_partitions(spark, workdir):
    for day in ("2025-04-01", "2025-04-02", "2025-04-03"):
        _land(workdir, day, [flight(f"F{day[-1]}", "BKK", "NRT", f"{day}T05:00:00", "X")])
    clean, t = f"{workdir}/clean", _table()
    days = ["2025-04-01", "2025-04-02", "2025-04-03"]
    daily.run(spark, workdir, clean, days)
    serving.backfill(spark, t, f"{workdir}/tbl", clean, days[0], days[-1], mode="partition")
    from aerostat.operators.filters import default_selection
    for df, col, want in ((default_selection(spark.table(t), "date", "city"), "date", "F1"),
                          (reports.sample(serving.read_clean(spark, clean), 5), "ingest_date", "F1")):
        assert [r.flight_iata for r in df.collect()] == [want]
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = [ln for ln in plan.split("\n") if "FileScan" in ln and "flight_iata" in ln][0]
        filters = scan.partition("PartitionFilters: [")[2].partition("]")[0]
        assert f"({col}#" in filters and "Subquery" in filters, scan
