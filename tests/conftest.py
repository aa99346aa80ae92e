from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerostat.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="aerostat-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="aerostat-test-")


def write_feed(root: str, feed: str, day: str, payload) -> str:
    """Land one day's feed as the original pretty-printed JSON array."""
    d = os.path.join(root, feed, day)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, "data.json")
    with open(p, "w", encoding="utf-8") as f:
        if isinstance(payload, str):
            f.write(payload)
        else:
            json.dump(payload, f, ensure_ascii=False, indent=2)
    return p


def flight(fi, dep, arr, sched, airline, airport="Arr Airport"):
    rec = {
        "flight": None if fi is None else {"iata": fi, "number": "1"},
        "departure": {"iata": dep, "airport": "Suvarnabhumi"},
        "arrival": {"iata": arr, "scheduled": sched, "airport": airport},
        "airline": {"name": airline},
        "flight_status": "scheduled",
    }
    return rec


def weather(city, temp=20.0, humidity=50, wind=3.5, cond="Clouds", query=None):
    data = {"main": {"temp": temp, "humidity": humidity}, "wind": {"speed": wind}}
    if cond is not None:
        data["weather"] = [{"main": cond, "description": "x"}]
    return {"city": city, "query": query or f"{city},XX", "data": data}
