"""Time the daily jobs end to end on feeds derived from the test tables.

Usage: python tools/feed_bench.py [sf_dir]

Flights: one record per ``events`` row (flight code from the event id, the
arrival from the user, the airline from the event type, scheduled at the
event time); weather: the seven cities for every event day. Both are landed
as day-partitioned JSON lines under a fresh scratch folder, then:
transform (all days, one job) -> idempotent serving load -> exact 8-day
backfill (partition mode) -> dashboard frames. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from aerostat.functions.lookup import CITY_TO_IATA  # noqa: E402
from aerostat.operators.sinks import land_json  # noqa: E402
from aerostat.plans import daily, reports, serving  # noqa: E402
from aerostat.session import build_session, scratch_path  # noqa: E402
from aerostat.testdata import table  # noqa: E402

# The requested arrival airports of the feed (HND has no city).
ARRIVALS = ["NRT", "HND", "ICN", "SIN", "KUL", "TPE", "SGN", "HKG"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", app_name="aerostat-feed-bench", shuffle_partitions=16)
    root = scratch_path(spark, "feed-bench")
    ev = table(spark, sf, "events")
    arr = F.element_at(F.array(*[F.lit(a) for a in ARRIVALS]), (F.pmod(F.col("user_id"), F.lit(len(ARRIVALS))) + 1).cast("int"))
    flights = ev.select(
        F.struct(F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("iata")).alias("flight"),
        F.struct(F.lit("BKK").alias("iata")).alias("departure"),
        F.struct(arr.alias("iata"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")).alias("scheduled"),
                 F.concat(arr, F.lit(" airport")).alias("airport")).alias("arrival"),
        F.struct(F.col("event_type").alias("name")).alias("airline"),
        F.to_date("ts").cast("string").alias("ingest_date"),
    )
    days = ev.select(F.to_date("ts").cast("string").alias("ingest_date")).distinct()
    city = F.explode(F.array(*[F.lit(c) for c in CITY_TO_IATA])).alias("city")
    wx = days.select("ingest_date", city)
    temp = (F.pmod(F.xxhash64("ingest_date", "city"), F.lit(350)) / 10.0)
    data = F.to_json(F.struct(F.struct(temp.alias("temp"), F.lit(70).alias("humidity")).alias("main"),
                              F.struct(F.lit(3.5).alias("speed")).alias("wind"),
                              F.array(F.struct(F.lit("Clouds").alias("main"))).alias("weather")))
    weather = wx.select("city", F.col("city").alias("query"), F.parse_json(data).alias("data"), "ingest_date")
    day_list = sorted(r[0] for r in days.collect())  # 30 job parameters, not data
    t = {}
    s = time.perf_counter()
    land_json(flights, f"{root}/flight", "ingest_date")
    land_json(weather, f"{root}/weather", "ingest_date")
    t["land_json_lines"] = time.perf_counter() - s
    s = time.perf_counter()
    n_clean = daily.run(spark, root, f"{root}/clean", day_list, multiline=False)
    t["transform_all_days"] = time.perf_counter() - s
    s = time.perf_counter()
    n_srv = serving.load(spark, f"{root}/clean", f"{root}/serving", day_list)
    t["serving_load_all_days"] = time.perf_counter() - s
    s = time.perf_counter()
    tbl = f"fw_{uuid.uuid4().hex[:8]}"
    serving.backfill(spark, tbl, f"{root}/table", f"{root}/clean", day_list[-8], day_list[-1], mode="partition")
    t["backfill_8_days"] = time.perf_counter() - s
    s = time.perf_counter()
    frames = reports.dashboard(spark.read.parquet(f"{root}/serving"), day_list[-1], list(CITY_TO_IATA))
    sizes = {k: len(v.collect()) for k, v in frames.items()}
    t["dashboard_frames"] = time.perf_counter() - s
    print(json.dumps({"sf": os.path.basename(sf), "flights": n_clean, "serving_rows": n_srv, "days": len(day_list),
                      "backfill_rows": spark.table(tbl).count(), "dashboard_rows": sizes,
                      "seconds": {k: round(v, 3) for k, v in t.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
