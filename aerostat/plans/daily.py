"""Daily transform: landed flight + weather feeds -> clean dataset (entry A).

One job for any number of days: both feeds are scanned for all requested
days at once, tagged with ``ingest_date`` from their folder, and joined on
(``ingest_date``, arrival code) so each day's flights meet that day's
weather only. The weather side is bounded by the city list per day; its
files are far under the broadcast threshold, so flights are not shuffled.
The flight feed is scanned and parsed once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat import schemas
from aerostat.operators.joins import left_join
from aerostat.operators.sinks import write_partitioned
from aerostat.sources.feeds import day_path, read_flights, read_weather

FLIGHT_FEED, WEATHER_FEED = "flight", "weather"


def clean_rows(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join flights to weather on the arrival code (J1), contract order.

    Both frames carry ``ingest_date``; it is part of the join key so a
    multi-day run never mixes days. Null codes never match; two weather
    rows for one city fan the flight out; HND (not in the lookup) keeps
    null weather. Null codes take part in the join: setting them apart would
    parse the feed twice, and they are not shuffled where weather is
    broadcast; should it be too large for that, AQE splits their partition.
    """
    w = weather.withColumnRenamed("ingest_date", "w_ingest_date")
    j = left_join(flights, w, ["ingest_date", "arrival_iata"], ["w_ingest_date", "iata"], null_keys_apart=False)
    return j.select(*[F.col(f.name) for f in schemas.CLEAN.fields], "ingest_date")


def transform(
    spark: SparkSession,
    raw_root: str,
    days: Sequence[str | dt.date],
    multiline: bool = True,
    condition_mode: str = "intent",
    split_arrays: bool = False,
) -> DataFrame:
    """Clean rows for ``days`` (lazy). Missing day files fail at analysis.

    ``multiline=True`` reads one JSON array per day (``{day}/data.json``),
    with ``split_arrays`` the flights' by several tasks a file; ``False``
    reads day-partitioned JSON lines (``ingest_date={day}/``).
    """
    days = [str(d) for d in days]
    jl = not multiline
    fl = read_flights(spark, [day_path(raw_root, FLIGHT_FEED, d, jl) for d in days], multiline, with_day=True,
                      split=split_arrays)
    wx = read_weather(spark, [day_path(raw_root, WEATHER_FEED, d, jl) for d in days], multiline, with_day=True,
                      condition_mode=condition_mode)
    return clean_rows(fl, wx)


def run(
    spark: SparkSession,
    raw_root: str,
    clean_root: str,
    days: Sequence[str | dt.date],
    multiline: bool = True,
    condition_mode: str = "intent",
    split_arrays: bool = False,
) -> int:
    """Transform ``days`` and overwrite exactly those ``ingest_date`` partitions (K1).

    A day whose feed is empty becomes an empty partition. Returns the number
    of rows written, counted inside the write job.
    """
    clean = schemas.check_sink(transform(spark, raw_root, days, multiline, condition_mode, split_arrays),
                               schemas.CLEAN, ("ingest_date",))
    return write_partitioned(clean, clean_root, "ingest_date", days)
