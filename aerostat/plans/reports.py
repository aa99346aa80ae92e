"""Ad-hoc summaries (entry C) and dashboard frames (entry D)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat.operators import aggregate as agg
from aerostat.operators import filters, topk
from aerostat.operators.flatten import rename
from aerostat.sources import footers


def sample(clean: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows of the earliest day, the same ones every run (L4, Q9).

    The day comes from the partition values, and only its partition is
    read; every column sorts, which is a total order.
    """
    if "ingest_date" in clean.columns:
        clean = clean.where(F.col("ingest_date") == filters.earliest_day(clean, "ingest_date"))
    return topk.preview(clean, rows, clean.columns)


def adhoc(clean: DataFrame, preview_rows: int = 5) -> dict[str, DataFrame]:
    """Sample rows, flights per airline, flights per condition (SQL semantics:
    the null group is kept; ties broken by key)."""
    return {
        "sample": sample(clean, preview_rows),
        "by_airline": agg.count_by_group(clean, "airline", "total_flights"),
        "by_condition": agg.count_by_group(clean, "weather", "count"),
    }


def options(serving: DataFrame) -> dict[str, DataFrame]:
    """Selectable dates (nulls excluded) and non-null cities, sorted."""
    return {
        "dates": agg.distinct_values(serving, "date", drop_null=True),
        "cities": agg.distinct_values(serving, "city", drop_null=True),
    }


# frame -> key, what is counted, what is averaged: the three dashboard frames
DASHBOARD_FRAMES = {
    "flights_per_airline": ("airline", "*", None),
    "avg_temp_by_city": ("city", None, "temp"),
    "flights_vs_temp": ("city", "flight_iata", "temp"),
}


def dashboard_frames(serving: DataFrame, day: str | dt.date, cities: Sequence[str] | None = None) -> DataFrame:
    """The three dashboard frames of a day as one frame, from one scan.

    Rows are ``frame``, ``key``, ``n`` and ``mean``. Without ``cities``
    every non-null city is selected.
    """
    chosen = filters.in_list("city", cities) if cities is not None else serving["city"].isNotNull()
    return agg.frames_in_one_pass(serving.where(filters.on_day("date", day) & chosen), DASHBOARD_FRAMES)


def default_dashboard(spark: SparkSession, path: str, schema: T.StructType, cities: Sequence[str] | None = None) -> DataFrame:
    """``dashboard_frames`` of the earliest date of a serving dataset, by default of every city.

    The earliest date comes from the file footers, so the rows are scanned
    once and only where they have that date. No dates, no rows.
    """
    serving = spark.read.schema(schema).parquet(path)
    first = footers.earliest_day(spark, path, schema, "date")
    return dashboard_frames(serving if first else serving.limit(0), first or dt.date(1970, 1, 1), cities)


def dashboard(serving: DataFrame, day: str | dt.date | None = None,
              cities: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The three dashboard frames for one day and a city selection.

    With no day/cities: the default selection — earliest date, every
    non-null city (F7). pandas semantics: null groups dropped.
    """
    if day is None and cities is None:
        picked = filters.default_selection(serving, "date", "city")
    else:
        if day is None:
            day_col = filters.earliest_day(serving, "date")
            picked = serving.where(day_col == serving["date"])
        else:
            picked = serving.where(filters.on_day("date", day))
        if cities is not None:
            picked = picked.where(filters.in_list("city", cities))
        else:
            picked = picked.where(serving["city"].isNotNull())
    return {
        "flights_per_airline": rename(agg.value_counts(picked, "airline", "n"), ["Airline", "Count"]),
        "avg_temp_by_city": agg.mean_by_group(picked, "city", "temp", "temp"),
        "flights_vs_temp": agg.count_and_mean(picked, "city", "flight_iata", "temp", "flight_count", "avg_temp"),
    }
