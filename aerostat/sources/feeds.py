"""Landed JSON feeds -> flat frames.

Feeds are read with an explicit schema (no inference job, no analysis
failure on an empty array or a missing object) in FAILFAST mode, so a
truncated file raises instead of turning into an all-null row.
Multi-line JSON arrays (the landing format of the original feed) are read by
one task per file, or with ``split`` by byte ranges (``sources.arrays``);
``multiline=False`` reads JSON-lines landings, which split across tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostat import schemas
from aerostat.functions.lookup import CITY_TO_IATA, lookup
from aerostat.functions.scalars import default_unknown, variant_float, variant_string
from aerostat.operators.flatten import flatten
from aerostat.sources.arrays import read_arrays

# the day folder of a landed file: ``.../2025-04-02/data.json`` (one JSON
# array per day) or ``.../ingest_date=2025-04-02/part-*.json`` (JSON lines)
DAY_FROM_PATH = r"/(?:[A-Za-z_]+=)?(\d{4}-\d{2}-\d{2})/[^/]*$"


def day_path(root: str, feed: str, day: str | dt.date, jsonlines: bool = False) -> str:
    """Where one day of a feed is landed (S3).

    ``{root}/{feed}/{YYYY-MM-DD}/data.json`` for the one-array-per-day form;
    ``{root}/{feed}/ingest_date={YYYY-MM-DD}`` for day-partitioned JSON lines
    (``operators.sinks.land_json(..., partition_col="ingest_date")``).
    """
    base = f"{root.rstrip('/')}/{feed}"
    return f"{base}/ingest_date={day}" if jsonlines else f"{base}/{day}/data.json"


def read_json_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    multiline: bool = True,
    with_day: bool = False,
    split: bool = False,
) -> DataFrame:
    """Scan JSON arrays (or JSON lines) with a fixed schema.

    A missing path fails at analysis (PATH_NOT_FOUND, S4); a corrupt file
    fails the job (FAILFAST). ``with_day`` adds ``ingest_date`` taken from
    the ``YYYY-MM-DD`` folder of each file, so many days scan in one job.
    ``split`` reads a large array by several tasks.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise FileNotFoundError("no input paths given")
    if multiline and split:
        day = F.regexp_extract(F.col("_metadata.file_path"), DAY_FROM_PATH, 1)
        rows = read_arrays(spark, paths, schema, day if with_day else None)
        return rows.withColumn("ingest_date", F.to_date(F.nullif("tag", F.lit("")))).drop("tag") if with_day else rows
    df = (
        spark.read.schema(schema)
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .json(paths)
    )
    if with_day:
        day = F.regexp_extract(F.col("_metadata.file_path"), DAY_FROM_PATH, 1)
        df = df.withColumn("ingest_date", F.to_date(F.nullif(day, F.lit(""))))
    return df


def flights(raw: DataFrame) -> DataFrame:
    """Flatten raw flight records to the six flight columns.

    ``arrival_time`` stays text here, as in the clean contract.
    """
    keep = ["ingest_date"] if "ingest_date" in raw.columns else []
    return flatten(raw, schemas.FLIGHT_FIELDS, keep)


def read_flights(spark: SparkSession, paths, multiline: bool = True, with_day: bool = False,
                 split: bool = False) -> DataFrame:
    """Raw flight feed -> flight frame (S1 + P1)."""
    return flights(read_json_records(spark, paths, schemas.FLIGHT_RAW, multiline, with_day, split))


def weather(raw: DataFrame, condition_mode: str = "intent", city_to_iata=CITY_TO_IATA,
            keep: Sequence[str] = ()) -> DataFrame:
    """Shape weather wrappers into the fixed weather frame.

    * ``iata`` by lookup of the city (J2), null for an unknown city;
    * ``temp``/``humidity``/``wind_speed`` by lenient float parse of the
      loosely typed leaves (X1): number, numeric string, boolean -> value;
      anything else or missing -> null; narrowed to float;
    * ``weather`` = first element of ``data.weather`` (P3) when it is a
      non-blank string, else ``'Unknown'`` (X3, P4).
      ``condition_mode="reference"`` reproduces the original helper, which
      never descends into the list and so always yields ``'Unknown'``.

    ``keep`` carries extra raw columns through after the contract columns.
    """
    d = F.col("data")
    if condition_mode == "reference":
        condition = F.lit("Unknown")
    elif condition_mode == "intent":
        condition = default_unknown(variant_string(d, "$.weather[0].main"))
    else:
        raise ValueError(f"unknown condition_mode {condition_mode!r}")
    extra = list(keep) + (["ingest_date"] if "ingest_date" in raw.columns and "ingest_date" not in keep else [])
    return raw.select(
        F.col("city"),
        lookup(F.col("city"), city_to_iata).alias("iata"),
        variant_float(d, "$.main.temp").alias("temp"),
        variant_float(d, "$.main.humidity").alias("humidity"),
        condition.alias("weather"),
        variant_float(d, "$.wind.speed").alias("wind_speed"),
        *extra,
    )


def read_landed_weather(spark: SparkSession, path: str, condition_mode: str = "intent", city_to_iata=CITY_TO_IATA,
                        keep: Sequence[str] = ()) -> DataFrame:
    """Weather landed by ``envelopes.land_wrappers`` -> weather frame.

    The scan reads the four paths of the bodies that are used, as typed
    columns where the files have them shredded, and no whole body.
    """
    return weather(spark.read.schema(schemas.WEATHER_RAW).parquet(path), condition_mode, city_to_iata, keep)


def read_weather(
    spark: SparkSession,
    paths,
    multiline: bool = True,
    with_day: bool = False,
    condition_mode: str = "intent",
) -> DataFrame:
    """Raw weather feed -> weather frame, distributed (S2; no driver loop)."""
    raw = read_json_records(spark, paths, schemas.WEATHER_RAW, multiline, with_day)
    return weather(raw, condition_mode)
