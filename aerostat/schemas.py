"""Fixed data contracts (D2): raw feeds, clean dataset, serving table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, F32 = T.StringType(), T.FloatType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


# Raw flight feed: only the leaves that are read; everything else is pruned.
FLIGHT_RAW = _struct(
    flight=_struct(iata=S),
    departure=_struct(iata=S),
    arrival=_struct(iata=S, scheduled=S, airport=S),
    airline=_struct(name=S),
)

# flat alias -> nested path, in output order
FLIGHT_FIELDS = {
    "flight_iata": "flight.iata",
    "departure_iata": "departure.iata",
    "arrival_iata": "arrival.iata",
    "arrival_time": "arrival.scheduled",
    "airline": "airline.name",
    "arr_airport": "arrival.airport",
}

# Raw weather feed: wrapper objects; the response body stays loosely typed.
WEATHER_RAW = T.StructType(
    [
        T.StructField("city", S, True),
        T.StructField("query", S, True),
        T.StructField("data", T.VariantType(), True),
    ]
)

FLIGHT = _struct(**{k: S for k in FLIGHT_FIELDS})

WEATHER = _struct(city=S, iata=S, temp=F32, humidity=F32, weather=S, wind_speed=F32)

CLEAN = T.StructType(FLIGHT.fields + WEATHER.fields)
# the clean dataset as stored: the contract plus its day partition column
CLEAN_STORED = T.StructType(CLEAN.fields + [T.StructField("ingest_date", T.DateType())])

SERVING = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType() if f.name == "arrival_time" else f.dataType, True)
        for f in CLEAN.fields
    ]
    + [T.StructField("date", T.DateType(), True)]
)

# the serving dataset as stored by file day
SERVING_STORED = T.StructType(SERVING.fields + [T.StructField("ingest_date", T.DateType())])

# Landed HTTP responses: status is null when the request itself failed.
ENVELOPE = _struct(dep=S, arr=S, status=T.IntegerType(), body=S)

WEATHER_ENVELOPE = _struct(city=S, query=S, status=T.IntegerType(), body=S)

REJECT = _struct(dep=S, arr=S, status=T.IntegerType(), reason=S)


def check_contract(df: DataFrame, contract: T.StructType, ignore_nullability: bool = True) -> None:
    """Raise ``ValueError`` when ``df`` deviates from a fixed contract.

    Names, order and types must match exactly.
    """
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in contract.fields]
    if got != want or (not ignore_nullability and df.schema != contract):
        raise ValueError(f"schema contract violated:\n got  {got}\n want {want}")


def schema_tree(df: DataFrame) -> str:
    """The schema as an indented tree, for inspection."""
    return df.schema.treeString()


def check_sink(df: DataFrame, contract: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """Contract check before a write (Q13): ``df`` minus ``extra`` columns
    must equal ``contract``; returns ``df`` unchanged. Schema only, no job."""
    check_contract(df.drop(*extra), contract)
    return df
