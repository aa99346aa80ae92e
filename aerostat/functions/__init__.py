"""Scalar expressions: every function returns a Spark ``Column`` built from
``pyspark.sql.functions`` built-ins, so it stays inside whole-stage codegen."""

from aerostat.functions.scalars import (  # noqa: F401
    array_first,
    date_literal,
    day_range,
    days_ago_in_zone,
    default_unknown,
    float_or_null,
    format_day,
    is_blank,
    is_string,
    json_path,
    json_path_default,
    to_day,
    variant_float,
    variant_string,
    wall_clock_timestamp,
)
from aerostat.functions.lookup import CITY_TO_IATA, lookup  # noqa: F401
