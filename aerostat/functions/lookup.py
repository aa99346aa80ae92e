"""Lookup-map join: a small fixed mapping applied as a map literal."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weather city name -> arrival airport code. These must equal
# the feed's own mapping for results to match. A city outside the map (and
# the requested arrival HND, which no city maps to) yields null.
CITY_TO_IATA = {
    "Tokyo": "NRT",
    "Seoul": "ICN",
    "Singapore": "SIN",
    "Kuala Lumpur": "KUL",
    "Taipei": "TPE",
    "Ho Chi Minh": "SGN",
    "Hong Kong": "HKG",
}


def lookup(key: Column | str, mapping: Mapping[str, str] = CITY_TO_IATA) -> Column:
    """``mapping.get(key)`` as a JVM-side map literal; null when absent.

    For a mapping that is data rather than configuration (large or
    changing), left-join a dimension frame instead (``operators.joins``).
    """
    k = F.col(key) if isinstance(key, str) else key
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), k)
