"""Projection of nested records to flat columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, fields: Mapping[str, str], keep: list[str] | None = None) -> DataFrame:
    """Select nested paths under flat aliases, in the mapping's order.

    ``{"flight_iata": "flight.iata"}`` reads struct field ``iata`` of
    ``flight``; a null parent gives a null leaf. Only the named leaves are
    read, so Parquet/JSON scans prune every other nested field. ``keep``
    lists top-level columns carried through unchanged after the leaves.
    """
    return df.select(*[F.col(path).alias(alias) for alias, path in fields.items()], *(keep or []))


def rename(df: DataFrame, names: list[str]) -> DataFrame:
    """Positional rename of every column."""
    return df.toDF(*names)
