"""Predicates: day equality, membership, null drops, default selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostat.functions.scalars import date_literal


def on_day(ts_or_date: str | Column, day: str | dt.date) -> Column:
    """``to_date(col) = DATE day`` (F1).

    On a timestamp column Catalyst rewrites this to a range, which reaches
    the Parquet scan as pushed filters.
    """
    c = F.col(ts_or_date) if isinstance(ts_or_date, str) else ts_or_date
    return F.to_date(c) == date_literal(day)


def in_list(col: str | Column, values: Sequence) -> Column:
    """Membership; null never matches and an empty list keeps nothing (F2)."""
    c = F.col(col) if isinstance(col, str) else col
    if len(values) == 0:
        return F.lit(False)
    return c.isin(list(values))


def not_on_day(date_col: str | Column, day: str | dt.date) -> Column:
    """Rows a delete-by-date keeps: a null date is never deleted."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return ~c.eqNullSafe(date_literal(day))


def earliest_day(df: DataFrame, date_col: str) -> Column:
    """Scalar subquery ``(SELECT min(date) FROM df)`` (F7 default date).

    Planned as a one-row subquery evaluated once, not a join.
    """
    return df.select(F.min(date_col)).scalar()


def default_selection(df: DataFrame, date_col: str, city_col: str, facts: DataFrame | None = None) -> DataFrame:
    """Default dashboard selection: earliest date, every non-null city.

    ``facts`` is the frame that ``df`` was enriched from, if it has the date:
    the date is then found there, without the joins behind ``df``.
    """
    first = earliest_day(df if facts is None else facts, date_col)
    return df.where((F.col(date_col) == first) & F.col(city_col).isNotNull())


def select_day_cities(df: DataFrame, date_col: str, day, city_col: str, cities: Sequence) -> DataFrame:
    """``date == day AND city IN cities``."""
    return df.where((F.col(date_col) == date_literal(day)) & in_list(city_col, cities))
