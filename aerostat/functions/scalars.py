"""Lenient JSON paths, float parsing, condition defaults and date helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- P2 / P3: nested path reads --------------------------------------------

def json_path(doc: Column, path: str, type_: str = "string") -> Column:
    """Read ``path`` (``$.a.b``, ``$.a[0].b``) from a variant column.

    Null when any step is missing, is not an object/array, or the leaf cannot
    be cast to ``type_`` — never an error (``try_variant_get``).
    """
    return F.try_variant_get(doc, path, type_)


def json_path_default(doc: Column, path: str, default: str) -> Column:
    """``json_path`` with a default for a missing step (P2 with default)."""
    return F.coalesce(json_path(doc, path, "string"), F.lit(default))


def array_first(arr: ColumnOrName) -> Column:
    """First element of an array; null for an empty or null array."""
    return F.try_element_at(_c(arr), F.lit(1))


# --- X1 / X2 / X3 / P4 -----------------------------------------------------

def float_or_null(text: ColumnOrName) -> Column:
    """Lenient float from text: outer blanks allowed, anything else -> null.

    Narrowed to 32-bit float like the weather contract. (Text ``'true'`` is
    null here; a JSON boolean leaf goes through ``variant_float`` instead.)
    """
    return _c(text).try_cast("float")


def variant_float(doc: Column, path: str) -> Column:
    """Lenient float from a loosely typed JSON leaf (X1 on typed JSON).

    number -> value, numeric string (outer blanks allowed) -> value,
    boolean -> 1/0, anything else or missing -> null.
    """
    return F.try_variant_get(doc, path, "float")


def is_string(doc: Column, path: str = "$") -> Column:
    """True when the JSON leaf at ``path`` is a string."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant")) == F.lit("STRING")


def variant_string(doc: Column, path: str) -> Column:
    """The leaf as text only when it *is* a string; numbers etc. give null."""
    leaf = F.try_variant_get(doc, path, "variant")
    return F.when(F.schema_of_variant(leaf) == F.lit("STRING"), F.try_variant_get(leaf, "$", "string"))


def is_blank(text: ColumnOrName) -> Column:
    """Null-safe trimmed-empty test."""
    return F.coalesce(F.trim(_c(text)) == F.lit(""), F.lit(False))


def default_unknown(text: ColumnOrName, default: str = "Unknown") -> Column:
    """Null or blank -> ``default``; otherwise the value unchanged."""
    c = _c(text)
    return F.when(c.isNull() | is_blank(c), F.lit(default)).otherwise(c)


# --- X4 .. X9: timestamps and days -----------------------------------------

def wall_clock_timestamp(text: ColumnOrName) -> Column:
    """ISO date-time text -> ``timestamp_ntz`` keeping the wall clock.

    An offset such as ``-09:00`` is dropped, never applied, so the calendar
    date is the one written in the text regardless of session time zone.
    Null or blank text gives null; malformed text fails the job under ANSI
    mode (the Spark default), as the original date conversion did.
    """
    c = _c(text)
    return F.when(~is_blank(c), F.to_timestamp_ntz(c))


def to_day(ts: ColumnOrName) -> Column:
    """Timestamp (or ISO text) -> calendar date."""
    return F.to_date(_c(ts))


def format_day(d: ColumnOrName) -> Column:
    """Date/timestamp -> ``YYYY-MM-DD`` text."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def days_ago_in_zone(now_utc: ColumnOrName, n: int, zone: str = "Asia/Bangkok") -> Column:
    """Calendar day in ``zone`` of a UTC wall-clock ``timestamp_ntz``, minus ``n`` days.

    ``convert_timezone`` applies the zone's rules (offsets, DST) and never
    the session time zone. The instant is a job parameter or data, never
    ``current_timestamp`` inside a plan, so a retried task sees the same day.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(now_utc))
    return F.date_sub(F.to_date(local), n)


def day_range(end: ColumnOrName, days_back: int) -> Column:
    """Inclusive array of days ``[end - days_back, end]`` ascending."""
    e = _c(end)
    return F.sequence(F.date_sub(e, days_back), e)


def date_literal(day: str | dt.date) -> Column:
    """``DATE 'YYYY-MM-DD'`` literal."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return F.lit(day)
