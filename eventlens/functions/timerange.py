"""Time windows: relative ranges, explicit bounds, defaults, and slices.

A window is resolved on the driver into two instants, so that the filter built
from it is a plain comparison of the bare timestamp column with literals, which
reaches the parquet scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The relative ranges (m = minute).
RANGES = {
    "1m": timedelta(minutes=1),
    "15m": timedelta(minutes=15),
    "30m": timedelta(minutes=30),
    "1h": timedelta(hours=1),
    "2h": timedelta(hours=2),
    "6h": timedelta(hours=6),
    "12h": timedelta(hours=12),
    "1d": timedelta(days=1),
    "7d": timedelta(days=7),
    "14d": timedelta(days=14),
    "30d": timedelta(days=30),
}

QUERY_DEFAULT = "1d"
EVENTS_DEFAULT = "1h"

SLICE_UNITS = {
    "d": timedelta(days=1),
    "h": timedelta(hours=1),
    "m": timedelta(minutes=1),
    "s": timedelta(seconds=1),
    "ms": timedelta(milliseconds=1),
}

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
MICROSECOND = timedelta(microseconds=1)


@dataclass(frozen=True)
class TimeWindow:
    """Half-open ``[start, end)`` in UTC; ``None`` leaves that side open."""

    start: datetime | None
    end: datetime | None


def instant(value: str | datetime) -> datetime:
    """An ISO-8601 string with offset, or an aware datetime, as UTC."""
    parsed = datetime.fromisoformat(value) if isinstance(value, str) else value
    if parsed.tzinfo is None:
        raise ValueError(f"{value!r} needs a UTC offset, e.g. 2024-01-15T10:00:00Z")
    return parsed.astimezone(timezone.utc)


def range_length(token: str) -> timedelta:
    if token not in RANGES:
        raise ValueError(f"unknown range {token!r}; use one of {', '.join(RANGES)}")
    return RANGES[token]


def query_window(
    now: str | datetime,
    range: str | None = None,
    from_date_utc: str | datetime | None = None,
    to_date_utc: str | datetime | None = None,
) -> TimeWindow:
    """Policy for aggregate queries: both bounds are always closed, default 24 h."""
    at = instant(now)
    if range is None and from_date_utc is None and to_date_utc is None:
        range = QUERY_DEFAULT
    if range is not None:
        return TimeWindow(at - range_length(range), at)
    end = at if to_date_utc is None else instant(to_date_utc)
    start = end - RANGES[QUERY_DEFAULT] if from_date_utc is None else instant(from_date_utc)
    if start > end:
        bound = "the current time" if to_date_utc is None else "toDateUtc"
        raise ValueError(f"fromDateUtc {start.isoformat()} is after {bound} {end.isoformat()}")
    return TimeWindow(start, end)


def events_window(
    now: str | datetime,
    range: str | None = None,
    from_date_utc: str | datetime | None = None,
    to_date_utc: str | datetime | None = None,
) -> TimeWindow:
    """Policy for event pages: explicit bounds stay as given, default 1 h."""
    if range is None and (from_date_utc is not None or to_date_utc is not None):
        return TimeWindow(
            None if from_date_utc is None else instant(from_date_utc),
            None if to_date_utc is None else instant(to_date_utc),
        )
    at = instant(now)
    return TimeWindow(at - range_length(range or EVENTS_DEFAULT), at)


def ts_literal(df: DataFrame, at: datetime, column: str = "ts") -> Column:
    """``at`` as a literal of the type of ``column``, so that no cast lands on the column."""
    text = instant(at).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def within(df: DataFrame, window: TimeWindow, column: str = "ts") -> DataFrame:
    """Keep rows in ``window``; also prunes by ``event_date`` where the table has it."""
    dated = "event_date" in df.columns
    if window.start is not None:
        df = df.filter(F.col(column) >= ts_literal(df, window.start, column))
        if dated:
            df = df.filter(F.col("event_date") >= F.lit(window.start.date()))
    if window.end is not None:
        df = df.filter(F.col(column) < ts_literal(df, window.end, column))
        if dated:
            df = df.filter(F.col("event_date") <= F.lit(window.end.date()))
    return df


def slice_length(token: str) -> timedelta:
    """``5m`` -> five minutes; units d, h, m, s, ms."""
    match = re.fullmatch(r"([1-9]\d*)(ms|[dhms])", token)
    if match is None:
        raise ValueError(f"slice {token!r} is not <n><unit> with unit d, h, m, s or ms")
    return int(match[1]) * SLICE_UNITS[match[2]]


def interval(length: timedelta) -> str:
    """A fixed-length Spark interval string."""
    return f"{length // MICROSECOND} microseconds"


def slice_start(token: str, column: str = "ts") -> Column:
    """Start of the epoch-aligned slice the row falls into."""
    return F.window(F.col(column), interval(slice_length(token)))["start"]


def slice_number(column: str, length: timedelta) -> Column:
    """Epoch-aligned number of the stretch of ``length`` a timestamp falls into."""
    return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / F.lit(length // MICROSECOND))


def align_down(at: datetime, length: timedelta) -> datetime:
    return at - (instant(at) - EPOCH) % length
