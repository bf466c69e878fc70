"""Calendar and event-time helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Day = str | dt.date


def as_date(day: Day) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def iso(day: Day, shift: int = 0) -> str:
    """``day + shift`` as text. A text literal prunes ``dt`` partitions whether the column is
    a string or a date."""
    return (as_date(day) + dt.timedelta(days=shift)).isoformat()


def seconds(value: float) -> Column:
    """A day-time interval literal, exact to the microsecond."""
    return F.expr(f"INTERVAL '{value:.6f}' SECOND")


def later(ts: Column, by: float, kind: T.DataType) -> Column:
    """``ts`` moved by a number of seconds; plain numbers are taken as seconds."""
    if isinstance(kind, T.NumericType):
        return ts + F.lit(by)
    return ts + seconds(by)


def place(df: DataFrame, name: str) -> Column:
    """A number that never decreases as the column grows.

    Wall-clock timestamps are read field by field: converting them through the session time
    zone would run backwards across a daylight-saving gap.
    """
    return place_of(F.col(name), df.schema[name].dataType)


def place_of(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col) / F.lit(1e6)
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
        return (F.unix_date(col.cast("date")) * F.lit(86400.0)) + clock
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    raise TypeError(f"cannot order by {kind.simpleString()}")
