"""Time expressions. All of them stay inside code generation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: str | datetime | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def floor_hour(c: Column | str) -> Column:
    return F.date_trunc("HOUR", _col(c))


def round_hour(c: Column | str) -> Column:
    """Nearest hour; an exact half goes to the even hour (12:30 -> 12:00, 13:30 -> 14:00)."""
    c = _col(c)
    into = F.unix_micros(c) - F.unix_micros(floor_hour(c))
    half = MICROS_PER_HOUR // 2
    up = (into > half) | ((into == half) & (F.hour(c) % 2 == 1))
    return F.when(up, floor_hour(c) + F.expr("INTERVAL 1 HOUR")).otherwise(floor_hour(c))


def floor_interval(c: Column | str, seconds: int, origin: Column | str | None = None) -> Column:
    """Start of the ``seconds``-wide bin that holds ``c``; bins are counted from ``origin``.

    Without an origin bins start at midnight, which needs ``seconds`` to divide a day.
    """
    c = _col(c)
    if origin is None:
        if 86_400 % seconds:
            raise ValueError("bins that do not divide a day need an origin")
        return F.timestamp_seconds(F.unix_seconds(c) - F.pmod(F.unix_seconds(c), F.lit(seconds)))
    start = F.unix_seconds(ts_lit(origin) if not isinstance(origin, Column) else origin)
    return F.timestamp_seconds(F.unix_seconds(c) - F.pmod(F.unix_seconds(c) - start, F.lit(seconds)))


def weekday(c: Column | str) -> Column:
    """Monday = 0."""
    return F.weekday(_col(c))


def steps_since(c: Column | str, start: Column | str | datetime, step_seconds: int = 3600) -> Column:
    """Whole grid steps from ``start``; on a complete grid this is the row's position."""
    gap = F.unix_seconds(_col(c)) - F.unix_seconds(ts_lit(start))
    return F.floor(gap / F.lit(step_seconds)).cast("long")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, rounded down (so -30 s is -1 minute)."""
    return F.floor((F.unix_micros(_col(end)) - F.unix_micros(_col(start))) / F.lit(60_000_000)).cast("long")


def clock_hours(c: Column | str) -> Column:
    """``hh:mm:ss`` text as hours; malformed text gives null."""
    parts = F.split(_col(c), ":")
    num = [F.get(parts, F.lit(i)).try_cast("double") for i in range(3)]
    return (num[0] * 3600 + num[1] * 60 + num[2]) / F.lit(3600.0)


def parse_time(c: Column | str, fmt: str) -> Column:
    """Text to timestamp, whole seconds; unparsable text gives null."""
    return F.date_trunc("SECOND", F.try_to_timestamp(_col(c), F.lit(fmt)))


def cyclic(c: Column | str, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * _col(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)
