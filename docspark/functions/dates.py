"""Durations and time buckets. The session time zone is expected to be UTC."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F, types as T

_DURATION = re.compile(
    r"^P(?:(?P<years>[\d.]+)Y)?(?:(?P<months>[\d.]+)M)?(?:(?P<weeks>[\d.]+)W)?(?:(?P<days>[\d.]+)D)?"
    r"(?:T(?:(?P<hours>[\d.]+)H)?(?:(?P<minutes>[\d.]+)M)?(?:(?P<seconds>[\d.]+)S)?)?$"
)
_MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}
UNITS = ("year", "month", "week", "day", "hour", "minute", "second")


def duration_seconds(iso: str) -> float:
    """Seconds of an ISO-8601 duration. Months count as whole days: one is 30, twelve are 365."""
    match = _DURATION.match(iso)
    parts = {k: float(v) for k, v in match.groupdict().items() if v} if match else {}
    if not parts:
        raise ValueError(f"not an ISO-8601 duration: {iso!r}")
    months = 12 * parts.get("years", 0) + parts.get("months", 0)
    days = math.floor(months * 146097 / 4800 + 0.5) + 7 * parts.get("weeks", 0) + parts.get("days", 0)
    return (
        days * 86400 + parts.get("hours", 0) * 3600 + parts.get("minutes", 0) * 60
        + parts.get("seconds", 0)
    )


def iso_utc(ts: Column) -> Column:
    """`2015-01-31T00:00:00.000Z` form of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def fixed_bucket(ts: Column, dtype: T.DataType, width_micros: int, origin_micros: int = 0) -> Column:
    """Start of the fixed-width bucket, counted from the epoch (or another origin)."""
    if width_micros <= 0:
        raise ValueError("the bucket width must be positive")
    # Integer arithmetic rather than window(): several time keys fit in one query.
    m = _micros(ts)
    start = m - F.pmod(m - F.lit(origin_micros), F.lit(width_micros))
    return F.timestamp_micros(start).cast(_key_type(dtype))


def unit_bucket(ts: Column, dtype: T.DataType, unit: str, count: int = 1) -> Column:
    """Start of the calendar bucket of `count` units.

    Months and years count from 1970-01, weeks from Monday 1969-12-29.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown time unit {unit!r}; known: {UNITS}")
    if isinstance(count, bool) or not isinstance(count, int) or count < 1:
        raise ValueError("the number of units must be a positive integer")
    if count == 1:
        return F.date_trunc(unit, ts).cast(_key_type(dtype))
    if unit in _MICROS:
        return fixed_bucket(ts, dtype, count * _MICROS[unit])
    if unit == "week":
        return fixed_bucket(ts, dtype, 7 * count * _MICROS["day"], origin_micros=-3 * _MICROS["day"])
    step = count * (12 if unit == "year" else 1)
    months = (F.year(ts) - 1970) * 12 + F.month(ts) - 1
    first = F.add_months(F.lit("1970-01-01").cast("date"), months - F.pmod(months, F.lit(step)))
    return first.cast(_key_type(dtype))


def _key_type(dtype: T.DataType) -> T.DataType:
    return dtype if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else T.TimestampType()
