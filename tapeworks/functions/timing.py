"""Instants, buckets and lags, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """RFC 3339 text to a timestamp."""
    return text.cast("timestamp")


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def lag_ms(event: Column, arrival: Column) -> Column:
    """Whole milliseconds from event to arrival, cut towards zero; negative if clocks differ."""
    return F.timestamp_diff("MILLISECOND", event, arrival)


def bucket(ts: Column, seconds: int) -> Column:
    """Start of the bucket of ``seconds`` that holds ts; buckets are aligned to the epoch."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def arrived_since(publish_time: Column, as_of: Column, days: int) -> Column:
    """Arrived within ``days`` before as_of's day, or not yet assigned to a day."""
    return publish_time.isNull() | (publish_time >= F.date_trunc("DAY", as_of) - F.make_interval(days=F.lit(days)))


def within_lookback(event_date: Column, as_of: Column, days: int) -> Column:
    return event_date >= F.date_sub(F.to_date(as_of), days)
