"""Time columns: epoch milliseconds, ISO text, fixed windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text with offset or Z to a timestamp, null where it does not parse."""
    return F.try_to_timestamp(text)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def window_floor(ms: Column, width_ms: int) -> Column:
    """Start of the fixed window that holds the epoch millisecond."""
    return ms - F.pmod(ms, F.lit(width_ms))


def days_between(earlier_ms: Column, later_ms: Column) -> Column:
    return (later_ms - earlier_ms) / F.lit(86_400_000.0)
