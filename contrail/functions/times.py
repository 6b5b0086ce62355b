"""Time text, epochs and lags. All text is UTC with second precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from contrail.schemas import TIME_TEXT


def parse_utc(text: Column) -> Column:
    """ISO text to timestamp; text in any other form gives null instead of failing the query."""
    return F.try_to_timestamp(text, F.lit(TIME_TEXT))


def to_iso(ts: Column) -> Column:
    """Timestamp to ISO text, fraction dropped."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_to_iso(seconds: Column) -> Column:
    """Epoch seconds (fractions floor, also below zero) to ISO text."""
    return to_iso(F.timestamp_seconds(F.floor(seconds)))


def lag_seconds(later: Column, earlier: Column) -> Column:
    """Difference in whole seconds, each side truncated to the second before subtracting."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss 'UTC'")
