"""Row filters. Plain comparisons on columns, so that file and JDBC scans take them over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions import has_position


def with_position(df: DataFrame) -> DataFrame:
    """Rows with both coordinates."""
    return df.where(has_position(F.col("lat"), F.col("lon")))


def within_bbox(df: DataFrame, lamin: float, lamax: float, lomin: float, lomax: float) -> DataFrame:
    """Rows inside the box, bounds included."""
    return df.where(F.col("lat").between(lamin, lamax) & F.col("lon").between(lomin, lomax))


def with_key(df: DataFrame, key: str = "icao24") -> DataFrame:
    """Rows whose key is neither null nor empty."""
    return df.where(F.col(key) != "")


def updated_since(df: DataFrame, as_of: Column, max_age: str = "5 minutes", time: str = "updated_at_utc") -> DataFrame:
    """Rows updated no longer than ``max_age`` before ``as_of``."""
    return df.where(F.col(time) >= as_of - F.expr(f"INTERVAL {max_age}"))
