"""Event-time window aggregates. Each function serves batch and streaming input unchanged.

All of them are partial/final hash aggregates, so a window or cell that holds a large share of the rows is reduced
on the map side and reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions import grid_cell, has_position, lag_seconds
from contrail.operators.filters import with_position


def _windowed(
    df: DataFrame, time: str, length: str, delay: str, keys: list[str], names: tuple[str, str],
    measures: dict[str, Column],
) -> DataFrame:
    """Group by tumbling window and ``keys``; the window struct is flattened to the two ``names``."""
    start, end = names
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, length).alias("_window"), *keys)
        .agg(*[measure.alias(name) for name, measure in measures.items()])
        .select(F.col("_window.start").alias(start), F.col("_window.end").alias(end), *keys, *measures)
    )


def airspace_grid_5m(df: DataFrame, delay: str = "10 minutes", approx_distinct: bool = False) -> DataFrame:
    """Messages, mean height and mean speed per grid cell and 5 minutes.

    ``aircraft_count`` counts messages with an id, so a vehicle seen 30 times counts 30. ``approx_distinct`` adds
    a sketch-based number of different vehicles.
    """
    measures = {
        "aircraft_count": F.count("icao24"),
        "avg_altitude_m": F.avg("altitude_m"),
        "avg_velocity_mps": F.avg("velocity_mps"),
    }
    if approx_distinct:
        measures["approx_distinct_aircraft"] = F.approx_count_distinct("icao24")
    located = with_position(df).withColumn("grid_cell", grid_cell(F.col("lat"), F.col("lon")))
    return _windowed(
        located, "event_ts", "5 minutes", delay, ["grid_cell"], ("window_start", "window_end"), measures
    )


def telemetry_quality_5m(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Message counts, position hit counts and mean lag per 5 minutes.

    ``total_messages`` counts rows with an id, the position counters count all rows.
    """
    located = has_position(F.col("lat"), F.col("lon"))
    measures = {
        "total_messages": F.count("icao24"),
        "messages_with_position": F.count_if(located),
        "messages_missing_position": F.count_if(~located),
        "avg_event_lag_seconds": F.avg(lag_seconds(F.col("ingestion_ts"), F.col("event_ts"))),
    }
    return _windowed(df, "event_ts", "5 minutes", delay, [], ("window_start", "window_end"), measures)


def traffic_hourly(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Mean reading per location and hour."""
    return _windowed(
        df, "timestamp", "1 hour", delay, ["location"], ("start_time", "end_time"),
        {"avg_traffic_count": F.avg("value")},
    )


def traffic_5m(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Mean, extremes and number of readings per location and 5 minutes."""
    measures = {
        "avg_traffic_count": F.avg("value"),
        "max_traffic_count": F.max("value"),
        "min_traffic_count": F.min("value"),
        "data_points": F.count("value"),
    }
    return _windowed(df, "timestamp", "5 minutes", delay, ["location"], ("start_time", "end_time"), measures)
