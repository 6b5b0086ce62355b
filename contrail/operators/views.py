"""The read queries over the three tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions import clock_text, display_round, split_grid_cell, to_imperial_column
from contrail.functions.units import METRIC_TO_IMPERIAL
from contrail.operators.filters import updated_since, with_position

POSITION_COLUMNS = (
    "icao24", "callsign", "lat", "lon", "altitude_m", "velocity_mps", "heading_deg", "updated_at_utc",
)


def live_positions(state: DataFrame, as_of: Column | None = None, max_age: str = "5 minutes") -> DataFrame:
    """Vehicles with a position. With ``as_of``, only those updated within ``max_age`` before it; a snapshot is
    read without, since its rows are old by nature."""
    located = with_position(state)
    if as_of is not None:
        located = updated_since(located, as_of, max_age)
    return located.select(*POSITION_COLUMNS)


def live_kpis(positions: DataFrame) -> DataFrame:
    """Number of live positions and the time of the last update; null, not the current time, when there are none."""
    return positions.agg(
        F.count(F.lit(1)).alias("tracked_aircraft"), F.max("updated_at_utc").alias("last_update_utc")
    ).withColumn("last_update_clock", clock_text(F.col("last_update_utc")))


def top_k(state: DataFrame, metric: str, k: int = 10) -> DataFrame:
    """The ``k`` vehicles with the greatest metric, missing values last, ties by id. Keeps ``k`` rows per task."""
    value = F.nanvl(F.col(metric), F.lit(None).cast("double"))
    return (
        state.select("icao24", "callsign", value.alias(metric))
        .orderBy(F.desc_nulls_last(metric), F.asc("icao24"))
        .limit(k)
    )


def latest_window(df: DataFrame, end: str = "window_end") -> DataFrame:
    """All rows of the newest window. The join side is a global aggregate, one row by construction."""
    newest = df.agg(F.max(end).alias(end))
    return df.join(F.broadcast(newest), end, "left_semi")


def airspace_density(grid: DataFrame) -> DataFrame:
    """Cells of the newest window, with their coordinates."""
    lat, lon = split_grid_cell(F.col("grid_cell"))
    return latest_window(grid).select(
        "grid_cell", "aircraft_count", "avg_altitude_m", lat.alias("grid_lat"), lon.alias("grid_lon")
    )


def quality_history(quality: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` newest quality windows, newest first."""
    return quality.orderBy(F.desc_nulls_last("window_end"), F.asc("window_start")).limit(n)


def quality_headline(quality: DataFrame) -> DataFrame:
    """The newest quality window."""
    return quality_history(quality, 1)


def to_imperial(df: DataFrame, rounded: bool = True) -> DataFrame:
    """Convert whichever metric columns the frame has, rounded as displayed unless told otherwise."""
    names = [c for c in [*METRIC_TO_IMPERIAL, "avg_altitude_m", "avg_velocity_mps"] if c in df.columns]
    converted = {}
    for name in names:
        value = to_imperial_column(name)
        converted[name] = display_round(value, name) if rounded else value
    return df.withColumns(converted)
