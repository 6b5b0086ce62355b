"""Metric to imperial display units."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Factor, and digits shown.
METRIC_TO_IMPERIAL = {
    "velocity_mps": (2.23694, 1),
    "altitude_m": (3.28084, 0),
    "vertical_rate_mps": (196.85, 1),
}
_SAME_UNIT_AS = {"avg_altitude_m": "altitude_m", "avg_velocity_mps": "velocity_mps"}


def _unit(name: str) -> tuple[float, int]:
    return METRIC_TO_IMPERIAL[_SAME_UNIT_AS.get(name, name)]


def to_imperial_column(name: str) -> Column:
    """m/s to mph, m to ft, m/s to ft/min, chosen by column name."""
    return F.col(name) * F.lit(_unit(name)[0])


def display_round(value: Column, name: str) -> Column:
    """Half-even rounding to the digits shown for this column."""
    return F.bround(value, _unit(name)[1])
