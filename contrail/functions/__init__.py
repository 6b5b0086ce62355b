"""Column-level rules. Every function takes and returns Columns and stays inside the JVM."""

from contrail.functions.grid import bbox_id, grid_cell, split_grid_cell
from contrail.functions.rules import (
    event_key, has_position, in_range, normalize_altitude, normalize_callsign, normalize_id, suspicious_altitude,
)
from contrail.functions.times import clock_text, epoch_to_iso, lag_seconds, parse_utc, to_iso
from contrail.functions.units import METRIC_TO_IMPERIAL, display_round, to_imperial_column

__all__ = [
    "METRIC_TO_IMPERIAL", "bbox_id", "clock_text", "display_round", "epoch_to_iso", "event_key",
    "grid_cell", "has_position", "in_range", "lag_seconds", "normalize_altitude",
    "normalize_callsign", "normalize_id", "parse_utc", "split_grid_cell", "suspicious_altitude", "to_imperial_column",
    "to_iso",
]
