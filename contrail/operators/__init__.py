"""Operators: each takes DataFrames and returns DataFrames, in batch and in streams."""

from contrail.operators.aggregates import airspace_grid_5m, telemetry_quality_5m, traffic_5m, traffic_hourly
from contrail.operators.counters import dlq_counts, ingest_counters, observe_ingest, running_total
from contrail.operators.dedupe import accepted_last, clock_seconds, dedupe_ttl, dedupe_within_watermark
from contrail.operators.filters import updated_since, with_key, with_position, within_bbox
from contrail.operators.ingest import (
    explode_state_vectors, normalize_vectors, route_events, vector_fields, vector_from_text, with_event_times,
)
from contrail.operators.latest import (
    absent_rows, insert_if_absent, latest_per_key, latest_state, merge_state, to_state_rows,
)
from contrail.operators.messages import (
    dead_letter, parse_events, parse_json, parse_readings, to_dead_letter_messages, to_event_messages, with_event_text,
)
from contrail.operators.views import (
    airspace_density, latest_window, live_kpis, live_positions, quality_headline, quality_history, to_imperial, top_k,
)

__all__ = [
    "absent_rows", "accepted_last", "airspace_density", "airspace_grid_5m", "clock_seconds", "dead_letter",
    "dedupe_ttl", "dedupe_within_watermark", "dlq_counts", "explode_state_vectors", "ingest_counters",
    "insert_if_absent", "latest_per_key", "latest_state", "latest_window", "live_kpis", "live_positions",
    "merge_state", "normalize_vectors", "observe_ingest", "parse_events", "parse_json", "parse_readings",
    "quality_headline", "quality_history", "route_events", "running_total", "telemetry_quality_5m",
    "to_dead_letter_messages", "to_event_messages", "to_imperial", "to_state_rows", "top_k", "traffic_5m",
    "traffic_hourly", "updated_since", "vector_fields", "vector_from_text", "with_event_text", "with_event_times",
    "with_key", "with_position", "within_bbox",
]
