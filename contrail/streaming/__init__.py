"""Micro-batch writers, stateful operators and the wiring of the running queries."""

from contrail.streaming.batches import (
    append_windows, best_effort, count_ingest, dedupe_stream, insert_absent_windows, publish, read_ingest_counts,
    replace_windows, upsert_state, write_routed,
)
from contrail.streaming.layer import ParsedLayer
from contrail.streaming.pipeline import (
    await_any, late_rows, start_ingest, start_pipeline, start_shared_pipeline, start_traffic,
)
from contrail.streaming.progress import ProgressLog, QueryFailed, await_queries
from contrail.streaming.stateful import apply_changes, dedupe_stateful, keep_live, live_changes, read_live

__all__ = [
    "ParsedLayer", "ProgressLog", "QueryFailed", "append_windows", "apply_changes", "await_any", "await_queries",
    "best_effort", "count_ingest", "dedupe_stateful", "dedupe_stream", "insert_absent_windows", "keep_live", "late_rows",
    "live_changes", "publish", "read_ingest_counts", "read_live", "replace_windows", "start_ingest", "start_pipeline",
    "start_shared_pipeline", "start_traffic", "upsert_state", "write_routed",
]
