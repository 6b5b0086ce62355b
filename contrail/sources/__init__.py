"""Where rows come from and where they go."""

from contrail.sources.buckets import BucketedTarget
from contrail.sources.jdbc import JdbcTarget, merge_statement, read_jdbc_table, scan_options
from contrail.sources.messages import write_messages
from contrail.sources.positions import within_bbox_stored, write_positions
from contrail.sources.streams import read_event_stream, read_polls, stream_options
from contrail.sources.tables import (
    FolderTarget, conform, ensure_table, export_snapshots, load_table, read_snapshot, write_snapshot,
)

__all__ = [
    "BucketedTarget", "FolderTarget", "JdbcTarget", "conform", "ensure_table", "export_snapshots", "load_table", "merge_statement",
    "read_event_stream", "read_jdbc_table", "read_polls", "read_snapshot", "scan_options", "stream_options",
    "within_bbox_stored", "write_messages", "write_positions", "write_snapshot",
]
