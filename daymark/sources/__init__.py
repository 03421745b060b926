from daymark.sources.captured import (
    list_capture_dates,
    list_captures,
    newest_captures,
    read_capture_files,
    read_captures,
)
from daymark.sources.layouts import layout
from daymark.sources.partitions import (
    latest_dates,
    list_partitions,
    list_table_partitions,
    pick_partitions,
)
from daymark.sources.raw import (
    audit_headers,
    read_snapshot,
    read_snapshot_or_empty,
    read_snapshots,
)
from daymark.sources.refined import read_refined

__all__ = [
    "audit_headers",
    "latest_dates",
    "layout",
    "list_capture_dates",
    "list_captures",
    "list_partitions",
    "list_table_partitions",
    "newest_captures",
    "pick_partitions",
    "read_capture_files",
    "read_captures",
    "read_refined",
    "read_snapshot",
    "read_snapshot_or_empty",
    "read_snapshots",
]
