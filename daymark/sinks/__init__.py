from daymark.sinks.files import (
    append_capture,
    gather_leaves,
    replace_date,
    write_captures,
    write_partitioned,
    write_refined,
)

__all__ = [
    "append_capture",
    "gather_leaves",
    "replace_date",
    "write_captures",
    "write_partitioned",
    "write_refined",
]
