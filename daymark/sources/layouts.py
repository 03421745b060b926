"""The two layouts that raw snapshots come in, behind the same four reads."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from daymark.sources import captured, partitions, raw


class Layout(NamedTuple):
    """Reads of a root: its dates, one date, one date that may be missing, and all dates."""

    dates: Callable[..., DataFrame]
    date: Callable[..., DataFrame]
    date_or_empty: Callable[..., DataFrame]
    all_dates: Callable[..., DataFrame]


LAYOUTS = {
    # ROOT/dt_ptcm=YYYYMMDD/<any>.parquet
    "partitions": Layout(
        partitions.list_partitions, raw.read_snapshot, raw.read_snapshot_or_empty, raw.read_snapshots
    ),
    # PREFIX/YYYYMMDD/<epoch seconds>.parquet
    "captures": Layout(
        captured.list_capture_dates,
        captured.read_captures,
        captured.read_captures_or_empty,
        captured.read_captures,
    ),
}


def layout(name: str) -> Layout:
    if name not in LAYOUTS:
        raise ValueError(f"no such layout: {name!r}; there are {', '.join(LAYOUTS)}")
    return LAYOUTS[name]
