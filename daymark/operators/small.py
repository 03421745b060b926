"""Broadcasting behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from daymark.local import local_frame

# One row per snapshot date is 270 years of daily dates, a few megabytes.
MAX_BROADCAST_ROWS = 100_000


def small_rows(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> list[Row] | None:
    """The rows of ``df``, or None if there are more than ``max_rows``.

    At most ``max_rows + 1`` rows reach the driver.
    """
    rows = df.limit(max_rows + 1).collect()
    return None if len(rows) > max_rows else rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is small, else as it is, for a shuffled join.

    A small result holds the values themselves, so the query that gave them does not
    run again in the join.
    """
    rows = small_rows(df, max_rows)
    return df if rows is None else F.broadcast(local_frame(df.sparkSession, rows, df.schema))
