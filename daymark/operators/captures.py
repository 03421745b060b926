"""Choosing among several captures of one date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.local import local_frame
from daymark.operators.small import small_rows


def latest_capture(
    df: DataFrame, date_col: str = "dt_ptcm", capture_col: str = "capture_ts"
) -> DataFrame:
    """All rows of the newest capture of each date.

    The newest time per date is a small table: the rows themselves are filtered by
    a broadcast join and never shuffled. Rows without a capture time are kept for
    dates that have no other. Two cases need no join: rows without any capture times
    are all kept, and for a single date the time becomes a filter that reaches the scan.
    """
    per_date = df.groupBy(F.col(date_col).alias("_date")).agg(F.max(capture_col).alias("_newest"))
    rows = small_rows(per_date)
    newest = per_date
    if rows is not None:
        if all(row["_newest"] is None for row in rows):
            return df
        if len(rows) == 1:
            return df.where(F.col(capture_col) == rows[0]["_newest"])
        newest = F.broadcast(local_frame(df.sparkSession, rows, per_date.schema))
    return df.join(
        newest,
        F.col(date_col).eqNullSafe(F.col("_date"))
        & F.col(capture_col).eqNullSafe(F.col("_newest")),
        "left_semi",
    )
