"""Comparison of a snapshot with an earlier one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions import difference
from daymark.operators.hotkeys import ROWS_PER_TASK, spread_left_join
from daymark.operators.small import broadcast_if_small
from daymark.schemas import DATE_COL, KEYS


def _with_differences(joined: DataFrame, *columns: str) -> DataFrame:
    return joined.select(
        *columns,
        difference("qt_teorica", "_qt_before").alias("diferenca_qt_teorica"),
        difference("pc_participacao", "_pc_before").alias("diferenca_pc_participacao"),
    )


def compare_snapshots(
    d0: DataFrame,
    d2: DataFrame,
    keys: Sequence[str] = KEYS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every ``d0`` row with its differences to each ``d2`` row of the same keys.

    ``d0`` rows without a partner are kept with null differences, ``d2`` rows
    without one are dropped, null keys match nothing, and repeated keys multiply.
    """
    before = d2.select(
        *keys, F.col("qt_teorica").alias("_qt_before"), F.col("pc_participacao").alias("_pc_before")
    )
    now = d0.select(*keys, DATE_COL, "qt_teorica", "pc_participacao")
    joined = spread_left_join(now, before, keys, rows_per_task)
    return _with_differences(joined, *keys, DATE_COL)


def date_pairs(dates: DataFrame, back: int = 2) -> DataFrame:
    """``(dt_ptcm, dt_d2)`` per date, the second being ``back`` positions earlier or null.

    The window has no partitioning: it sees one row per date, not per snapshot row.
    """
    return (
        dates.select(DATE_COL)
        .distinct()
        .select(DATE_COL, F.lag(DATE_COL, back).over(Window.orderBy(DATE_COL)).alias("dt_d2"))
    )


def compare_all_dates(
    df: DataFrame,
    dates: DataFrame | None = None,
    back: int = 2,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``compare_snapshots`` for every date at once, each with the date ``back`` positions earlier.

    ``dates`` is the list of snapshot dates if it is known, for example from a
    listing; otherwise it is read from ``df``. The date is part of the join key, so
    rows meet only rows of their own pair of dates.
    """
    return compare_date_pairs(df, df, date_pairs(df if dates is None else dates, back), rows_per_task)


def compare_date_pairs(
    now: DataFrame, before: DataFrame, pairs: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows of ``now`` with their differences to those of ``before`` of the date that ``pairs``,
    (dt_ptcm, dt_d2), has for theirs. ``now`` and ``before`` may be some dates of one table."""
    pairs = broadcast_if_small(pairs)
    now = now.select(*KEYS, DATE_COL, "qt_teorica", "pc_participacao").join(pairs, DATE_COL, "left")
    before = before.select(
        F.col(DATE_COL).alias("dt_d2"),
        *KEYS,
        F.col("qt_teorica").alias("_qt_before"),
        F.col("pc_participacao").alias("_pc_before"),
    )
    joined = spread_left_join(now, before, ("dt_d2", *KEYS), rows_per_task)
    return _with_differences(joined, *KEYS, DATE_COL, "dt_d2")
