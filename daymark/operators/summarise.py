"""Summary of snapshots per instrument."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.schemas import DATE_COL, KEYS


def summarise(df: DataFrame) -> DataFrame:
    """One row per instrument and date: quantity sum, mean participation, row count.

    All three are algebraic, so each task aggregates before the shuffle and a
    frequent instrument arrives as one row per task. A sum beyond 64 bits is null.
    """
    return df.groupBy(*KEYS, DATE_COL).agg(
        F.try_sum("qt_teorica").alias("soma_qt_teorica"),
        F.avg("pc_participacao").alias("media_pc_participacao"),
        F.count("*").alias("qtd_registros"),
    )
