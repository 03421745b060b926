"""Row counts of a run, taken while the run's own action passes over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def quality_metrics() -> list[Column]:
    """Rows in all, and rows whose quantity or participation could not be read."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("qt_teorica").isNull()).alias("bad_qt"),
        F.count_if(F.col("pc_participacao").isNull()).alias("bad_pc"),
    ]


def observe_refined(df: DataFrame, observation: Observation) -> DataFrame:
    """Attach the metrics to refined rows; read them from ``observation.get`` after the action."""
    return df.observe(observation, *quality_metrics())
