"""What earlier runs counted, and a run that stops when it counts far less.

Every stage of a run leaves one row per date: its run, and the metrics taken while its rows were
written. A run compares its counts with the median of the runs before; if the rows fall below a
share of that, or unreadable values rise above one of the rows, it stops before results are loaded.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daymark.local import local_frame
from daymark.schemas import DATE_COL
from daymark.sources.partitions import is_absent

HISTORY_SCHEMA = StructType(
    [
        StructField("run", StringType()),
        StructField("started", StringType()),
        StructField("stage", StringType()),
        StructField(DATE_COL, StringType()),
        StructField("n_rows", LongType()),
        StructField("bad_qt", LongType()),
        StructField("bad_pc", LongType()),
    ]
)
RUNS = 5
LEAST_SHARE = 0.5
MOST_BAD = 0.5


class SuspiciousRun(ValueError):
    """A run whose counts are far from those before."""


def new_run() -> tuple[str, str]:
    """An id for a run, and when it started."""
    return uuid.uuid4().hex, datetime.now(timezone.utc).isoformat()


def record_run(
    spark: SparkSession, base: str, run: tuple[str, str], stage: str, dt: str, metrics: dict[str, int]
) -> None:
    """Add what a stage of a run counted for a date to the history under ``base``."""
    counts = [metrics.get(name) for name in ("n_rows", "bad_qt", "bad_pc")]
    row = local_frame(spark, [(*run, stage, dt, *counts)], HISTORY_SCHEMA)
    row.write.mode("append").parquet(f"{base.rstrip('/')}/history")


def read_history(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(f"{base.rstrip('/')}/history")
    except AnalysisException as error:
        if not is_absent(error):
            raise
    return local_frame(spark, [], HISTORY_SCHEMA)


def compare_runs(
    history: DataFrame,
    runs: int = RUNS,
    least_share: float = LEAST_SHARE,
    most_bad: float = MOST_BAD,
    order_by: tuple[str, ...] = (DATE_COL, "started"),
) -> DataFrame:
    """``history`` with ``usual``, the median rows of up to ``runs`` runs of the stage before, and
    ``verdict``: ok, few rows, or unreadable. One row per run: its windows are small."""
    before = Window.partitionBy("stage").orderBy(*order_by).rowsBetween(-runs, -1)
    usual = F.percentile("n_rows", 0.5).over(before)
    bad = F.greatest(F.coalesce("bad_qt", F.lit(0)), F.coalesce("bad_pc", F.lit(0)))
    verdict = (
        F.when(F.col("n_rows") < least_share * F.col("usual"), "few rows")
        .when(bad > most_bad * F.col("n_rows"), "unreadable")
        .otherwise("ok")
    )
    return history.withColumn("usual", usual).withColumn("verdict", verdict)


def check_run(
    spark: SparkSession,
    base: str,
    run: tuple[str, str],
    runs: int = RUNS,
    least_share: float = LEAST_SHARE,
    most_bad: float = MOST_BAD,
) -> None:
    """Fail if a stage of the run counted far less than the runs before, or could not read much.

    Runs that failed this check don't count as usual, so that a second bad run fails as well.
    """
    history = read_history(spark, base)
    odd = compare_runs(history, runs, least_share, most_bad).where("verdict != 'ok'").select("run", "stage")
    usual = history.join(odd, ["run", "stage"], "left_anti")
    own = history.where(F.col("run") == run[0])
    rows = usual.where(F.col("run") != run[0]).unionByName(own)
    found = compare_runs(rows, runs, least_share, most_bad).where(F.col("run") == run[0])
    for row in found.where("verdict != 'ok'").orderBy("stage").collect():  # the run's own stages
        raise SuspiciousRun(
            f"{row['stage']} of {row[DATE_COL]}: {row['verdict']}, {row['n_rows']} rows "
            f"(usually {row['usual']}), {row['bad_qt']} and {row['bad_pc']} unreadable"
        )
