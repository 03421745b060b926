"""Parquet sinks."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.local import local_frame
from daymark.operators.small import small_rows
from daymark.schemas import CAPTURE_COL, DATE_COL, SUMMARY_PARTITIONS
from daymark.sources.partitions import is_absent

# A task opens one file after the other, so small leaves are limited by their number.
LEAVES_PER_TASK = 32
# A leaf with more rows than this is written by several tasks.
ROWS_PER_TASK = 2_000_000
# Leaves that make up more than this get tasks of their own: with four for each leaf, few hashes
# fall together.
ROWS_TO_SPREAD = 100_000
TASKS_PER_LEAF = 4
# Holds a marker file per stored capture; readers leave out what begins so.
CLAIMS = "_captures"


def write_refined(df: DataFrame, path: str) -> None:
    """Replace the whole directory. An empty frame still leaves its schema there."""
    df.write.mode("overwrite").parquet(path)


class Leaves(NamedTuple):
    """How many leaf partitions rows have, their rows, and those of the largest."""

    number: int
    rows: int
    largest: int


def count_leaves(df: DataFrame, partitions: Sequence[str]) -> Leaves:
    """Reads only the partition columns; a leaf leaves each task as one row."""
    leaves = df.groupBy(*partitions).agg(F.count("*").alias("_rows"))
    none = F.lit(0)
    return Leaves(
        *leaves.agg(
            F.count("*"), F.coalesce(F.sum("_rows"), none), F.coalesce(F.max("_rows"), none)
        ).first()
    )


def gather_leaves(
    df: DataFrame,
    partitions: Sequence[str],
    leaves: Leaves | None = None,
    leaves_per_task: int = LEAVES_PER_TASK,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Bring the rows of a leaf partition together, so that it gets few files.

    Many small leaves need many tasks, however few bytes they hold, and so do leaves of many
    rows. A leaf too large for one task is left to adaptive execution, which splits it by size.
    """
    columns = list(partitions)
    leaves = leaves or count_leaves(df, columns)
    if not leaves.number:
        return df
    apart = min(leaves.rows / ROWS_TO_SPREAD, TASKS_PER_LEAF * leaves.number)
    tasks = ceil(max(leaves.number / leaves_per_task, leaves.rows / rows_per_task, apart))
    if leaves.largest <= rows_per_task:
        return df.repartition(tasks, *columns)
    large = (
        df.groupBy(*columns)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rows_per_task)
        .select(*[F.col(c).alias(f"_large_{c}") for c in columns])
    )
    known = small_rows(large)
    if known is None:
        return df.hint("rebalance", *columns)
    large = F.broadcast(local_frame(df.sparkSession, known, large.schema))
    same = reduce(
        Column.__and__, [F.col(c).eqNullSafe(F.col(f"_large_{c}")) for c in columns]
    )
    return (
        df.join(large, same, "left_anti")
        .repartition(tasks, *columns)
        .unionByName(df.join(large, same, "left_semi").hint("rebalance", *columns))
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = SUMMARY_PARTITIONS,
    gather: bool = True,
    whole: bool = False,
) -> None:
    """Replace only the leaf partitions that ``df`` has rows for, or the ``whole`` table.

    A leaf that an earlier run wrote and ``df`` has no rows for stays; ``replace_date``
    removes such leaves. Null and empty partition values both read back as null.
    ``df`` is read twice, first to count its leaves. Without ``gather`` it is not, and
    there is no shuffle, for rows that are read leaf by leaf anyway.
    """
    if gather:
        df = gather_leaves(df, partitions)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def replace_date(
    df: DataFrame, path: str, dt: str, partitions: Sequence[str] = SUMMARY_PARTITIONS
) -> None:
    """Replace everything stored for one date by the rows ``df`` has for it."""
    date_col, *inner = partitions
    day = df.where(F.col(date_col) == dt).drop(date_col)
    write_partitioned(day, f"{path.rstrip('/')}/{date_col}={dt}", inner, whole=True)


def hadoop(spark: SparkSession, path: str):
    """(path, file system) of the Hadoop file system that the path belongs to."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _refuse_stored(spark: SparkSession, root: str, dates: Sequence[str], capture_ts: float) -> None:
    """Fail if a capture of this time is stored under one of the dates. No other date is listed."""
    time = F.lit(capture_ts)
    for dt in dates:
        try:
            stored = spark.read.schema(f"{CAPTURE_COL} double").parquet(f"{root}/{DATE_COL}={dt}")
        except AnalysisException as error:
            if is_absent(error):
                continue
            raise
        if stored.where(F.col(CAPTURE_COL) == time).limit(1).count():
            raise ValueError(f"a capture of this time is already stored under {root} for {dt}")


def _claim(spark: SparkSession, root: str, dates: Sequence[str], capture_ts: float) -> list[str]:
    """Markers of this capture, one per date, each created by one run only."""
    claimed: list[str] = []
    for dt in dates:
        marker = f"{root}/{CLAIMS}/{dt}-{capture_ts!r}"
        path, files = hadoop(spark, marker)
        if not files.createNewFile(path):
            _release(spark, claimed)
            raise ValueError(
                f"a capture of this time is stored, being stored or broken off under {root} for "
                f"{dt}; to store it all the same, remove {marker}"
            )
        claimed.append(marker)
    return claimed


def _release(spark: SparkSession, markers: Sequence[str]) -> None:
    for marker in markers:
        path, files = hadoop(spark, marker)
        files.delete(path, False)


def append_capture(
    df: DataFrame, root: str, capture_ts: float, dates: Sequence[str] | None = None
) -> None:
    """Add one capture, under ``dt_ptcm`` if ``df`` has it, else under the capture's own day.

    The day is taken in the session time zone; of rows with ``dt_ptcm``, ``dates`` may say
    which ones there are. Earlier captures are never touched. A time that is stored already
    for one of the dates is refused, so that a repeated run adds nothing, and of two runs with
    the same time only one stores it: each date is claimed by a marker file first. Only the
    directories of these dates are looked at. Rows are written from the tasks that hold them,
    without a shuffle.
    """
    spark, root, capture_ts = df.sparkSession, root.rstrip("/"), float(capture_ts)
    if DATE_COL not in df.columns:
        day = F.date_format(F.timestamp_seconds(F.lit(capture_ts)), "yyyyMMdd")
        dates = [spark.range(1).select(day.alias(DATE_COL)).first()[0]]
        df = df.withColumn(DATE_COL, F.lit(dates[0]))
    elif dates is None:
        # One row per date.
        dates = [row[0] for row in df.select(DATE_COL).where(f"{DATE_COL} IS NOT NULL").distinct().collect()]
    dates = sorted(dates)
    _refuse_stored(spark, root, dates, capture_ts)
    claimed = _claim(spark, root, dates, capture_ts)
    rows = df.withColumn(CAPTURE_COL, F.lit(capture_ts))
    try:
        rows.write.mode("append").partitionBy(DATE_COL).parquet(root)
    except Exception:
        _release(spark, claimed)
        raise


def write_captures(df: DataFrame, prefix: str) -> None:
    """Store captures, rows with ``dt_ptcm`` and ``capture_ts``, as ``PREFIX/YYYYMMDD/<time>.parquet``.

    They are written aside first, and each file is moved into its place when all are complete.
    The further files of a large capture have numbers. A capture that is there already is
    refused, before anything is moved. The number of files passes through the driver.
    """
    spark, prefix = df.sparkSession, prefix.rstrip("/")
    aside = f"{prefix}/_storing-{uuid.uuid4().hex}"
    df.write.partitionBy(DATE_COL, CAPTURE_COL).parquet(aside)
    moves, parts = [], Counter()
    written = spark.read.format("binaryFile").load(f"{aside}/{DATE_COL}=*/{CAPTURE_COL}=*/*.parquet")
    for row in written.select("path").orderBy("path").toLocalIterator():
        day, time = (part.split("=", 1)[1] for part in row["path"].split("/")[-3:-1])
        number = parts[day, time]
        parts[day, time] += 1
        name = f"{float(time)!r}" + (f"-{number}" if number else "")
        moves.append((row["path"], f"{prefix}/{day}/{name}.parquet"))
    for _, to in moves:
        path, files = hadoop(spark, to)
        if files.exists(path):
            raise ValueError(f"a capture is already stored as {to}")
    for source, to in moves:
        path, files = hadoop(spark, to)
        files.mkdirs(path.getParent())
        if not files.rename(hadoop(spark, source)[0], path):
            raise ValueError(f"{source} could not be moved to {to}")
    path, files = hadoop(spark, aside)
    files.delete(path, True)
