"""Captures as they are stored one by one: ``PREFIX/YYYYMMDD/<epoch seconds>.parquet``.

A capture of several files has their numbers behind its time: ``<epoch seconds>-<number>.parquet``. The date and the time of a capture are only in its path. Both become columns, and both choose the
files before any is opened: the directories of other dates aren't listed, and of a date's captures
only the newest is read.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymark.local import local_frame
from daymark.operators.small import small_rows
from daymark.schemas import CAPTURE_COL, DATE_COL, RAW_SCHEMA
from daymark.sources.partitions import EIGHT_DIGITS, is_absent
from daymark.sources.raw import checked_headers, marking_schema

FILE_SCHEMA = StructType([f for f in RAW_SCHEMA if f.name not in (CAPTURE_COL, DATE_COL)])
CAPTURE_NAME = "[0-9]*.parquet"


def _time(path: Column) -> Column:
    return F.regexp_extract(path, r"/([0-9.]+)(-[0-9]+)?\.parquet$", 1).try_cast("double").alias(CAPTURE_COL)


def _date(path: Column) -> Column:
    return F.regexp_extract(path, r"/([0-9]{8})/[^/]*$", 1).alias(DATE_COL)


def list_capture_dates(spark: SparkSession, prefix: str) -> DataFrame:
    """The dates that have a directory; one listing of the prefix, no file is listed."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{prefix.rstrip('/')}/{EIGHT_DIGITS}")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    dates = [(status.getPath().getName(),) for status in found or () if status.isDirectory()]
    if not dates:
        raise ValueError(f"no captures under {prefix}")
    return local_frame(spark, dates, StructType([RAW_SCHEMA[DATE_COL]]))


def list_captures(spark: SparkSession, prefix: str, dt: str | None = None) -> DataFrame:
    """(dt_ptcm, capture_ts, path) of every capture, or of those of one date; no file is opened."""
    files = spark.read.format("binaryFile").load(f"{prefix.rstrip('/')}/{dt or EIGHT_DIGITS}/{CAPTURE_NAME}")
    path = F.col("path")
    listed = files.select(_date(path), _time(path), "path")
    return listed.where(F.col(CAPTURE_COL).isNotNull())


def newest_captures(captures: DataFrame) -> DataFrame:
    """Of each date the captures with the latest time, ties included."""
    newest = captures.groupBy(DATE_COL).agg(F.max(CAPTURE_COL).alias(CAPTURE_COL))
    return captures.join(newest, [DATE_COL, CAPTURE_COL], "left_semi")


def _read(spark: SparkSession, *paths: str) -> DataFrame:
    rows = spark.read.schema(marking_schema(spark, FILE_SCHEMA)).parquet(*paths)
    path = F.col("_metadata.file_path")
    # The path goes along as a column of its own, the hidden one doesn't outlive the check.
    rows = checked_headers(rows.select("*", path.alias("_path")), F.col("_path"))
    columns = [F.col(f"`{name}`") for name in FILE_SCHEMA.names]
    return rows.select(*columns, _time(F.col("_path")), _date(F.col("_path")))


def read_capture_files(spark: SparkSession, prefix: str) -> DataFrame:
    """The rows of all captures of all dates."""
    return _read(spark, f"{prefix.rstrip('/')}/{EIGHT_DIGITS}")


def read_captures(spark: SparkSession, prefix: str, dt: str | None = None) -> DataFrame:
    """The rows of the newest capture of each date, or of one date. No other file is opened."""
    if dt is not None and not re.fullmatch(EIGHT_DIGITS, dt):
        raise ValueError(f"not a snapshot date: {dt!r}")
    # As many paths as dates, ties aside.
    chosen = small_rows(newest_captures(list_captures(spark, prefix, dt)).select("path"))
    if chosen is None:
        return read_capture_files(spark, prefix)
    if not chosen:
        return local_frame(spark, [], RAW_SCHEMA)
    return _read(spark, *sorted(row["path"] for row in chosen))


def read_captures_or_empty(spark: SparkSession, prefix: str, dt: str) -> DataFrame:
    """``read_captures`` of a date, or no rows if the date is "" or not there."""
    if dt:
        try:
            return read_captures(spark, prefix, dt)
        except AnalysisException as error:
            if not is_absent(error):
                raise
    return local_frame(spark, [], RAW_SCHEMA)
