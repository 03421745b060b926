"""Raw snapshots: Parquet files under ``root/dt_ptcm=YYYYMMDD/``, in either header dialect.

A column that a file lacks would read as null. Here it reads as a mark instead, by way of the
default that Spark gives to columns added to a table later, so the scan that reads the rows also
sees, file by file, whether there was a header for each column: a file that has neither dialect's
header of a column that is asked for fails the query and is named. Cells that are null are fine.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from daymark.local import local_frame
from daymark.schemas import CAPTURE_COL, DATE_COL, HEADERS, RAW_SCHEMA, RENAMES
from daymark.sources.partitions import EIGHT_DIGITS, date_glob, is_absent

# What a column reads as that a file lacks: private characters, which no capture has.
ABSENT = "\ue000absent\ue001"


def marking_schema(spark: SparkSession, schema: StructType = RAW_SCHEMA) -> StructType:
    """``schema`` with the mark as the default of the header columns.

    Only Spark's vectorized reader fills in defaults reliably; without it columns that a
    file lacks read as null, as ever.
    """
    if spark.conf.get("spark.sql.parquet.enableVectorizedReader") != "true":
        return schema
    default = {"EXISTS_DEFAULT": f"'{ABSENT}'"}
    return StructType(
        [StructField(f.name, f.dataType, True, default if f.name in RENAMES else None) for f in schema]
    )


def _header(name: str) -> Column:
    return F.col(f"`{name}`")


def checked_headers(rows: DataFrame, file: Column | None = None) -> DataFrame:
    """Rows read with ``marking_schema``, marks as nulls; fails on a file without a column's header.

    Only columns that a query uses are looked at, so those that it doesn't use aren't read.
    """
    file = F.col("_metadata.file_path") if file is None else file
    columns = {}
    for pair in HEADERS.values():
        known = [name for name in pair if name in rows.columns]
        gone = [_header(name).eqNullSafe(ABSENT) for name in known]
        nowhere = gone[0] if len(gone) == 1 else gone[0] & gone[1]
        text = F.concat(F.lit("raw columns missing in "), file, F.lit(": " + " / ".join(pair)))
        for name, absent in zip(known, gone):
            columns[name] = F.when(nowhere, F.raise_error(text).cast("string")).when(
                ~absent, _header(name)
            )
    return rows.select(
        *[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in rows.columns]
    )


def audit_headers(spark: SparkSession, root: str) -> DataFrame:
    """(dt_ptcm, file, n_rows, missing) of every file with rows: the columns it has no header for.

    For a look at a root before its rows are asked for. Needs the vectorized reader.
    """
    rows = spark.read.schema(marking_schema(spark)).option("basePath", root).parquet(date_glob(root))
    lacks = [
        F.max(F.when(_header(a).eqNullSafe(ABSENT) & _header(b).eqNullSafe(ABSENT), f"{a} / {b}"))
        for a, b in HEADERS.values()
    ]
    files = rows.groupBy(DATE_COL, F.col("_metadata.file_path").alias("file"))
    found = files.agg(F.count("*").alias("n_rows"), F.array(*lacks).alias("missing"))
    return found.withColumn("missing", F.array_compact("missing"))


def _check_headers(spark: SparkSession, path: str) -> None:
    """Fail before any row is read if the file that Spark looks at has no dialect's headers."""
    found = set(spark.read.parquet(path).columns)
    missing = [" / ".join(headers) for headers in HEADERS.values() if not found & set(headers)]
    if missing:
        raise ValueError(f"raw columns missing in {path}: {', '.join(missing)}")


def read_snapshot(spark: SparkSession, root: str, dt: str) -> DataFrame:
    """The rows of one date. Only its directory is listed and read."""
    if not re.fullmatch(EIGHT_DIGITS, dt):
        raise ValueError(f"not a snapshot date: {dt!r}")
    path = f"{root.rstrip('/')}/{DATE_COL}={dt}"
    # The base path makes the directory name a column; the schema makes it a string.
    rows = spark.read.schema(marking_schema(spark)).option("basePath", root).parquet(path)
    _check_headers(spark, path)
    return checked_headers(rows)


def read_snapshot_or_empty(spark: SparkSession, root: str, dt: str) -> DataFrame:
    """``read_snapshot``, or no rows of the same schema if the date is "" or not there.

    Only absence is forgiven: files that cannot be read still fail.
    """
    if dt:
        try:
            return read_snapshot(spark, root, dt)
        except AnalysisException as error:
            if not is_absent(error):
                raise
    return local_frame(spark, [], RAW_SCHEMA)


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all dates; a filter on ``dt_ptcm`` reads only the dates it keeps."""
    rows = spark.read.schema(marking_schema(spark)).option("basePath", root)
    return checked_headers(rows.parquet(date_glob(root)))


