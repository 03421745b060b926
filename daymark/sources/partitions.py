"""Which snapshot dates exist, and which of them a run is about."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daymark.functions import partition_date
from daymark.local import local_frame
from daymark.schemas import DATE_COL

EIGHT_DIGITS = "[0-9]" * 8
PATH_SCHEMA = StructType([StructField("path", StringType())])


def date_glob(root: str) -> str:
    """The directories of all snapshot dates; anything else under the root is left alone."""
    return f"{root.rstrip('/')}/{DATE_COL}={EIGHT_DIGITS}"


def is_absent(error: AnalysisException) -> bool:
    """Whether a read failed because there is no directory, or no file in it."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def list_partitions(spark: SparkSession, root: str, strict: bool = False) -> DataFrame:
    """The dates that have a directory.

    One listing of the root, by the Hadoop file system the root belongs to: the
    files of the dates are neither listed nor opened, and the driver sees one path
    per date.
    """
    glob = spark._jvm.org.apache.hadoop.fs.Path(date_glob(root))
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    paths = [(status.getPath().toString(),) for status in found or () if status.isDirectory()]
    if not paths:
        raise ValueError(f"no snapshot partitions under {root}")
    dates = local_frame(spark, paths, PATH_SCHEMA).select(
        partition_date("path", strict).alias(DATE_COL)
    )
    return dates.where(F.col(DATE_COL).isNotNull())


def list_table_partitions(spark: SparkSession, table: str, strict: bool = False) -> DataFrame:
    """The dates of a table partitioned by date, from the catalog alone."""
    partitions = spark.sql(f"SHOW PARTITIONS {table}")
    dates = partitions.select(partition_date("partition", strict).alias(DATE_COL))
    return dates.where(F.col(DATE_COL).isNotNull()).distinct()


def pick_partitions(dates: DataFrame, back: int = 2) -> DataFrame:
    """One row: ``d0``, the newest date, and ``d2``, the one ``back`` positions before it.

    Positions, not calendar days. ``d2`` is empty if there are too few dates; no date
    at all fails the query. Only the newest ``back + 1`` dates leave their tasks.
    """
    newest = dates.select(DATE_COL).distinct().orderBy(F.desc(DATE_COL)).limit(back + 1)
    return newest.agg(
        F.when(F.count(DATE_COL) == 0, F.raise_error(F.lit("no snapshot partition found")))
        .otherwise(F.max(DATE_COL))
        .alias("d0"),
        F.when(F.count(DATE_COL) > back, F.min(DATE_COL)).otherwise("").alias("d2"),
    )


def latest_dates(
    spark: SparkSession, root: str, back: int = 2, dates: DataFrame | None = None
) -> tuple[str, str]:
    """The two dates a run is about, of the root's or of ``dates``; all that reaches the driver."""
    listed = list_partitions(spark, root) if dates is None else dates
    return tuple(pick_partitions(listed, back).first())
