"""Raw files as they land, each once, with a record that doesn't grow with the files.

The record has one row per date: how many of its files were read, and a hash of their names that
doesn't depend on their order. A date whose listing gives the same number and hash has nothing new,
however many files it has, and only that row is looked at. The names themselves are stored under
their date, and read only for dates where something is new: a file that comes late, for a date
long done, is told from those read before, and read alone.

A lot of new files is written to a directory of its own under each date, and its names beside it; the
record is written last. A run that broke off has shown rows only if it had written the record, since
readers ask the record which lots there are; the next run writes the same lot again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daymark import schemas
from daymark.functions import partition_date
from daymark.local import local_frame
from daymark.operators import refine
from daymark.operators.small import broadcast_if_small, small_rows
from daymark.schemas import CAPTURE_COL, DATE_COL
from daymark.sinks.files import hadoop
from daymark.sources.partitions import date_glob, is_absent
from daymark.sources.raw import checked_headers, marking_schema

LOT_COL = "lote"
# Names of so many new files pass through the driver in one lot.
MAX_FILES_PER_LOT = 10_000
RECORD_SCHEMA = StructType(
    [
        StructField(DATE_COL, StringType()),
        StructField("files", LongType()),
        StructField("mark", LongType()),
    ]
)
NAMES_SCHEMA = StructType(
    [StructField("file", StringType()), StructField(LOT_COL, LongType()), StructField(DATE_COL, StringType())]
)
ROWS_SCHEMA = StructType(
    [*schemas.REFINED_SCHEMA.fields[:-1], StructField(CAPTURE_COL, schemas.DoubleType()), StructField(DATE_COL, StringType())]
)


class Landed(NamedTuple):
    """What a run did: lots written, files read, and dates that had any."""

    lots: int
    files: int
    dates: int


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(dt_ptcm, file, path) of the files that have landed; none is opened."""
    listed = spark.read.format("binaryFile").load(f"{date_glob(landing)}/[!_.]*")
    return listed.select(
        partition_date("path").alias(DATE_COL), F.substring_index("path", "/", -1).alias("file"), "path"
    )


def _marked(files: DataFrame) -> DataFrame:
    """The record of (dt_ptcm, file)."""
    marks = F.count("*").alias("files"), F.bit_xor(F.xxhash64("file")).alias("mark")
    return files.groupBy(DATE_COL).agg(*marks)


def last_lot(spark: SparkSession, out: str) -> int:
    """The number of the last lot that is on record; 0 if there is none."""
    path, files = hadoop(spark, f"{out.rstrip('/')}/_lotes/[0-9]*/_SUCCESS")
    found = files.globStatus(path) or ()
    return max((int(s.getPath().getParent().getName()) for s in found), default=0)


def record(spark: SparkSession, out: str, lot: int | None = None) -> DataFrame:
    """RECORD_SCHEMA as of a lot, or of the last one: one row for each date that was read."""
    lot = last_lot(spark, out) if lot is None else lot
    if not lot:
        return local_frame(spark, [], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).parquet(f"{out.rstrip('/')}/_lotes/{lot}")


def _absent_as_empty(read, spark: SparkSession, schema: StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if not is_absent(error):
            raise
    return local_frame(spark, [], schema)


def new_files(spark: SparkSession, landing: str, out: str) -> DataFrame:
    """(dt_ptcm, file, path) of the files that no lot on record has."""
    out, lot = out.rstrip("/"), last_lot(spark, out)
    files = landed_files(spark, landing)
    before = record(spark, out, lot)
    same = ["files", "mark", DATE_COL]
    # One row per date.
    changed = small_rows(_marked(files).join(before, same, "left_anti").select(DATE_COL))
    if changed is None:
        touched = files
        names_at = [f"{out}/_nomes"]
    else:
        dates = [row[DATE_COL] for row in changed]
        touched = files.where(F.col(DATE_COL).isin(dates))
        known = {row[DATE_COL] for row in before.where(F.col(DATE_COL).isin(dates)).collect()}
        names_at = [f"{out}/_nomes/{DATE_COL}={dt}" for dt in sorted(known)]
    if not names_at:
        return touched
    reader = spark.read.schema(NAMES_SCHEMA).option("basePath", f"{out}/_nomes")
    names = _absent_as_empty(lambda: reader.parquet(*names_at), spark, NAMES_SCHEMA)
    read = names.where(F.col(LOT_COL) <= lot).select(DATE_COL, "file")
    return touched.join(read, [DATE_COL, "file"], "left_anti")


def ingest_landed(
    spark: SparkSession, landing: str, out: str, max_files_per_lot: int = MAX_FILES_PER_LOT
) -> Landed:
    """Refine the files that landed since the last run, in lots. A file without a column's header
    fails its lot, of which nothing shows."""
    out = out.rstrip("/")
    lots = files = 0
    dates: set[str] = set()
    while True:
        fresh = new_files(spark, landing, out).orderBy(DATE_COL, "file").limit(max_files_per_lot).collect()
        if not fresh:
            return Landed(lots, files, len(dates))
        lot = last_lot(spark, out) + 1
        _write_lot(spark, landing, out, lot, fresh)
        lots, files = lots + 1, files + len(fresh)
        dates |= {row[DATE_COL] for row in fresh}


def _write_lot(spark: SparkSession, landing: str, out: str, lot: int, fresh: list) -> None:
    number = F.lit(lot).cast("long").alias(LOT_COL)
    by = [DATE_COL, LOT_COL]
    reader = spark.read.schema(marking_schema(spark)).option("basePath", landing)
    rows = refine(checked_headers(reader.parquet(*[row["path"] for row in fresh])))

    def write(df: DataFrame, path: str) -> None:
        # What a run that broke off has left of this lot goes.
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    write(rows.select(*[F.col(c) for c in ROWS_SCHEMA.names], number), f"{out}/linhas")
    listed = [(row["file"], lot, row[DATE_COL]) for row in fresh]
    names = local_frame(spark, listed, NAMES_SCHEMA)
    write(names, f"{out}/_nomes")
    # Marks of disjoint sets of names add up.
    both = record(spark, out, lot - 1).unionByName(_marked(names))
    now = both.groupBy(DATE_COL).agg(F.sum("files").alias("files"), F.bit_xor("mark").alias("mark"))
    now.select(*RECORD_SCHEMA.names).write.mode("overwrite").parquet(f"{out}/_lotes/{lot}")


def read_landed(spark: SparkSession, out: str, dt: str | None = None) -> DataFrame:
    """ROWS_SCHEMA of all lots on record, of all dates or of one."""
    out, lot = out.rstrip("/"), last_lot(spark, out)
    schema = StructType([*ROWS_SCHEMA.fields, StructField(LOT_COL, LongType())])
    reader = spark.read.schema(schema).option("basePath", f"{out}/linhas")
    path = f"{out}/linhas/{DATE_COL}={dt}" if dt else f"{out}/linhas"
    rows = _absent_as_empty(lambda: reader.parquet(path), spark, schema)
    return rows.where(F.col(LOT_COL) <= lot).select(*ROWS_SCHEMA.names)


def record_by_listing(spark: SparkSession, landing: str) -> DataFrame:
    """What the record of a landing directory is when all of its files have been read."""
    return broadcast_if_small(_marked(landed_files(spark, landing)))
