"""Incremental refinement of raw files as they land."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from daymark.operators import refine
from daymark.schemas import DATE_COL
from daymark.sources.partitions import date_glob
from daymark.sources.raw import checked_headers, marking_schema

# A file is new if it was not read before, however old it is.
NEVER_TOO_OLD = "36500d"
# A backlog is taken in several batches, as the driver keeps the file names of one.
MAX_FILES_PER_BATCH = 10_000


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    max_files_per_batch: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Refine the files that landed since the last call, then stop.

    The checkpoint holds which files were read and the sink which batches were
    written, so a rerun adds nothing and a failed batch is not read twice from ``out``.
    Parsing is narrow: no state, no shuffle. All captures are kept, with their times.
    A file without a column's header fails its batch and is named; nothing of the batch
    shows in ``out``, and the next call tries again.
    """
    files = (
        spark.readStream.schema(marking_schema(spark))
        .option("basePath", landing)
        .option("maxFileAge", NEVER_TOO_OLD)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(date_glob(landing))
    )
    query = (
        refine(checked_headers(files))
        .writeStream.format("parquet")
        .partitionBy(DATE_COL)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return query
