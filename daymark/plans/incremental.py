"""The results of all dates, kept up to date instead of built again.

A log has, for every date whose results are stored, the date it is compared with and a fingerprint of
its raw files, taken from their listing. An update lists the files again: dates that are new or whose
files changed are refined and summarised again; compared again are these, the dates that are compared
with them, and the dates that now have another date ``back`` positions earlier, because one came in
between. So a date that arrives late costs the work of ``back + 1`` dates, however many there are.

Results come first and the log last, so what a run that broke off has done is done once more.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from daymark import schemas
from daymark.functions import partition_date
from daymark.local import local_frame
from daymark.operators import (
    compare_date_pairs,
    conform,
    date_pairs,
    latest_capture,
    refine,
    summarise,
)
from daymark.operators.small import small_rows
from daymark.schemas import DATE_COL
from daymark.sinks import replace_date, write_partitioned, write_refined
from daymark.sources import list_partitions, read_refined, read_snapshots
from daymark.sources.partitions import date_glob, is_absent

LOG_SCHEMA = StructType(
    [
        StructField(DATE_COL, StringType()),
        StructField("dt_d2", StringType()),
        StructField("files", LongType()),
        StructField("mark", LongType()),
    ]
)


class Update(NamedTuple):
    """What an update did: dates refined, dates compared, and raw rows read."""

    refined: int
    compared: int
    rows: int


def raw_fingerprints(spark: SparkSession, raw_root: str) -> DataFrame:
    """(dt_ptcm, files, mark) of the dates that have files: their number, and a hash of their names,
    lengths and times. Only listed, no file is opened."""
    files = spark.read.format("binaryFile").load(f"{date_glob(raw_root)}/[!_.]*")
    listed = files.select(
        partition_date("path").alias(DATE_COL),
        F.xxhash64("path", "length", "modificationTime").alias("_one"),
    )
    return listed.groupBy(DATE_COL).agg(F.count("*").alias("files"), F.bit_xor("_one").alias("mark"))


def _log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as error:
        if not is_absent(error):
            raise
    return local_frame(spark, [], LOG_SCHEMA)


def plan_update(spark: SparkSession, raw_root: str, log: DataFrame, back: int = 2) -> DataFrame:
    """LOG_SCHEMA and (refine, compare) of every date: what must be done for it."""
    pairs = date_pairs(list_partitions(spark, raw_root), back)
    now = pairs.join(raw_fingerprints(spark, raw_root), DATE_COL, "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("files", "mark")]
    now = now.select(DATE_COL, "dt_d2", *counts)
    before = log.select(*[F.col(c).alias(f"_{c}") for c in log.columns])
    joined = now.join(before, F.col(DATE_COL) == F.col(f"_{DATE_COL}"), "left")
    same_files = F.col("files").eqNullSafe(F.col("_files")) & F.col("mark").eqNullSafe(F.col("_mark"))
    joined = joined.select(
        *LOG_SCHEMA.names,
        (~same_files).alias("refine"),
        (~F.col("dt_d2").eqNullSafe(F.col("_dt_d2"))).alias("moved"),
    )
    changed = joined.where("refine").select(F.col(DATE_COL).alias("_changed"))
    earlier = joined.join(changed, F.col("dt_d2") == F.col("_changed"), "left")
    again = F.col("refine") | F.col("moved") | F.col("_changed").isNotNull()
    return earlier.select(*LOG_SCHEMA.names, "refine", again.alias("compare"))


def update_results(spark: SparkSession, raw_root: str, base: str, back: int = 2) -> Update:
    """Bring the results that ``store_backfill`` writes up to date with the raw files.

    Of the raw root only the changed dates are read, of the refined rows these, the dates to be
    compared, and the dates these are compared with. Whatever is stored of a date that was stored
    before and has changed is replaced as a whole. Results of dates that the raw root no longer has
    stay, as in a backfill; they no longer count as positions.
    """
    base = base.rstrip("/")
    log_path, refined_path = f"{base}/refined/log", f"{base}/refined/all"
    log = _log(spark, log_path)
    # One row per date.
    rows = small_rows(plan_update(spark, raw_root, log, back))
    if rows is None:
        raise ValueError("too many dates for an update; run a backfill")
    refined = [r[DATE_COL] for r in rows if r["refine"]]
    compared = [(r[DATE_COL], r["dt_d2"]) for r in rows if r["compare"]]
    if not compared:
        return Update(0, 0, 0)
    # Dates that changed, and those that a run that broke off has stored.
    known = {r[0] for r in log.select(DATE_COL).collect()}
    seen = Observation()
    if refined:
        raw = read_snapshots(spark, raw_root).where(F.col(DATE_COL).isin(refined))
        fresh = refine(latest_capture(raw)).drop(schemas.CAPTURE_COL)
        fresh = fresh.observe(seen, F.count(F.lit(1)).alias("n_rows"))
        staged = _staged(fresh, f"{base}/refined/update")
        _put(staged, refined_path, [DATE_COL], [d for d in refined if d in known], gather=False)
    stored = read_refined(spark, refined_path, schemas.REFINED_SCHEMA)
    date = F.col(DATE_COL)
    if refined:
        summary = conform(summarise(stored.where(date.isin(refined))), schemas.SUMMARY_SCHEMA)
        staged = _staged(summary, f"{base}/results/summary_update")
        _put(staged, f"{base}/agrupamento", schemas.SUMMARY_PARTITIONS, [d for d in refined if d in known])
    pairs = local_frame(spark, compared, StructType(LOG_SCHEMA.fields[:2]))
    now = stored.where(date.isin([d for d, _ in compared]))
    before = stored.where(date.isin(sorted({d for _, d in compared if d})))
    result = conform(compare_date_pairs(now, before, pairs), schemas.DATES_COMPARISON_SCHEMA)
    staged = _staged(result, f"{base}/results/comparison_update")
    emptied = [d for d in refined if d in known]
    _put(staged, f"{base}/comparacao_datas", [DATE_COL], emptied)
    write_refined(
        local_frame(spark, [tuple(r[c] for c in LOG_SCHEMA.names) for r in rows], LOG_SCHEMA), log_path
    )
    return Update(len(refined), len(compared), seen.get["n_rows"] if refined else 0)


def _staged(rows: DataFrame, path: str) -> DataFrame:
    write_refined(rows, path)
    return read_refined(rows.sparkSession, path, rows.schema)


def _stale_dates(rows: DataFrame, path: str, partitions: Sequence[str], replaced: list[str]) -> list[str]:
    """Of ``replaced`` dates those with stored leaves that ``rows`` has nothing for."""

    def leaves(df: DataFrame) -> DataFrame:
        # Null and empty values are one leaf.
        values = [F.coalesce(c, F.lit("")).alias(c) for c in partitions]
        return df.where(F.col(DATE_COL).isin(replaced)).select(*values).distinct()

    try:
        stored = leaves(read_refined(rows.sparkSession, path, rows.schema))
        gone = stored.join(leaves(rows), list(partitions), "left_anti")
        # At most the replaced dates.
        return sorted(r[0] for r in gone.select(DATE_COL).distinct().collect())
    except AnalysisException as error:
        if not is_absent(error):
            raise
    return []


def _put(
    rows: DataFrame, path: str, partitions: Sequence[str], replaced: list[str], gather: bool = True
) -> None:
    """Write the leaves of ``rows``; of ``replaced`` dates everything else goes, rows or not.

    Leaves with rows are replaced all at once. Only dates with leaves that are left are
    replaced one by one.
    """
    stale = _stale_dates(rows, path, partitions, replaced) if replaced else []
    for dt in stale:
        if len(partitions) == 1:
            day = rows.where(F.col(DATE_COL) == dt).drop(DATE_COL)
            write_refined(day, f"{path}/{DATE_COL}={dt}")
        else:
            replace_date(rows, path, dt, partitions)
    others = rows.where(~F.coalesce(F.col(DATE_COL).isin(stale), F.lit(False))) if stale else rows
    write_partitioned(others, path, partitions, gather)
