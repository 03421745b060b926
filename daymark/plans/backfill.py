"""The daily results for every stored date in one job each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daymark import catalog, schemas
from daymark.operators import compare_all_dates, conform, latest_capture, refine, summarise
from daymark.sinks import write_partitioned, write_refined
from daymark.sources import layout, read_refined


def refine_dates(spark: SparkSession, raw_root: str, stored_as: str = "partitions") -> DataFrame:
    """Refined rows of the newest capture of each date."""
    rows = layout(stored_as).all_dates(spark, raw_root)
    return refine(latest_capture(rows)).drop(schemas.CAPTURE_COL)


def summarise_dates(spark: SparkSession, raw_root: str, stored_as: str = "partitions") -> DataFrame:
    return summarise(refine_dates(spark, raw_root, stored_as))


def compare_dates(
    spark: SparkSession, raw_root: str, back: int = 2, stored_as: str = "partitions"
) -> DataFrame:
    """Each date compared with the one ``back`` positions earlier; the dates come from the listing."""
    dates = layout(stored_as).dates(spark, raw_root)
    return compare_all_dates(refine_dates(spark, raw_root, stored_as), dates, back)


def store_backfill(
    spark: SparkSession,
    raw_root: str,
    base: str,
    back: int = 2,
    database: str | None = None,
    stored_as: str = "partitions",
) -> None:
    """Both results of all dates that ``raw_root`` has, under ``base``. Raw rows are parsed once.

    Results of dates that the raw root no longer has stay, and so do leaves of a rebuilt
    date that it has no rows for. A raw file without a column's header fails the job, and
    no result is touched. With a ``database`` the summary table there shows all
    of them afterwards.
    """
    by_date = [schemas.DATE_COL]
    refined_path, summary_path = f"{base}/refined/all", f"{base}/results/summary_all"
    comparison_path = f"{base}/results/comparison_all"
    # Stored rows are read date by date, so these are written without a shuffle.
    write_partitioned(refine_dates(spark, raw_root, stored_as), refined_path, by_date, False, True)
    refined = read_refined(spark, refined_path, schemas.REFINED_SCHEMA)
    write_refined(conform(summarise(refined), schemas.SUMMARY_SCHEMA), summary_path)
    comparison = compare_all_dates(refined, layout(stored_as).dates(spark, raw_root), back)
    write_refined(conform(comparison, schemas.DATES_COMPARISON_SCHEMA), comparison_path)
    for stored, path, partitions in (
        (summary_path, f"{base}/agrupamento", schemas.SUMMARY_PARTITIONS),
        (comparison_path, f"{base}/comparacao_datas", by_date),
    ):
        write_partitioned(read_refined(spark, stored), path, partitions)
    if database:
        catalog.ensure_database(spark, database)
        catalog.register_external(
            spark,
            database,
            schemas.SUMMARY_TABLE,
            schemas.SUMMARY_SCHEMA,
            f"{base.rstrip('/')}/agrupamento",
            schemas.SUMMARY_PARTITIONS,
        )
