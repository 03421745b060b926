"""The daily jobs: capture, extract, transform, load, and the four steps for the newest date."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daymark import catalog, schemas
from daymark.operators import (
    apply_positional_schema,
    compare_snapshots,
    concat_pages,
    conform,
    html_table_rows,
    latest_capture,
    observe_refined,
    refine,
    summarise,
)
from daymark.plans import history
from daymark.sinks import append_capture, replace_date, write_partitioned, write_refined
from daymark.sources import latest_dates, layout, read_refined

logger = logging.getLogger(__name__)


def capture(
    pages: DataFrame,
    root: str,
    capture_ts: float,
    html_col: str = "html",
    check: bool = True,
    page_col: str | None = None,
) -> None:
    """Store the table rows of HTML pages as one capture, and log how many they are.

    ``pages`` may have ``dt_ptcm``. With a numeric ``page_col`` the rows of a date are
    numbered in page order, from 1, in the stored column ``row_no``. ``check`` is that of
    ``apply_positional_schema``; it reads the pages once more, before anything is written.
    """
    names = {schemas.DATE_COL, html_col, page_col}
    rows = html_table_rows(pages.select(*[c for c in pages.columns if c in names]), html_col)
    if page_col:
        date = F.col(schemas.DATE_COL) if schemas.DATE_COL in rows.columns else F.lit("")
        rows = concat_pages(rows.withColumn("_capture_date", date), "_capture_date", page_col)
        rows = rows.drop("_capture_date", page_col)
    shaped = apply_positional_schema(rows.drop("row_pos"), "cells", schemas.CAPTURE_NAMES, check)
    seen = Observation()
    shaped = shaped.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    dates = None
    if schemas.DATE_COL in pages.columns:  # those of the pages, before their text is looked at
        found = pages.select(schemas.DATE_COL).where(F.col(schemas.DATE_COL).isNotNull())
        dates = [row[0] for row in found.distinct().collect()]
    append_capture(shaped, root, capture_ts, dates)
    logger.info("captured %d rows", seen.get["n_rows"])


def extract(
    spark: SparkSession, raw_root: str, d0: str, d2: str, stored_as: str = "partitions"
) -> tuple[DataFrame, DataFrame]:
    """Refined rows of the newest capture of two dates; ``d2`` may be "" or missing.

    ``stored_as`` is the layout of the root: "partitions" or "captures".
    """
    reads = layout(stored_as)
    frames = reads.date(spark, raw_root, d0), reads.date_or_empty(spark, raw_root, d2)
    return tuple(refine(latest_capture(df)).drop(schemas.CAPTURE_COL) for df in frames)


def transform(d0: DataFrame, d2: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The summary of ``d0`` and its comparison with ``d2``."""
    return summarise(d0), compare_snapshots(d0, d2)


def load(
    summary: DataFrame,
    comparison: DataFrame,
    base: str,
    database: str,
    replaced_date: str | None = None,
) -> None:
    """Write both result tables under ``base`` and register them in ``database``.

    The summary is read twice, to count its partitions and to write them.
    ``replaced_date`` also removes what an earlier run stored for that date and this
    one does not have; rows of other dates are written as well. A summary without rows
    of that date is refused before anything is touched.

    Every load looks all partition directories up, so a table also shows what a load
    wrote that broke off before it could register it.
    """
    spark = summary.sparkSession
    base = base.rstrip("/")
    summary_path, comparison_path = f"{base}/agrupamento", f"{base}/comparacao"
    rows = conform(summary, schemas.SUMMARY_SCHEMA)
    if replaced_date:
        of_date = F.col(schemas.DATE_COL).eqNullSafe(F.lit(replaced_date))
        if not rows.where(of_date).limit(1).count():
            raise ValueError(f"the summary has no rows of {replaced_date!r}")
        others = rows.where(~of_date)
        replace_date(rows, summary_path, replaced_date)
        if others.limit(1).count():
            write_partitioned(others, summary_path)
    else:
        write_partitioned(rows, summary_path)
    write_refined(
        conform(comparison, schemas.COMPARISON_SCHEMA, schemas.COMPARISON_RENAMES), comparison_path
    )
    catalog.ensure_database(spark, database)
    catalog.register_external(
        spark,
        database,
        schemas.SUMMARY_TABLE,
        schemas.SUMMARY_SCHEMA,
        summary_path,
        schemas.SUMMARY_PARTITIONS,
    )
    catalog.register_external(
        spark, database, schemas.COMPARISON_TABLE, schemas.COMPARISON_SCHEMA, comparison_path
    )


def store_refined(
    spark: SparkSession,
    raw_root: str,
    d0: str,
    d2: str,
    base: str,
    stored_as: str = "partitions",
    run: tuple[str, str] | None = None,
) -> None:
    """``extract``, written under ``base``; what a ``run`` counts of its newest date is recorded."""
    for name, df in zip(("d0", "d2"), extract(spark, raw_root, d0, d2, stored_as)):
        seen = Observation()
        write_refined(observe_refined(df, seen), f"{base}/refined/{name}")
        logger.info("refined %s: %s", name, seen.get)
        if run and name == "d0":
            history.record_run(spark, base, run, "refined", d0, seen.get)


def store_results(spark: SparkSession, base: str) -> None:
    """``transform`` of the stored refined rows, written under ``base``."""
    d0, d2 = (
        read_refined(spark, f"{base}/refined/{name}", schemas.REFINED_SCHEMA)
        for name in ("d0", "d2")
    )
    summary, comparison = transform(d0, d2)
    write_refined(summary, f"{base}/results/summary")
    write_refined(comparison, f"{base}/results/comparison")


def load_stored(
    spark: SparkSession, base: str, database: str, replaced_date: str | None = None
) -> None:
    """``load`` of the stored results."""
    summary, comparison = (
        read_refined(spark, f"{base}/results/{name}") for name in ("summary", "comparison")
    )
    load(summary, comparison, base, database, replaced_date)


def run_latest(
    spark: SparkSession,
    raw_root: str,
    base: str,
    database: str,
    back: int = 2,
    replace: bool = False,
    stored_as: str = "partitions",
    least_share: float | None = None,
) -> tuple[str, str]:
    """Extract, transform and load the newest date; returns the two dates used.

    ``replace`` also drops what is stored for the newest date and not new. Every run leaves its
    counts under ``base``; with ``least_share`` a run whose rows fall below that share of what is
    usual stops before it loads anything.

    Each step stores what it made and the next one reads it, so nothing is computed
    twice: the refined rows serve two results, and the load counts before it writes.
    """
    d0, d2 = latest_dates(spark, raw_root, back, layout(stored_as).dates(spark, raw_root))
    run = history.new_run()
    store_refined(spark, raw_root, d0, d2, base, stored_as, run)
    if least_share is not None:
        history.check_run(spark, base, run, least_share=least_share)
    store_results(spark, base)
    load_stored(spark, base, database, d0 if replace else None)
    return d0, d2
