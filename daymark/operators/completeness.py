"""Whether all pages of a capture were stored.

A capture that broke off while paging has pages missing, in the end or in between. What is there is
reduced to runs of consecutive pages, and what lies between and behind these are its gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.operators.columns import quoted
from daymark.operators.small import broadcast_if_small
from daymark.schemas import CAPTURE_COL, DATE_COL

FIRST_PAGE = 1
PAGES_PER_BLOCK = 10_000


def page_runs(
    df: DataFrame, capture: Sequence[str], page_col: str, pages_per_block: int = PAGES_PER_BLOCK
) -> DataFrame:
    """(capture columns, first_page, last_page) of each run of consecutive pages, repeated or not.

    Runs are found within blocks of pages first, and joined over these, so a capture of very many
    pages is spread. Rows without a page number are left out.
    """
    keys = [quoted(c) for c in capture]
    page = quoted(page_col).cast("long")
    pages = df.where(page.isNotNull()).select(*keys, page.alias("_page")).distinct()
    pages = pages.withColumn("_block", F.floor(F.col("_page") / pages_per_block))
    place = F.row_number().over(Window.partitionBy(*keys, "_block").orderBy("_page"))
    islands = pages.withColumn("_island", F.col("_page") - place)
    runs = islands.groupBy(*keys, "_block", "_island").agg(
        F.min("_page").alias("_from"), F.max("_page").alias("_to")
    )
    # One row per run in a block.
    order = Window.partitionBy(*keys).orderBy("_from")
    fresh = F.coalesce(F.col("_from") != F.lag("_to").over(order) + 1, F.lit(True))
    runs = runs.withColumn("_fresh", fresh.cast("int"))
    runs = runs.withColumn("_run", F.sum("_fresh").over(order))
    joined = runs.groupBy(*keys, "_run").agg(F.min("_from").alias("first_page"), F.max("_to").alias("last_page"))
    return joined.drop("_run")


def _announced(df: DataFrame, capture: Sequence[str], last_col: str | None) -> DataFrame:
    """(capture columns, announced): the largest last page that any page of a capture names."""
    last = F.max(quoted(last_col).cast("long")) if last_col else F.lit(None).cast("long")
    return df.groupBy(*[quoted(c) for c in capture]).agg(last.alias("announced"))


def _same(left: DataFrame, right: DataFrame, capture: Sequence[str]) -> list[Column]:
    return [left[f"`{c}`"].eqNullSafe(right[f"`{c}`"]) for c in capture]


def capture_report(
    df: DataFrame, capture: Sequence[str], page_col: str, last_col: str | None = None, first: int = FIRST_PAGE
) -> DataFrame:
    """One row per capture: (capture columns, n_pages, last_page, announced, n_missing, complete).

    Pages are expected from ``first`` to the announced last one, or to the last that is there.
    ``last_col`` is where pages say which one is the last.
    """
    runs = page_runs(df, capture, page_col)
    spans = runs.groupBy(*[quoted(c) for c in capture]).agg(
        F.sum(F.col("last_page") - F.col("first_page") + 1).alias("n_pages"),
        F.min("first_page").alias("_first"),
        F.max("last_page").alias("last_page"),
    )
    known = _announced(df, capture, last_col)
    joined = known.join(spans, _same(known, spans, capture), "left")
    expected = F.greatest("announced", "last_page", F.lit(first - 1)) - F.least(F.lit(first), F.col("_first")) + 1
    pages = F.coalesce("n_pages", F.lit(0).cast("long"))
    return joined.select(
        *[known[f"`{c}`"] for c in capture],
        pages.alias("n_pages"),
        "last_page",
        "announced",
        (expected - pages).alias("n_missing"),
        ((pages > 0) & (expected == pages)).alias("complete"),
    )


def capture_gaps(
    df: DataFrame, capture: Sequence[str], page_col: str, last_col: str | None = None, first: int = FIRST_PAGE
) -> DataFrame:
    """(capture columns, from_page, to_page) of every gap: before, between and behind the runs."""
    keys = [quoted(c) for c in capture]
    runs = page_runs(df, capture, page_col).select(*keys, "first_page", "last_page")
    # Ends of what is expected, as runs of their own without a page.
    known = _announced(df, capture, last_col)
    ends = known.select(
        *keys, F.lit(first).cast("long").alias("first_page"), F.lit(first - 1).cast("long").alias("last_page")
    )
    beyond = known.where("announced IS NOT NULL").select(
        *keys, (F.col("announced") + 1).alias("first_page"), F.lit(None).cast("long").alias("last_page")
    )
    all_runs = runs.unionByName(ends).unionByName(beyond)
    # An announced end that pages lie beyond is none.
    top = F.max("last_page").over(Window.partitionBy(*keys))
    all_runs = all_runs.withColumn("_top", top)
    all_runs = all_runs.where(F.col("last_page").isNotNull() | (F.col("first_page") > F.col("_top")))
    order = Window.partitionBy(*keys).orderBy("first_page", "last_page")
    before = F.max("last_page").over(order.rowsBetween(Window.unboundedPreceding, -1))
    gaps = all_runs.withColumn("from_page", before + 1).withColumn("to_page", F.col("first_page") - 1)
    return gaps.where("from_page <= to_page").select(*keys, "from_page", "to_page")


def latest_complete_capture(
    df: DataFrame,
    page_col: str,
    last_col: str | None = None,
    date_col: str = DATE_COL,
    capture_col: str = CAPTURE_COL,
) -> DataFrame:
    """All rows of the newest complete capture of each date; dates without one have no rows.

    The rows themselves are not shuffled unless there are more dates than can be broadcast.
    """
    report = capture_report(df, [date_col, capture_col], page_col, last_col).where("complete")
    newest = report.groupBy(quoted(date_col).alias("_date")).agg(F.max(quoted(capture_col)).alias("_newest"))
    newest = broadcast_if_small(newest)
    same = quoted(date_col).eqNullSafe(F.col("_date")) & quoted(capture_col).eqNullSafe(F.col("_newest"))
    return df.join(newest, same, "left_semi")
