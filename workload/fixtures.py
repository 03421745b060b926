"""Daily snapshots derived by Spark from the driver's tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.schemas import CAPTURE_COL, CAPTURE_NAMES, DATE_COL, HEADERS
from daymark.sinks import write_captures

PORTUGUESE = {name: headers[0] for name, headers in HEADERS.items()}
# A page made of a narrow row takes far more work than the row's bytes in a file tell.
PAGES_PER_TASK = 4_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new directory path in the folder the cluster shares for intermediate data."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set")
        base = tempfile.mkdtemp(prefix="daymark-")
    return f"{base.rstrip('/')}/daymark-{uuid.uuid4().hex}/{name}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(timestamp: Column | str) -> Column:
    """YYYYMMDD, through a date so that no time zone is involved."""
    return F.date_format(F.col(timestamp).cast("date"), "yyyyMMdd")


def grouped(number: Column) -> Column:
    """A whole number with dots between thousands."""
    return F.translate(F.format_number(number, 0), ",", ".")


def decimal_comma(number: Column) -> Column:
    return F.translate(number.cast("string"), ".", ",")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw snapshot text: one row per event, some cells malformed.

    ``event_id`` and ``capture_hour`` come along for queries that need them.
    """
    quantity = F.round(F.col("value") * 10000).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias(PORTUGUESE["codigo"]),
        F.col("event_type").alias(PORTUGUESE["acao"]),
        F.when(F.col("user_id") % 2 == 0, "ON").otherwise("PN").alias(PORTUGUESE["tipo"]),
        F.when(F.col("event_id") % 97 == 0, "n/d")
        .otherwise(grouped(quantity))
        .alias(PORTUGUESE["qt_teorica"]),
        F.when(F.col("event_id") % 89 == 0, "1.234,56")
        .otherwise(decimal_comma(F.col("value")))
        .alias(PORTUGUESE["pc_participacao"]),
        day_text("ts").alias(DATE_COL),
        "event_id",
        F.hour("ts").alias("capture_hour"),
    )


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as one raw snapshot per shipping month, dated on its first day."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias(PORTUGUESE["codigo"]),
        F.col("l_returnflag").alias(PORTUGUESE["acao"]),
        F.col("l_linestatus").alias(PORTUGUESE["tipo"]),
        grouped(F.round(F.col("l_extendedprice")).cast("bigint")).alias(PORTUGUESE["qt_teorica"]),
        decimal_comma(F.col("l_discount")).alias(PORTUGUESE["pc_participacao"]),
        F.concat(F.date_format(F.col("l_shipdate").cast("date"), "yyyyMM"), F.lit("01")).alias(
            DATE_COL
        ),
    )


def land(rows: DataFrame, root: str, headers: Sequence[str] = tuple(PORTUGUESE.values())) -> str:
    """Store raw rows the way captures arrive, one directory per date."""
    raw = rows.select(*map(_quoted, headers), DATE_COL).hint("rebalance", DATE_COL)
    raw.write.mode("append").partitionBy(DATE_COL).parquet(root)
    return root


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, source=raw_events) -> str:
    """The stored raw snapshots of a table; written once per session, then only read."""
    key = (spark.sparkContext.applicationId, sf_dir, source.__name__)
    if key not in _landed:
        _landed[key] = land(source(spark, sf_dir), scratch(spark, "raw"))
    return _landed[key]


def captured(spark: SparkSession, sf_dir: str) -> str:
    """The events as two captures a day, stored file by file: of the morning, and of the whole day."""
    key = (spark.sparkContext.applicationId, sf_dir, "captured")
    if key not in _landed:
        rows = raw_events(spark, sf_dir)
        noon = F.unix_timestamp(F.to_timestamp(DATE_COL, "yyyyMMdd")).cast("double") + 43_200.0
        morning = rows.where("capture_hour < 12").withColumn(CAPTURE_COL, noon)
        rows = morning.unionByName(rows.withColumn(CAPTURE_COL, noon + 39_600.5))
        prefix = scratch(spark, "captures")
        raw = rows.select(*map(_quoted, PORTUGUESE.values()), DATE_COL, CAPTURE_COL)
        write_captures(raw.hint("rebalance", DATE_COL, CAPTURE_COL), prefix)
        _landed[key] = prefix
    return _landed[key]


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events as HTML pages, each with a table of one event."""
    cells = [
        F.concat(F.lit("<td> "), _quoted(PORTUGUESE[name]), F.lit("\n</td>")) for name in HEADERS
    ]
    head = "".join(f"<th>{name}</th>" for name in CAPTURE_NAMES)
    return raw_events(spark, sf_dir).select(
        DATE_COL,
        F.concat(
            F.lit(f"<html><body><table><thead><tr>{head}</tr></thead><tbody><tr>"),
            *cells,
            F.lit("</tr></tbody></table></body></html>"),
        ).alias("html"),
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly to tasks by their number: a few megabytes of file, which one task
    reads, are pages enough for many."""
    return rows.repartition(max(1, ceil(rows.count() / PAGES_PER_TASK)))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer: a head row, a body row without cells, a body row with three."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    return _spread(customers).select(
        "c_custkey",
        "c_nationkey",
        F.concat(
            F.lit("<!-- <tr><td>old</td></tr> --><table><thead><tr><td>x</td></tr></thead><tbody>"),
            F.lit("<tr><th>h</th></tr><tr><td> "),
            F.col("c_custkey").cast("string"),
            F.lit(' </td><td class="c"><b>'),
            F.col("c_name"),
            F.lit("</b></td><TD>\n a &amp;  b\t</TD></tr></tbody></table>"),
        ).alias("html"),
    )


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer: two rows, the first with a table in its second cell, that has one too."""
    name, key = F.col("c_name"), F.col("c_custkey").cast("string")
    parts = [
        "<table><thead><tr><td>x</td></tr></thead><tbody><tr><td>", key, "</td><td>before <table><tr><td>",
        name, "</td><td>deep<table><tbody><tr><td>", key, "<td>&lt;", name, "&gt;</table></td><td>behind</td></tr></table>",
        " after</td><td>", name, "</td></tr><tr><td>last</td></tr></tbody></table>",
    ]
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return _spread(customers).select("c_custkey", html.alias("html"))
