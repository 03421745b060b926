"""One query per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from daymark import catalog, functions, operators, plans, schemas, sinks, sources, streaming
from daymark.schemas import CAPTURE_COL, DATE_COL, KEYS
from workload.fixtures import (
    PORTUGUESE,
    captured,
    customer_pages,
    event_pages,
    land,
    landed,
    nested_pages,
    raw_events,
    raw_lineitem,
    scratch,
    table,
)

REFINED = [f.name for f in schemas.REFINED_SCHEMA]
DIFFERENCES = ("diferenca_pc_participacao", "diff_pc_participacao", "media_pc_participacao")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles that depend on the order of a sum, at six places."""
    return df.withColumns({c: F.round(c, 6) for c in DIFFERENCES if c in df.columns})


def refined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.refine(raw_events(spark, sf_dir))


def newest_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    root = landed(spark, sf_dir)
    return plans.extract(spark, root, *sources.latest_dates(spark, root))


def new_database() -> str:
    return f"daymark_{uuid.uuid4().hex}"


# Sources and sinks


def read_snapshot(spark, sf_dir):
    rows = sources.read_snapshot(spark, landed(spark, sf_dir), "20240115")
    return operators.refine(rows).select(*REFINED)


def read_snapshot_missing(spark, sf_dir):
    root = landed(spark, sf_dir)
    missing = sources.read_snapshot_or_empty(spark, root, "19990101")
    rows = sources.read_snapshots(spark, root).unionByName(missing)
    return operators.refine(rows).select(*REFINED)


def list_partitions(spark, sf_dir):
    return sources.list_partitions(spark, landed(spark, sf_dir))


def pick_partitions(spark, sf_dir):
    return sources.pick_partitions(sources.list_partitions(spark, landed(spark, sf_dir)))


def pick_partitions_few(spark, sf_dir):
    """More positions back than there are dates."""
    return sources.pick_partitions(raw_events(spark, sf_dir), back=36_500)


def list_table_partitions(spark, sf_dir):
    """The dates of a registered summary of all dates, from the catalog."""
    database, path = new_database(), scratch(spark, "summary")
    summary = plans.summarise_dates(spark, landed(spark, sf_dir))
    sinks.write_partitioned(operators.conform(summary, schemas.SUMMARY_SCHEMA), path)
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    catalog.register_external(
        spark,
        database,
        schemas.SUMMARY_TABLE,
        schemas.SUMMARY_SCHEMA,
        path,
        schemas.SUMMARY_PARTITIONS,
    )
    return sources.list_table_partitions(spark, f"{database}.{schemas.SUMMARY_TABLE}")


def read_mixed_headers(spark, sf_dir):
    """One root with files of both header dialects."""
    root, rows = scratch(spark, "raw"), raw_events(spark, sf_dir)
    english = dict(zip(PORTUGUESE.values(), schemas.CAPTURE_NAMES))
    on = F.col(PORTUGUESE["tipo"]) == "ON"
    land(rows.where(on), root)
    land(operators.rename_columns(rows.where(~on), english), root, schemas.CAPTURE_NAMES)
    return operators.refine(sources.read_snapshots(spark, root)).select(*REFINED)


def refined_roundtrip(spark, sf_dir):
    path = scratch(spark, "refined")
    sinks.write_refined(refined_events(spark, sf_dir), path)
    return sources.read_refined(spark, path).select(*REFINED)


def empty_roundtrip(spark, sf_dir):
    """An empty result is written and read back, and fits the rows it came from."""
    path = scratch(spark, "empty")
    rows = refined_events(spark, sf_dir)
    sinks.write_refined(rows.where("qt_teorica < 0"), path)
    return rows.unionByName(sources.read_refined(spark, path)).select(*REFINED)


def _rewritten(spark, sf_dir, write) -> DataFrame:
    """The summary of all dates, then the newest date again without ``view`` and with other counts."""
    root, path = landed(spark, sf_dir), scratch(spark, "summary")
    summary = operators.summarise(plans.refine_dates(spark, root))
    rows = operators.conform(summary, schemas.SUMMARY_SCHEMA)
    sinks.write_partitioned(rows, path)
    d0, _ = sources.latest_dates(spark, root)
    again = rows.where((F.col(DATE_COL) == d0) & (F.col("acao") != "view"))
    write(again.withColumn("qtd_registros", F.col("qtd_registros") + 100), path, d0)
    stored = sources.read_refined(spark, path, schemas.SUMMARY_SCHEMA)
    return stored.select(*KEYS, DATE_COL, "qtd_registros")


def dynamic_overwrite(spark, sf_dir):
    return _rewritten(spark, sf_dir, lambda df, path, _: sinks.write_partitioned(df, path))


def replace_date(spark, sf_dir):
    return _rewritten(spark, sf_dir, sinks.replace_date)


def append_capture(spark, sf_dir):
    root = scratch(spark, "captures")
    rows = raw_events(spark, sf_dir)
    morning = F.col("capture_hour") < 12
    sinks.append_capture(rows.where(morning), root, 1.0)
    sinks.append_capture(rows.where(~morning), root, 2.0)
    return (
        sources.read_snapshots(spark, root)
        .groupBy(DATE_COL, F.col(CAPTURE_COL).cast("int").alias(CAPTURE_COL))
        .agg(F.count("*").alias("n_rows"))
    )


BAD_HEADERS = ["Code", "Stock", "Type", "Quantity", "Participation (%)"]


def _with_bad_files(spark, sf_dir) -> str:
    """All events; in every date those of ``error`` are in files that have no quantity's header."""
    root, rows = scratch(spark, "bad"), raw_events(spark, sf_dir)
    errors = F.col(f"`{PORTUGUESE['acao']}`") == "error"
    land(rows.where(~errors), root)
    other = dict(zip(PORTUGUESE.values(), BAD_HEADERS))
    land(operators.rename_columns(rows.where(errors), other), root, BAD_HEADERS)
    return root


def _refused(action) -> None:
    """The action must fail on a file without a quantity's header, and name it."""
    try:
        action()
    except PySparkException as error:
        text = str(error)
        if "raw columns missing in " in text and PORTUGUESE["qt_teorica"] in text:
            return
        raise
    raise ValueError("files without a header were taken")


def header_audit(spark, sf_dir):
    """Rows by date and missing headers, of files that have all and files that don't."""
    audit = sources.audit_headers(spark, _with_bad_files(spark, sf_dir))
    return audit.groupBy(DATE_COL, F.array_join("missing", ", ").alias("missing")).agg(
        F.sum("n_rows").alias("n_rows")
    )


def backfill_bad_file(spark, sf_dir):
    """A backfill, then one of a root with bad files, which must leave the results as they are."""
    base, root, bad = scratch(spark, "results"), landed(spark, sf_dir), _with_bad_files(spark, sf_dir)
    plans.store_backfill(spark, root, base)
    _refused(lambda: plans.store_backfill(spark, bad, base))
    stored = sources.read_refined(spark, f"{base}/agrupamento", schemas.SUMMARY_SCHEMA)
    return rounded(stored)


def stream_bad_file(spark, sf_dir):
    """All events ingested, then a landing with bad files, of which nothing may show."""
    landing, out, checkpoint = (scratch(spark, x) for x in ("landing", "refined", "checkpoint"))
    land(raw_events(spark, sf_dir), landing)
    streaming.ingest_new_files(spark, landing, out, checkpoint)
    land(
        operators.rename_columns(raw_events(spark, sf_dir), dict(zip(PORTUGUESE.values(), BAD_HEADERS))),
        landing,
        BAD_HEADERS,
    )
    _refused(lambda: streaming.ingest_new_files(spark, landing, out, checkpoint))
    return sources.read_refined(spark, out, schemas.REFINED_SCHEMA)


# Captures stored file by file


def captures_listed(spark, sf_dir):
    """Dates and times from the paths of two captures a day; no file is opened."""
    return sources.list_captures(spark, captured(spark, sf_dir)).drop("path")


def captures_extract(spark, sf_dir):
    """The newest capture of the two dates of a run, each from the one file that holds it."""
    root = captured(spark, sf_dir)
    reads = sources.layout("captures")
    dates = sources.latest_dates(spark, root, dates=reads.dates(spark, root))
    d0, d2 = plans.extract(spark, root, *dates, "captures")
    return d0.withColumn("side", F.lit("d0")).unionByName(d2.withColumn("side", F.lit("d2")))


def captures_backfill(spark, sf_dir):
    """All dates compared, by the newest capture of each."""
    base = scratch(spark, "results")
    plans.store_backfill(spark, captured(spark, sf_dir), base, stored_as="captures")
    return rounded(
        sources.read_refined(spark, f"{base}/comparacao_datas", schemas.DATES_COMPARISON_SCHEMA)
    )


# Projection and parsing


def rename_columns(spark, sf_dir):
    renamed = operators.rename_columns(raw_events(spark, sf_dir), schemas.RENAMES)
    return renamed.select("codigo", "acao", "tipo")


def rename_columns_missing(spark, sf_dir):
    rows = raw_events(spark, sf_dir).select(
        PORTUGUESE["codigo"], F.col("event_id").alias("extra")
    )
    return operators.rename_columns(rows, schemas.RENAMES)


def parse_grouped_long(spark, sf_dir):
    text = F.col(f"`{PORTUGUESE['qt_teorica']}`")
    return raw_events(spark, sf_dir).select(
        "event_id", functions.parse_grouped_long(text).alias("qt_teorica")
    )


def parse_decimal_comma(spark, sf_dir):
    text = F.col(f"`{PORTUGUESE['pc_participacao']}`")
    return raw_events(spark, sf_dir).select(
        "event_id", functions.parse_decimal_comma(text).alias("pc_participacao")
    )


def strip_cells(spark, sf_dir):
    padded = F.concat(F.lit("\t \xa0"), "o_orderpriority", F.lit(" \n "))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", functions.strip(padded).alias("cell")
    )


def positional_schema(spark, sf_dir):
    key, brand = F.col("p_partkey"), F.col("p_brand")
    cells = F.array(F.col("p_name"), *[F.concat(brand, F.lit(x)) for x in "abcd"])
    ragged = (
        F.when(key % 5 == 1, F.slice(cells, 1, 0))
        .when(key % 3 == 0, F.slice(cells, 1, 3))
        .otherwise(cells)
    )
    rows = table(spark, sf_dir, "part").select("p_partkey", ragged.alias("cells"))
    return operators.apply_positional_schema(rows, "cells", ["c1", "c2", "c3", "c4", "c5"])


def partition_date_filter(spark, sf_dir):
    """Dates from paths, those of ``error`` events not being dates."""
    bad = F.when(F.col(f"`{PORTUGUESE['acao']}`") == "error", "2024x").otherwise("")
    path = F.concat(F.lit("root/dt_ptcm="), bad, DATE_COL, F.lit("/f.parquet"))
    return raw_events(spark, sf_dir).select(
        "event_id", functions.partition_date(path).alias(DATE_COL)
    )


def preview(spark, sf_dir):
    rows = raw_events(spark, sf_dir)
    return operators.preview(
        operators.rename_columns(rows, schemas.RENAMES).select(*KEYS, DATE_COL, "event_id"),
        order_by="event_id",
    ).drop("event_id")


# HTML


def html_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    rows = operators.html_table_rows(pages, row_tag="li", cell_tag="a", bodies_only=False)
    return rows.select("page_id", "row_pos", F.array_join("cells", "|").alias("cells"))


def html_tbody_rows(spark, sf_dir):
    rows = operators.html_table_rows(customer_pages(spark, sf_dir))
    return rows.select(
        "c_custkey",
        "row_pos",
        F.size("cells").alias("n_cells"),
        F.array_join("cells", "|").alias("cells"),
    )


def html_nested_tables(spark, sf_dir):
    """Rows of tables three deep, in page order, each with its own cells."""
    rows = operators.html_table_rows(nested_pages(spark, sf_dir))
    return rows.select("c_custkey", "row_pos", F.array_join("cells", "|").alias("cells"))


def html_pages_ordered(spark, sf_dir):
    rows = operators.html_table_rows(customer_pages(spark, sf_dir))
    return operators.concat_pages(rows, "c_nationkey", "c_custkey").select(
        F.col("c_nationkey").alias("capture"),
        F.col("c_custkey").alias("page"),
        "row_no",
        F.size("cells").alias("n_cells"),
    )


# Analytics


def compare_snapshots(spark, sf_dir):
    return rounded(operators.compare_snapshots(*newest_pair(spark, sf_dir)))


def compare_spread(spark, sf_dir):
    """The same comparison with every repeated key treated as a hot one."""
    return rounded(operators.compare_snapshots(*newest_pair(spark, sf_dir), rows_per_task=1))


def compare_edge_rows(spark, sf_dir):
    """Null keys match nothing, repeated keys multiply, keys of the earlier date alone go."""
    rows = refined_events(spark, sf_dir)
    keyless = rows.withColumn("codigo", F.when(F.col("acao") != "error", F.col("codigo")))
    return rounded(operators.compare_all_dates(keyless, rows_per_task=100))


def compare_no_d2(spark, sf_dir):
    root = landed(spark, sf_dir)
    d0, _ = sources.latest_dates(spark, root)
    return rounded(operators.compare_snapshots(*plans.extract(spark, root, d0, "")))


def summarise_snapshot(spark, sf_dir):
    return rounded(operators.summarise(newest_pair(spark, sf_dir)[0]))


def conform_agrupamento(spark, sf_dir):
    summary = operators.summarise(newest_pair(spark, sf_dir)[0])
    return rounded(operators.conform(summary, schemas.SUMMARY_SCHEMA))


def conform_comparacao(spark, sf_dir):
    comparison = operators.compare_snapshots(*newest_pair(spark, sf_dir))
    return rounded(
        operators.conform(comparison, schemas.COMPARISON_SCHEMA, schemas.COMPARISON_RENAMES)
    )


def run_metrics(spark, sf_dir):
    observation = Observation()
    rows = operators.observe_refined(refined_events(spark, sf_dir), observation)
    sinks.write_refined(rows, scratch(spark, "refined"))
    counts = observation.get
    return spark.createDataFrame(
        [tuple(counts[c] for c in ("n_rows", "bad_qt", "bad_pc"))],
        "n_rows long, bad_qt long, bad_pc long",
    )


def latest_capture(spark, sf_dir):
    rows = raw_events(spark, sf_dir).select("event_id", DATE_COL, "capture_hour")
    return operators.latest_capture(rows, DATE_COL, "capture_hour")


# Jobs


def job_capture(spark, sf_dir):
    """HTML pages to stored captures to refined rows."""
    root = scratch(spark, "captures")
    plans.capture(event_pages(spark, sf_dir), root, 1.0)
    return plans.refine_dates(spark, root).select(*REFINED)


def job_extract(spark, sf_dir):
    d0, d2 = newest_pair(spark, sf_dir)
    return d0.withColumn("side", F.lit("d0")).unionByName(d2.withColumn("side", F.lit("d2")))


def job_transform(spark, sf_dir):
    summary, comparison = plans.transform(*newest_pair(spark, sf_dir))
    n_summary = summary.agg(F.count("*").alias("n_summary"), F.lit(0).alias("n_comparison"))
    n_comparison = comparison.agg(F.lit(0).alias("n_summary"), F.count("*").alias("n_comparison"))
    return n_summary.unionByName(n_comparison).agg(
        F.sum("n_summary").alias("n_summary"), F.sum("n_comparison").alias("n_comparison")
    )


def run_latest(spark, sf_dir):
    database = new_database()
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    plans.run_latest(spark, landed(spark, sf_dir), scratch(spark, "results"), database)
    return rounded(spark.table(f"{database}.{schemas.COMPARISON_TABLE}"))


def sql_over_registered(spark, sf_dir):
    """The newest date's totals by SQL, over the registered summary of all dates."""
    database, root = new_database(), landed(spark, sf_dir)
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    refined = plans.refine_dates(spark, root)
    d0, d2 = newest_pair(spark, sf_dir)
    plans.load(
        operators.summarise(refined),
        operators.compare_snapshots(d0, d2),
        scratch(spark, "results"),
        database,
    )
    return spark.sql(
        f"""
        SELECT acao, dt_ptcm, sum(soma_qt_teorica) AS total, sum(qtd_registros) AS n_rows
        FROM {database}.{schemas.SUMMARY_TABLE}
        WHERE dt_ptcm = :d0 AND acao IS NOT NULL
        GROUP BY acao, dt_ptcm
        """,
        {"d0": sources.latest_dates(spark, root)[0]},
    )


def _loading(spark, sf_dir):
    """The summary of all dates, and a load of some of its rows beside the newest comparison."""
    database, base = new_database(), scratch(spark, "results")
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    stored, compared = scratch(spark, "summary"), scratch(spark, "comparison")
    sinks.write_refined(plans.summarise_dates(spark, landed(spark, sf_dir)), stored)
    sinks.write_refined(operators.compare_snapshots(*newest_pair(spark, sf_dir)), compared)
    summary, comparison = (sources.read_refined(spark, path) for path in (stored, compared))

    def load(rows, replaced_date=None):
        plans.load(rows, comparison, base, database, replaced_date)

    return summary, load, base, database


def sql_over_both_tables(spark, sf_dir):
    """Totals of all dates by SQL, with what the comparison says of the newest one."""
    summary, load, _, database = _loading(spark, sf_dir)
    load(summary)
    return spark.sql(
        f"""
        SELECT s.acao, s.dt_ptcm, s.total, s.n_rows, c.n_compared, c.diff_total
        FROM (SELECT acao, dt_ptcm, sum(soma_qt_teorica) AS total, sum(qtd_registros) AS n_rows
              FROM {database}.{schemas.SUMMARY_TABLE} GROUP BY acao, dt_ptcm) AS s
        LEFT JOIN (SELECT acao, data_atual, count(*) AS n_compared, sum(diff_qt_teorica) AS diff_total
                   FROM {database}.{schemas.COMPARISON_TABLE} GROUP BY acao, data_atual) AS c
          ON c.acao = s.acao AND c.data_atual = s.dt_ptcm
        """
    )


def load_after_interruption(spark, sf_dir):
    """A third of the dates loaded, a third written but not registered, then the last third loaded."""
    summary, load, base, database = _loading(spark, sf_dir)
    third = F.dayofmonth(F.to_date(DATE_COL, "yyyyMMdd")) % 3
    load(summary.where(third == 0))
    broken_off = operators.conform(summary.where(third == 1), schemas.SUMMARY_SCHEMA)
    sinks.write_partitioned(broken_off, f"{base}/agrupamento")
    load(summary.where(third == 2))
    return rounded(spark.table(f"{database}.{schemas.SUMMARY_TABLE}"))


def load_replacing_date(spark, sf_dir):
    """All dates, then again with the newest one replaced by its rows without ``view``."""
    summary, load, _, database = _loading(spark, sf_dir)
    load(summary)
    d0, _ = sources.latest_dates(spark, landed(spark, sf_dir))
    load(summary.where((F.col(DATE_COL) != d0) | (F.col("acao") != "view")), d0)
    return rounded(spark.table(f"{database}.{schemas.SUMMARY_TABLE}"))


def publish_broken_off(spark, sf_dir):
    """The summary of all dates, published in parts, with loads of wrong counts broken off at every step."""
    database, base = new_database(), scratch(spark, "results")
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    stored = scratch(spark, "summary")
    sinks.write_refined(plans.summarise_dates(spark, landed(spark, sf_dir)), stored)
    summary = sources.read_refined(spark, stored)
    results = plans.summary_results(spark, base, database)
    third = F.dayofmonth(F.to_date(DATE_COL, "yyyyMMdd")) % 3
    wrong = summary.withColumn("qtd_registros", F.lit(-1).cast("long"))
    results.publish(wrong.where(third != 2))
    steps = (
        lambda version: results.write(wrong, version),
        lambda version: results.write_state(version, results.published()),
        lambda version: results.register(version),
    )
    for k in range(4):
        if k:
            version = results.claim()
            for step in steps[:k]:
                step(version)
        if k < 3:
            results.publish(summary.where(third == k))
    return rounded(spark.table(f"{database}.{schemas.SUMMARY_TABLE}"))


def publish_replacing_dates(spark, sf_dir):
    """All dates published, then the newest one without ``view`` as a whole, then superseded files deleted."""
    database, base, root = new_database(), scratch(spark, "results"), landed(spark, sf_dir)
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    stored = scratch(spark, "summary")
    sinks.write_refined(plans.summarise_dates(spark, root), stored)
    summary = sources.read_refined(spark, stored)
    d0, _ = sources.latest_dates(spark, root)
    results = plans.summary_results(spark, base, database)
    results.publish(summary)
    results.publish(summary.where((F.col(DATE_COL) == d0) & (F.col("acao") != "view")), [d0])
    results.vacuum(kept=1)
    return rounded(spark.table(f"{database}.{schemas.SUMMARY_TABLE}"))


def backfill_registered(spark, sf_dir):
    """The daily run of the newest date, then a backfill from a root that has only the others."""
    database, base, older = new_database(), scratch(spark, "results"), scratch(spark, "older")
    catalog.ensure_database(spark, database, scratch(spark, "database"))
    root = landed(spark, sf_dir)
    d0, _ = plans.run_latest(spark, root, base, database)
    land(raw_events(spark, sf_dir).where(F.col(DATE_COL) != d0), older)
    plans.store_backfill(spark, older, base, database=database)
    return rounded(spark.table(f"{database}.{schemas.SUMMARY_TABLE}"))


def _updated(spark, sf_dir) -> str:
    """Results of all dates, which land in three lots out of order; some dates land in two parts."""
    base, root, rows = scratch(spark, "results"), scratch(spark, "raw"), raw_events(spark, sf_dir)
    day = F.dayofmonth(F.to_date(DATE_COL, "yyyyMMdd"))
    late = (day % 5 == 0) & (F.col("event_id") % 2 == 0)
    for lot in (day % 3 == 1, day % 3 == 0, day % 3 == 2):
        land(rows.where(lot & ~late), root)
        plans.update_results(spark, root, base)
    land(rows.where(late), root)
    plans.update_results(spark, root, base)
    return base


def update_comparison(spark, sf_dir):
    path = f"{_updated(spark, sf_dir)}/comparacao_datas"
    return rounded(sources.read_refined(spark, path, schemas.DATES_COMPARISON_SCHEMA))


def update_summary(spark, sf_dir):
    path = f"{_updated(spark, sf_dir)}/agrupamento"
    return rounded(sources.read_refined(spark, path, schemas.SUMMARY_SCHEMA))


def compare_all_dates(spark, sf_dir):
    return rounded(plans.compare_dates(spark, landed(spark, sf_dir)))


def summarise_all_dates(spark, sf_dir):
    return rounded(plans.summarise_dates(spark, landed(spark, sf_dir)))


def compare_all_months(spark, sf_dir):
    return rounded(plans.compare_dates(spark, landed(spark, sf_dir, raw_lineitem)))


def summarise_all_months(spark, sf_dir):
    return rounded(plans.summarise_dates(spark, landed(spark, sf_dir, raw_lineitem)))


def stream_ingest(spark, sf_dir):
    """Two landings and an idle rerun."""
    landing, out, checkpoint = (scratch(spark, x) for x in ("landing", "refined", "checkpoint"))
    rows = raw_events(spark, sf_dir)
    early = F.col(DATE_COL) <= "20240110"
    for new_files in (rows.where(early), rows.where(~early), None):
        if new_files is not None:
            land(new_files, landing)
        streaming.ingest_new_files(spark, landing, out, checkpoint)
    return sources.read_refined(spark, out, schemas.REFINED_SCHEMA)


def _truncated(spark, sf_dir) -> DataFrame:
    """Events as pages of two captures a day, the second of which may lack its end or a page."""
    day = F.dayofmonth(F.to_date(DATE_COL, "yyyyMMdd"))
    of_day = Window.partitionBy(DATE_COL)
    pages = raw_events(spark, sf_dir).select(
        DATE_COL,
        "event_id",
        F.row_number().over(of_day.orderBy("event_id")).alias("page"),
        F.count("*").over(of_day).alias("last"),
    )
    first = pages.withColumn(CAPTURE_COL, F.lit(1.0))
    gone = F.when(day % 3 == 0, F.col("page") > F.col("last") / 2).otherwise(
        (day % 3 == 1) & F.col("page").isin(1, 3, 4)
    )
    return first.unionByName(pages.where(~gone).withColumn(CAPTURE_COL, F.lit(2.0)))


def capture_report(spark, sf_dir):
    """How many pages every capture has, and how many are missing."""
    return operators.capture_report(_truncated(spark, sf_dir), [DATE_COL, CAPTURE_COL], "page", "last")


def capture_gaps(spark, sf_dir):
    """The missing pages of every capture, as ranges."""
    return operators.capture_gaps(_truncated(spark, sf_dir), [DATE_COL, CAPTURE_COL], "page", "last")


def latest_complete_capture(spark, sf_dir):
    """Of every date the newest capture that has all pages."""
    rows = operators.latest_complete_capture(_truncated(spark, sf_dir), "page", "last")
    return rows.select(DATE_COL, F.col(CAPTURE_COL).cast("int").alias(CAPTURE_COL), "event_id")


def run_history(spark, sf_dir):
    """One run per date, of which every seventh lost three quarters of its rows."""
    rows = refined_events(spark, sf_dir).withColumn("_day", F.dayofmonth(F.to_date(DATE_COL, "yyyyMMdd")))
    kept = (F.col("_day") % 7 != 0) | (F.substring("codigo", 2, 20).cast("long") % 4 == 0)
    counted = rows.where(kept).groupBy(DATE_COL).agg(*operators.quality_metrics())
    runs = counted.select(
        F.col(DATE_COL).alias("run"), F.lit("").alias("started"), F.lit("refined").alias("stage"), "*"
    )
    return plans.compare_runs(runs).drop("run", "started", "stage")


def landed_files(spark, sf_dir):
    """Landings in three lots, of which two bring late files for dates that were read before."""
    landing, out = scratch(spark, "landing"), scratch(spark, "landed")
    rows = raw_events(spark, sf_dir)
    for lot in (1, 0, 2):
        land(rows.where(F.pmod(F.col("event_id") + F.dayofmonth(F.to_date(DATE_COL, "yyyyMMdd")), F.lit(3)) == lot), landing)
        plans.ingest_landed(spark, landing, out, max_files_per_lot=40)
    plans.ingest_landed(spark, landing, out)
    return plans.read_landed(spark, out).select(*REFINED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        read_snapshot,
        read_snapshot_missing,
        list_partitions,
        list_table_partitions,
        read_mixed_headers,
        pick_partitions,
        pick_partitions_few,
        refined_roundtrip,
        empty_roundtrip,
        dynamic_overwrite,
        replace_date,
        append_capture,
        header_audit,
        backfill_bad_file,
        stream_bad_file,
        captures_listed,
        captures_extract,
        captures_backfill,
        rename_columns,
        rename_columns_missing,
        parse_grouped_long,
        parse_decimal_comma,
        strip_cells,
        positional_schema,
        partition_date_filter,
        preview,
        html_rows,
        html_tbody_rows,
        html_nested_tables,
        html_pages_ordered,
        compare_snapshots,
        compare_spread,
        compare_edge_rows,
        compare_no_d2,
        summarise_snapshot,
        conform_agrupamento,
        conform_comparacao,
        run_metrics,
        latest_capture,
        job_capture,
        job_extract,
        job_transform,
        run_latest,
        sql_over_registered,
        sql_over_both_tables,
        load_after_interruption,
        load_replacing_date,
        publish_broken_off,
        publish_replacing_dates,
        backfill_registered,
        update_comparison,
        update_summary,
        compare_all_dates,
        summarise_all_dates,
        compare_all_months,
        summarise_all_months,
        stream_ingest,
        landed_files,
        capture_report,
        capture_gaps,
        latest_complete_capture,
        run_history,
    )
}
