"""Sources, sinks, jobs and streams over stored files."""

import os
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from daymark import catalog, operators, plans, schemas, sinks, sources, streaming
from daymark.sinks import files as files_sink

ENGLISH = list(schemas.CAPTURE_NAMES)
PORTUGUESE = [headers[0] for headers in schemas.HEADERS.values()]
ROW = ("A1", "Alfa", "ON", "1.234", "1,5")


def write(path, rows=(ROW,), names=PORTUGUESE):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pd.DataFrame(list(rows), columns=names, dtype="string").to_parquet(path, index=False)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def root(tmp_path):
    for day in ("20240101", "20240102", "20240105", "20240106"):
        write(f"{tmp_path}/raw/dt_ptcm={day}/f.parquet", [ROW, ("B2", "Beta", "PN", "10", "0,5")])
    os.makedirs(f"{tmp_path}/raw/tmp")
    write(f"{tmp_path}/raw/dt_ptcm=2024x/f.parquet")
    return f"{tmp_path}/raw"


def test_read_snapshot_prunes_and_types(spark, root):
    df = sources.read_snapshot(spark, root, "20240105")
    assert df.schema == schemas.RAW_SCHEMA
    assert {r.dt_ptcm for r in df.collect()} == {"20240105"}
    assert all("dt_ptcm=20240105" in f for f in df.inputFiles())
    pruned = sources.read_snapshots(spark, root).where("dt_ptcm = '20240105'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt_ptcm" in plan
    assert bag(pruned) == bag(df)


def test_read_snapshot_mixed_dialects(spark, tmp_path):
    write(f"{tmp_path}/dt_ptcm=20240101/a.parquet")
    write(f"{tmp_path}/dt_ptcm=20240101/b.parquet", names=ENGLISH)
    df = operators.refine(sources.read_snapshot(spark, str(tmp_path), "20240101"))
    assert bag(df.drop("dt_ptcm", "capture_ts")) == Counter({("A1", "Alfa", "ON", 1234, 1.5): 2})


def test_capture_without_rows(spark, tmp_path):
    """Such a file has no types for its columns."""
    os.makedirs(f"{tmp_path}/dt_ptcm=20240101")
    pd.DataFrame([], columns=ENGLISH).to_parquet(f"{tmp_path}/dt_ptcm=20240101/a.parquet")
    write(f"{tmp_path}/dt_ptcm=20240101/b.parquet", names=ENGLISH)
    d0, _ = plans.extract(spark, str(tmp_path), "20240101", "")
    assert d0.count() == 1


def test_read_snapshot_names_missing_columns(spark, tmp_path):
    write(f"{tmp_path}/dt_ptcm=20240101/a.parquet", names=["Code", "x", "Type", "y", "z"])
    with pytest.raises(ValueError, match="Ação / Stock, Qtde. Teórica / Theoretical Qty"):
        sources.read_snapshot(spark, str(tmp_path), "20240101")


@pytest.mark.parametrize("dt", ["2024", "*", "2024010x", ""])
def test_read_snapshot_wants_a_date(spark, root, dt):
    with pytest.raises(ValueError, match="not a snapshot date"):
        sources.read_snapshot(spark, root, dt)


@pytest.mark.parametrize("dt", ["", "19990101"])
def test_missing_snapshot_is_empty(spark, root, dt):
    df = sources.read_snapshot_or_empty(spark, root, dt)
    assert df.count() == 0 and df.schema == sources.read_snapshot(spark, root, "20240101").schema


def test_snapshot_directory_without_files_is_empty(spark, root):
    os.makedirs(f"{root}/dt_ptcm=20240301")
    assert sources.read_snapshot_or_empty(spark, root, "20240301").count() == 0


def test_corrupt_snapshot_fails(spark, root):
    os.makedirs(f"{root}/dt_ptcm=20240201")
    with open(f"{root}/dt_ptcm=20240201/f.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        sources.read_snapshot_or_empty(spark, root, "20240201").count()


def test_list_and_pick_partitions(spark, root):
    listed = sources.list_partitions(spark, root)
    assert sorted(r.dt_ptcm for r in listed.collect()) == ["20240101", "20240102", "20240105", "20240106"]
    assert sources.latest_dates(spark, root) == ("20240106", "20240102")
    assert sources.latest_dates(spark, root, back=3) == ("20240106", "20240101")


def test_no_partitions(spark, tmp_path):
    with pytest.raises(ValueError, match="no snapshot partitions"):
        sources.list_partitions(spark, str(tmp_path))


def test_strict_listing(spark, tmp_path):
    write(f"{tmp_path}/dt_ptcm=20259999/f.parquet")
    write(f"{tmp_path}/dt_ptcm=20250101/f.parquet")
    assert sources.list_partitions(spark, str(tmp_path)).count() == 2
    assert sources.list_partitions(spark, str(tmp_path), strict=True).count() == 1


@pytest.mark.parametrize(
    "n, expected", [(1, ("d1", "")), (2, ("d2", "")), (3, ("d3", "d1")), (4, ("d4", "d2"))]
)
def test_pick_partitions(spark, n, expected):
    dates = spark.createDataFrame([(f"d{i % n + 1}",) for i in range(3 * n)], "dt_ptcm string")
    assert tuple(sources.pick_partitions(dates).first()) == expected


def test_pick_partitions_from_nothing_fails(spark):
    dates = spark.createDataFrame([], "dt_ptcm string")
    with pytest.raises(Exception, match="no snapshot partition found"):
        sources.pick_partitions(dates).collect()


def test_capture_files(spark, tmp_path):
    write(f"{tmp_path}/20240101/1704110400.25.parquet", names=ENGLISH)
    write(f"{tmp_path}/20240101/1704110460.5.parquet", [("B2", "Beta", "PN", "1", "1")], ENGLISH)
    write(f"{tmp_path}/20240102/1704196800.parquet", names=ENGLISH)
    df = sources.read_capture_files(spark, str(tmp_path))
    latest = operators.refine(operators.latest_capture(df))
    assert bag(latest.select("codigo", "dt_ptcm", "capture_ts")) == Counter(
        [("B2", "20240101", 1704110460.5), ("A1", "20240102", 1704196800.0)]
    )


def test_empty_frame_keeps_its_schema(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.REFINED_SCHEMA)
    sinks.write_refined(empty, f"{tmp_path}/e")
    back = sources.read_refined(spark, f"{tmp_path}/e")
    assert back.count() == 0 and back.schema == schemas.REFINED_SCHEMA


def summary(spark, *rows):
    names = [f.name for f in schemas.SUMMARY_SCHEMA]
    given = [(c, 1, 1.0, n, dt, acao) for dt, acao, c, n in rows]
    return spark.createDataFrame(given, schemas.SUMMARY_SCHEMA).select(*names)


def stored(spark, path):
    rows = sources.read_refined(spark, path, schemas.SUMMARY_SCHEMA)
    return bag(rows.select("dt_ptcm", "acao", "codigo", "qtd_registros"))


def files(path):
    return {
        f"{d}/{f}": os.path.getmtime(f"{d}/{f}")
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_write_partitioned_replaces_only_its_leaves(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_partitioned(
        summary(spark, ("d1", "x", "A", 1), ("d2", "x", "A", 1), ("d2", "y", "B", 1)), path
    )
    before = files(path)
    again = summary(spark, ("d2", "x", "A", 2))
    for _ in range(2):
        sinks.write_partitioned(again, path)
        assert stored(spark, path) == Counter(
            [("d1", "x", "A", 1), ("d2", "x", "A", 2), ("d2", "y", "B", 1)]
        )
    untouched = {f: t for f, t in before.items() if "dt_ptcm=d2/acao=x" not in f}
    assert len(untouched) == 2 and untouched.items() <= files(path).items()


@pytest.mark.parametrize("rows_per_task", [100_000, 500])
def test_gathering_leaves(spark, tmp_path, rows_per_task):
    """39 leaves of 200 rows, of them one null, and one with half of all rows."""
    place = F.col("id") % 78
    rows = spark.range(15_600).select(
        F.when(place % 2 == 0, "hot").when(place > 1, F.concat(F.lit("a"), place)).alias("acao"),
        F.lit("d1").alias("dt_ptcm"),
        "id",
    )
    by = ("dt_ptcm", "acao")
    gathered = sinks.gather_leaves(rows, by, None, 4, rows_per_task)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        sinks.write_partitioned(gathered, f"{tmp_path}/t", by, gather=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored_rows = spark.read.parquet(f"{tmp_path}/t").select(*rows.columns)
    assert bag(stored_rows) == bag(rows)
    per_leaf = Counter(os.path.basename(os.path.dirname(f)) for f in files(f"{tmp_path}/t"))
    hot = per_leaf.pop("acao=hot")
    assert len(per_leaf) == 39 and set(per_leaf.values()) == {1}
    assert (hot > 3) == (rows_per_task == 500)


def test_leaves_of_many_rows_have_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr("daymark.sinks.files.ROWS_TO_SPREAD", 100)
    rows = spark.range(10_000).select(F.concat(F.lit("d"), F.col("id") % 10).alias("dt_ptcm"), "id")
    gathered = sinks.gather_leaves(rows, ["dt_ptcm"])
    assert gathered.rdd.getNumPartitions() == 40
    places = gathered.select("dt_ptcm", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(places) == 10 and len({r.task for r in places}) > 5
    assert bag(gathered) == bag(rows)
    # Few rows stay together.
    assert sinks.gather_leaves(rows.limit(100), ["dt_ptcm"]).rdd.getNumPartitions() == 1


def test_gathering_nothing(spark):
    empty = spark.createDataFrame([], schemas.SUMMARY_SCHEMA)
    assert sinks.gather_leaves(empty, schemas.SUMMARY_PARTITIONS).count() == 0


def test_replace_date_removes_the_rest_of_the_date(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_partitioned(
        summary(spark, ("d1", "x", "A", 1), ("d2", "x", "A", 1), ("d2", "y", "B", 1)), path
    )
    sinks.replace_date(summary(spark, ("d2", "x", "A", 2), ("d3", "x", "A", 9)), path, "d2")
    assert stored(spark, path) == Counter([("d1", "x", "A", 1), ("d2", "x", "A", 2)])


def test_write_partitioned_odd_names(spark, tmp_path):
    path = f"{tmp_path}/t"
    names = ["x", "", None, "y/ z"]
    sinks.write_partitioned(summary(spark, *[("d1", n, str(i), 1) for i, n in enumerate(names)]), path)
    assert stored(spark, path) == Counter(
        [("d1", n, str(i), 1) for i, n in enumerate(["x", None, None, "y/ z"])]
    )


def test_append_capture_keeps_earlier_captures(spark, tmp_path):
    rows = spark.createDataFrame([ROW], ", ".join(f"`{n}` string" for n in ENGLISH))
    path = f"{tmp_path}/raw"
    sinks.append_capture(rows, path, 1704110400.25)
    before = files(path)
    sinks.append_capture(rows, path, 1704110460.0)
    assert before.items() <= files(path).items()
    df = sources.read_snapshot(spark, path, "20240101")
    assert sorted(r.capture_ts for r in df.collect()) == [1704110400.25, 1704110460.0]


def test_capture_job(spark, tmp_path):
    page = (
        "<table><tbody><tr><td>A1</td><td>Alfa</td><td>ON</td><td>1.234</td><td>1,5</td></tr>"
        "<tr></tr></tbody></table>"
    )
    path = f"{tmp_path}/raw"
    plans.capture(spark.createDataFrame([(page,)], "html string"), path, 1704110400.0)
    d0, _ = plans.extract(spark, path, "20240101", "")
    nothing = (None, None, None, None, None, "20240101")  # the row without cells
    assert bag(d0) == Counter([("A1", "Alfa", "ON", 1234, 1.5, "20240101"), nothing])


def test_captured_rows_keep_their_page_order(spark, tmp_path, caplog):
    cells = "<td>{0}</td><td>x</td><td>ON</td><td>1</td><td>1</td>"
    page = lambda *codes: "<table>" + "".join(f"<tr>{cells.format(c)}</tr>" for c in codes) + "</table>"
    pages = spark.createDataFrame(
        [(2, page("d")), (0, page("a", "b")), (1, page("c")), (3, None)], "page int, html string"
    )
    path = f"{tmp_path}/raw"
    with caplog.at_level("INFO", logger="daymark.plans.jobs"):
        plans.capture(pages, path, 1704110400.0, page_col="page")
    assert "4 rows" in caplog.text
    stored_rows = spark.read.parquet(path).orderBy("row_no")
    assert [(r.row_no, r[1]) for r in stored_rows.select("row_no", schemas.CAPTURE_NAMES[0]).collect()] == [
        (1, "a"), (2, "b"), (3, "c"), (4, "d")
    ]
    before = files(path)
    with pytest.raises(ValueError, match="already stored"):
        plans.capture(pages, path, 1704110400.0, page_col="page")
    assert files(path) == before
    d0, _ = plans.extract(spark, path, "20240101", "")
    assert sorted(r.codigo for r in d0.collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("n", [4, 6])
def test_capture_job_refuses_tables_of_another_width(spark, tmp_path, n):
    page = f"<table><tr>{'<td>x</td>' * n}</tr></table>"
    pages = spark.createDataFrame([(page,)], "html string")
    with pytest.raises(ValueError, match="5 columns expected"):
        plans.capture(pages, f"{tmp_path}/raw", 1704110400.0)
    assert not os.path.exists(f"{tmp_path}/raw")


def test_extract_uses_the_newest_capture(spark, tmp_path):
    rows = spark.createDataFrame([ROW], ", ".join(f"`{n}` string" for n in ENGLISH))
    for time, code in ((1704110400.0, "old"), (1704110460.0, "new")):
        sinks.append_capture(rows.withColumn("Code", F.lit(code)), str(tmp_path), time)
    d0, d2 = plans.extract(spark, str(tmp_path), "20240101", "")
    assert [r.codigo for r in d0.collect()] == ["new"] and d2.count() == 0
    assert d0.schema.names == d2.schema.names == schemas.REFINED_SCHEMA.names


def test_run_latest_and_rerun(spark, root, tmp_path):
    write(f"{root}/dt_ptcm=20240107/f.parquet", [ROW, ("C3", "Gama", "PN", "7", "1")])
    for _ in range(2):
        assert plans.run_latest(spark, root, f"{tmp_path}/out", "latest_db") == ("20240107", "20240105")
        assert bag(spark.table("latest_db.tb_comparacao")) == Counter(
            [("A1", "Alfa", "20240107", 0, 0.0), ("C3", "Gama", "20240107", None, None)]
        )
        assert bag(spark.table("latest_db.tb_agrupamento")) == Counter(
            [("A1", 1234, 1.5, 1, "20240107", "Alfa"), ("C3", 7, 1.0, 1, "20240107", "Gama")]
        )


def test_load_keeps_or_replaces_a_dates_old_leaves(spark, root, tmp_path):
    d0, d2 = plans.extract(spark, root, "20240106", "20240102")
    _, comparison = plans.transform(d0, d2)
    everything = operators.summarise(d0)
    less = everything.where("acao = 'Alfa'")
    base = f"{tmp_path}/out"
    count = lambda: spark.table("load_db.tb_agrupamento").count()
    plans.load(everything, comparison, base, "load_db")
    plans.load(less, comparison, base, "load_db")
    assert count() == 2
    plans.load(less, comparison, base, "load_db", replaced_date="20240106")
    assert count() == 1


def test_registered_tables_prune_and_list(spark, root, tmp_path):
    base = f"{tmp_path}/out"
    summary_ = plans.summarise_dates(spark, root)
    _, comparison = plans.transform(*plans.extract(spark, root, "20240106", "20240102"))
    plans.load(summary_, comparison, base, "prune_db")
    df = spark.sql("SELECT * FROM prune_db.tb_agrupamento WHERE dt_ptcm = '20240102' AND acao = 'Beta'")
    assert bag(df.select("codigo", "qtd_registros")) == Counter([("B2", 1)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt_ptcm" in plan
    dates = sources.list_table_partitions(spark, "prune_db.tb_agrupamento")
    assert tuple(sources.pick_partitions(dates).first()) == ("20240106", "20240102")


def test_changed_definition_replaces_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_partitioned(summary(spark, ("d1", "x", "A", 1)), path)
    catalog.ensure_database(spark, "change_db")
    register = lambda schema, where, by: catalog.register_external(
        spark, "change_db", "t", schema, where, by
    )
    register(schemas.COMPARISON_SCHEMA, f"{tmp_path}/none", ())
    for _ in range(2):
        register(schemas.SUMMARY_SCHEMA, path, schemas.SUMMARY_PARTITIONS)
        assert bag(spark.table("change_db.t")) == Counter([("A", 1, 1.0, 1, "d1", "x")])
    sinks.write_partitioned(summary(spark, ("d2", "y", "B", 2)), path)
    sinks.replace_date(summary(spark, ("d1", "z", "C", 3)), path, "d1")
    register(schemas.SUMMARY_SCHEMA, path, schemas.SUMMARY_PARTITIONS)
    assert bag(spark.table("change_db.t").select("dt_ptcm", "acao", "codigo")) == Counter(
        [("d2", "y", "B"), ("d1", "z", "C")]
    )


def test_adding_partitions_without_a_repair(spark, tmp_path, monkeypatch):
    path, names = f"{tmp_path}/t", ["x", "", None, "y/ z", "it's \\ here"]
    sinks.write_partitioned(summary(spark, ("d1", "x", "A", 1)), path)
    catalog.ensure_database(spark, "add_db")
    register = lambda added: catalog.register_external(
        spark, "add_db", "t", schemas.SUMMARY_SCHEMA, path, schemas.SUMMARY_PARTITIONS, added
    )
    register(None)
    monkeypatch.setattr(catalog, "repair_partitions", None)
    added = [("d2", n) for n in names]
    sinks.write_partitioned(summary(spark, *[(*leaf, "B", 2) for leaf in added]), path)
    for _ in range(2):
        register(added)
        rows = spark.table("add_db.t").select("dt_ptcm", "acao", "codigo", "qtd_registros")
        assert bag(rows) == stored(spark, path) and rows.count() == 6


def test_leaves_are_counted_in_the_cluster(spark):
    rows = spark.range(300).select((F.col("id") % 30).alias("acao"), F.lit("d").alias("dt_ptcm"))
    assert files_sink.count_leaves(rows, ["dt_ptcm", "acao"]) == (30, 300, 10)
    assert files_sink.count_leaves(rows.limit(0), ["dt_ptcm", "acao"]) == (0, 0, 0)


def test_repair_skips_unpartitioned_and_managed_tables_are_safe(spark):
    catalog.ensure_database(spark, "managed_db")
    catalog.ensure_database(spark, "managed_db")
    spark.sql("CREATE TABLE IF NOT EXISTS managed_db.t (a INT) USING PARQUET")
    catalog.repair_partitions(spark, "managed_db", "t", ())
    with pytest.raises(ValueError, match="not an external table"):
        catalog.register_external(spark, "managed_db", "t", schemas.COMPARISON_SCHEMA, "/nowhere")
    assert spark.catalog.tableExists("managed_db.t")


def test_backfill_equals_the_daily_run(spark, root):
    daily = operators.compare_snapshots(*plans.extract(spark, root, "20240106", "20240102"))
    backfill = plans.compare_dates(spark, root).where("dt_ptcm = '20240106'").drop("dt_d2")
    assert bag(backfill) == bag(daily)


def test_metrics_come_with_the_write(spark, tmp_path):
    rows = [(*ROW[:3], "n/d", "1.234,56"), ROW]
    df = operators.refine(spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in ENGLISH)))
    seen = Observation("run")
    sinks.write_refined(operators.observe_refined(df, seen), f"{tmp_path}/m")
    assert seen.get == {"n_rows": 2, "bad_qt": 1, "bad_pc": 1}


def test_stream_reads_each_file_once(spark, root, tmp_path):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    count = lambda: sources.read_refined(spark, out, schemas.REFINED_SCHEMA).count()
    streaming.ingest_new_files(spark, root, out, checkpoint, max_files_per_batch=1)
    assert count() == 8
    streaming.ingest_new_files(spark, root, out, checkpoint)
    assert count() == 8
    old = f"{root}/dt_ptcm=20231231/late.parquet"
    write(old, names=ENGLISH)
    os.utime(old, (0, 0))
    streaming.ingest_new_files(spark, root, out, checkpoint)
    batch = operators.refine(sources.read_snapshots(spark, root)).drop("capture_ts")
    streamed = sources.read_refined(spark, out, schemas.REFINED_SCHEMA)
    assert count() == 9 and bag(streamed) == bag(batch)


def load(spark, base, rows, replaced=None):
    compared = spark.createDataFrame([], schemas.COMPARISON_SCHEMA)
    plans.load(summary(spark, *rows), compared, base, "loads", replaced)
    table = spark.table(f"loads.{schemas.SUMMARY_TABLE}")
    return Counter(r[schemas.DATE_COL] for r in table.collect())


@pytest.fixture
def loads(spark):
    yield
    spark.sql("DROP DATABASE IF EXISTS loads CASCADE")


def test_load_replacing_a_date_keeps_the_others(spark, tmp_path, loads):
    base = str(tmp_path)
    load(spark, base, [("d1", "x", "A", 1), ("d1", "y", "B", 1)])
    with pytest.raises(ValueError, match="no rows"):
        load(spark, base, [("d2", "x", "A", 1)], "d1")
    assert load(spark, base, [("d1", "x", "A", 2), ("d2", "x", "A", 1)], "d1") == {"d1": 1, "d2": 1}


def test_load_after_an_interrupted_one(spark, tmp_path, loads):
    base = str(tmp_path)
    load(spark, base, [("d1", "x", "A", 1)])
    sinks.write_partitioned(summary(spark, ("d2", "x", "A", 1)), f"{base}/agrupamento")
    assert load(spark, base, [("d3", "x", "A", 1)]) == {"d1": 1, "d2": 1, "d3": 1}


def test_backfill_keeps_dates_that_are_gone(spark, tmp_path, loads):
    base, raw = f"{tmp_path}/out", f"{tmp_path}/raw"
    load(spark, base, [("20200101", "x", "A", 1)])
    day = spark.createDataFrame(
        [("U1", "x", "ON", "1.000", "1,5", "20240102")],
        [h[0] for h in schemas.HEADERS.values()] + [schemas.DATE_COL],
    )
    day.write.partitionBy(schemas.DATE_COL).parquet(raw)
    plans.store_backfill(spark, raw, base, database="loads")
    table = spark.table(f"loads.{schemas.SUMMARY_TABLE}")
    assert Counter(r[schemas.DATE_COL] for r in table.collect()) == {"20200101": 1, "20240102": 1}
