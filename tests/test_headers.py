"""Files without headers, and captures stored file by file."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_files import ENGLISH, PORTUGUESE, ROW, bag, root, write  # noqa: F401

from daymark import __main__, operators, plans, schemas, sinks, sources, streaming
from daymark.sources import raw

BAD = ["Code", "Stock", "Type", "Quantity", "Participation (%)"]
MISSING = "Qtde. Teórica / Theoretical Qty"


@pytest.fixture
def mixed(root):  # noqa: F811
    """A date with a good file and one without a quantity, among good dates."""
    write(f"{root}/dt_ptcm=20240106/z.parquet", names=BAD)
    return root


def fails(action):
    with pytest.raises(Exception, match="raw columns missing in .*dt_ptcm=20240106/z.parquet") as error:
        action()
    assert MISSING in str(error.value)


def test_date_with_one_bad_file_fails_and_names_it(spark, mixed):
    fails(lambda: operators.refine(sources.read_snapshot(spark, mixed, "20240106")).collect())
    fails(lambda: operators.refine(sources.read_snapshots(spark, mixed)).collect())
    # The file is named by whatever needs the column; other dates and columns are fine.
    rows = operators.refine(sources.read_snapshots(spark, mixed))
    assert rows.where("dt_ptcm < '20240106'").count() == 6
    assert rows.select("codigo").count() == 9


def test_backfill_fails_before_any_result_changes(spark, mixed, tmp_path):
    base = f"{tmp_path}/base"
    fails(lambda: plans.store_backfill(spark, mixed, base))
    assert not os.path.exists(f"{base}/agrupamento")
    os.rename(f"{mixed}/dt_ptcm=20240106/z.parquet", f"{tmp_path}/z.parquet")
    plans.store_backfill(spark, mixed, base)
    before = bag(sources.read_refined(spark, f"{base}/agrupamento"))
    os.rename(f"{tmp_path}/z.parquet", f"{mixed}/dt_ptcm=20240106/z.parquet")
    fails(lambda: plans.store_backfill(spark, mixed, base))
    assert bag(sources.read_refined(spark, f"{base}/agrupamento")) == before


def test_stream_batch_with_a_bad_file_shows_nothing(spark, root, tmp_path):  # noqa: F811
    where = root, f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    streaming.ingest_new_files(spark, *where)
    before = bag(sources.read_refined(spark, where[1], schemas.REFINED_SCHEMA))
    write(f"{root}/dt_ptcm=20240106/z.parquet", names=BAD)
    write(f"{root}/dt_ptcm=20240107/a.parquet")
    for _ in range(2):  # it stays the next batch
        fails(lambda: streaming.ingest_new_files(spark, *where))
    assert bag(sources.read_refined(spark, where[1], schemas.REFINED_SCHEMA)) == before
    write(f"{root}/dt_ptcm=20240106/z.parquet", names=ENGLISH)
    streaming.ingest_new_files(spark, *where)
    after = bag(sources.read_refined(spark, where[1], schemas.REFINED_SCHEMA))
    assert after.total() == before.total() + 2


def test_null_cells_and_unread_columns_are_no_fault(spark, tmp_path):
    write(f"{tmp_path}/dt_ptcm=20240101/a.parquet", [(None,) * 5, (None,) * 5])
    write(f"{tmp_path}/dt_ptcm=20240101/b.parquet", [("A1", None, None, None, None)], ENGLISH)
    rows = operators.refine(sources.read_snapshots(spark, str(tmp_path)))
    expected = Counter({(None,) * 5: 2, ("A1", None, None, None, None): 1})
    assert bag(rows.drop("dt_ptcm", "capture_ts")) == expected
    assert bag(sources.audit_headers(spark, str(tmp_path)).select(F.size("missing"))) == Counter({(0,): 2})


def test_audit_names_files_and_columns(spark, mixed, capsys):
    write(f"{mixed}/dt_ptcm=20240105/y.parquet", [ROW, ROW], names=["Código", "a", "b", "c", "d"])
    found = sources.audit_headers(spark, mixed).where("size(missing) > 0").orderBy("file").collect()
    assert [(r.dt_ptcm, r.file.split("/")[-1], r.n_rows, len(r.missing)) for r in found] == [
        ("20240105", "y.parquet", 2, 4),
        ("20240106", "z.parquet", 1, 1),
    ]
    __main__.main(["audit", "--raw", mixed])
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 2 and MISSING in out[1] and out[1].split("\t")[0].endswith("z.parquet")


def test_header_checks_read_nothing_more(spark, root):  # noqa: F811
    plan = operators.refine(sources.read_snapshots(spark, root)).select("codigo")._jdf
    text = plan.queryExecution().executedPlan().toString()
    assert "Theoretical" not in text and "Exchange" not in text


def test_without_the_vectorized_reader_absent_columns_are_nulls(spark, mixed):
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    try:
        assert raw.marking_schema(spark) == schemas.RAW_SCHEMA
        rows = operators.refine(sources.read_snapshots(spark, mixed))
        assert rows.where("qt_teorica IS NULL").count() == 1
    finally:
        spark.conf.unset("spark.sql.parquet.enableVectorizedReader")


# Captures stored file by file


@pytest.fixture
def prefix(tmp_path):
    for day, time, code in (
        ("20240101", "1704110400.25", "old"),
        ("20240101", "1704110460.5", "A1"),
        ("20240102", "1704196800", "A1"),
        ("20240102", "1704196800.0-1", "B2"),
        ("20240105", "1704456000", "A1"),
    ):
        write(f"{tmp_path}/captures/{day}/{time}.parquet", [(code, *ROW[1:])], ENGLISH)
    os.makedirs(f"{tmp_path}/captures/tmp")
    write(f"{tmp_path}/captures/20240105/notes.parquet", names=ENGLISH)
    return f"{tmp_path}/captures"


def test_only_the_newest_capture_of_a_date_is_opened(spark, prefix):
    df = sources.read_captures(spark, prefix, "20240101")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.RAW_SCHEMA]
    assert [f.split("/")[-1] for f in df.inputFiles()] == ["1704110460.5.parquet"]
    rows = operators.refine(sources.read_captures(spark, prefix))
    assert bag(rows.select("codigo", "dt_ptcm", "capture_ts")) == Counter(
        [
            ("A1", "20240101", 1704110460.5),
            ("A1", "20240102", 1704196800.0),
            ("B2", "20240102", 1704196800.0),
            ("A1", "20240105", 1704456000.0),
        ]
    )
    assert sorted(r.dt_ptcm for r in sources.list_capture_dates(spark, prefix).collect()) == [
        "20240101", "20240102", "20240105"
    ]
    with pytest.raises(ValueError, match="not a snapshot date"):
        sources.read_captures(spark, prefix, "2024*")


def test_jobs_over_captures(spark, prefix, tmp_path):
    d0, d2 = plans.run_latest(spark, prefix, f"{tmp_path}/base", "captures_db", stored_as="captures")
    assert (d0, d2) == ("20240105", "20240101")
    compared = spark.table("captures_db.tb_comparacao").collect()
    assert [(r.codigo, r.data_atual, r.diff_qt_teorica) for r in compared] == [("A1", "20240105", 0)]
    plans.store_backfill(spark, prefix, f"{tmp_path}/all", stored_as="captures")
    assert sources.read_refined(spark, f"{tmp_path}/all/agrupamento").count() == 4
    empty = plans.extract(spark, prefix, "20240105", "19990101", "captures")[1]
    assert empty.count() == 0
    with pytest.raises(ValueError, match="no such layout"):
        plans.extract(spark, prefix, "20240105", "", "other")
    with pytest.raises(ValueError, match="no captures under"):
        sources.list_capture_dates(spark, f"{tmp_path}/base")


def test_captures_without_headers_are_named(spark, prefix):
    write(f"{prefix}/20240105/1704456001.parquet", names=BAD)
    with pytest.raises(Exception, match="raw columns missing in .*20240105/1704456001.parquet"):
        operators.refine(sources.read_captures(spark, prefix)).collect()


def test_captures_are_written_under_their_time(spark, prefix, tmp_path):
    rows = sources.read_capture_files(spark, prefix).where("capture_ts IS NOT NULL")
    sinks.write_captures(rows, f"{tmp_path}/copy")
    assert bag(sources.read_capture_files(spark, f"{tmp_path}/copy")) == bag(rows)
    assert sorted(os.listdir(f"{tmp_path}/copy")) == ["20240101", "20240102", "20240105"]
    with pytest.raises(ValueError, match="already stored"):
        sinks.write_captures(rows, f"{tmp_path}/copy")


def test_a_capture_is_claimed_by_one_run(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([ROW], ", ".join(f"`{c}` string" for c in PORTUGUESE))
    root = f"{tmp_path}/raw"  # noqa: F811
    for day in range(5):
        sinks.append_capture(rows, root, 86400.0 * day)
    opened = []
    read = spark.read.__class__.parquet

    def noted(self, *paths, **options):
        opened.extend(paths)
        return read(self, *paths, **options)

    monkeypatch.setattr(spark.read.__class__, "parquet", noted)
    sinks.append_capture(rows, root, 86400.0 * 3 + 60)
    assert opened == [f"{root}/dt_ptcm=19700104"]  # only the date that is written
    with pytest.raises(ValueError, match="already stored"):
        sinks.append_capture(rows, root, 86400.0 * 3 + 60)
    # Of another run with the same time nothing may be stored yet, but its claim is.
    os.makedirs(f"{root}/_captures", exist_ok=True)
    open(f"{root}/_captures/19700110-{86400.0 * 9!r}", "w").close()
    with pytest.raises(ValueError, match="being stored"):
        sinks.append_capture(rows, root, 86400.0 * 9)
    broken = rows.withColumn("Código", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        sinks.append_capture(broken, root, 86400.0 * 8)
    sinks.append_capture(rows, root, 86400.0 * 8)  # a run that failed gives its claim back
    assert sources.read_snapshots(spark, root).count() == 7
