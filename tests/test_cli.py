from collections import Counter

import pytest

from daymark import schemas, sources
from daymark.__main__ import main
from test_files import bag, root  # noqa: F401


@pytest.fixture(autouse=True)
def keep_session_settings(spark):
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_daily_steps_one_by_one(spark, root, tmp_path, capsys):  # noqa: F811
    base = f"{tmp_path}/out"
    main(["dates", "--raw", root])
    d0, d2 = capsys.readouterr().out.split()
    assert (d0, d2) == ("20240106", "20240102")
    main(["extract", "--raw", root, "--d0", d0, "--d2", d2, "--base", base])
    main(["transform", "--base", base])
    main(["load", "--base", base, "--database", "steps_db", "--replace-date", d0])
    by_steps = bag(spark.table("steps_db.tb_comparacao")), bag(spark.table("steps_db.tb_agrupamento"))
    main(["run-latest", "--raw", root, "--base", f"{tmp_path}/out2", "--database", "whole_db"])
    assert capsys.readouterr().out.split() == [d0, d2]
    whole = bag(spark.table("whole_db.tb_comparacao")), bag(spark.table("whole_db.tb_agrupamento"))
    assert by_steps == whole and whole[0].total() == 2


def test_extract_without_history(spark, root, tmp_path):  # noqa: F811
    base = f"{tmp_path}/out"
    main(["extract", "--raw", root, "--d0", "20240101", "--base", base])
    main(["transform", "--base", base])
    rows = spark.read.parquet(f"{base}/results/comparison")
    assert rows.count() == 2 and rows.where("diferenca_qt_teorica is not null").count() == 0


def test_backfill(spark, root, tmp_path):  # noqa: F811
    base = f"{tmp_path}/out"
    main(["backfill", "--raw", root, "--base", base])
    rows = spark.read.schema("codigo string, dt_d2 string, dt_ptcm string").parquet(f"{base}/comparacao_datas")
    assert bag(rows.where("codigo = 'A1'").select("dt_ptcm", "dt_d2")) == Counter(
        [("20240101", None), ("20240102", None), ("20240105", "20240101"), ("20240106", "20240102")]
    )
    summary = sources.read_refined(spark, f"{base}/agrupamento", schemas.SUMMARY_SCHEMA)
    assert summary.count() == 8


def test_capture_and_ingest(spark, tmp_path):
    page = "<table><tr><td>A1</td><td>Alfa</td><td>ON</td><td>1.234</td><td>1,5</td></tr></table>"
    spark.createDataFrame([(page,)], "html string").write.parquet(f"{tmp_path}/pages")
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/refined"
    for ts in ("1704110400", "1704110460.5"):
        main(["capture", "--pages", f"{tmp_path}/pages", "--raw", raw, "--capture-ts", ts])
        main(["ingest", "--raw", raw, "--out", out, "--checkpoint", f"{tmp_path}/checkpoint"])
    assert bag(sources.read_refined(spark, out, schemas.REFINED_SCHEMA)) == Counter(
        {("A1", "Alfa", "ON", 1234, 1.5, "20240101"): 2}
    )
