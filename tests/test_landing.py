"""Files that land, each read once, with a record of one row per date."""

import os
from collections import Counter

import pytest
from test_files import ENGLISH, ROW, bag, write

from daymark import __main__
from daymark.plans import landing


def land(root, dt, name, code="A1", names=ENGLISH):
    write(f"{root}/dt_ptcm={dt}/{name}.parquet", [(code, *ROW[1:])], names)


def codes(spark, out, dt=None):
    return Counter(r.codigo for r in landing.read_landed(spark, out, dt).collect())


@pytest.fixture
def where(tmp_path):
    for k, dt in enumerate(("20240101", "20240102", "20240103")):
        for name in "ab":
            land(f"{tmp_path}/raw", dt, name, f"{name}{k}")
    return f"{tmp_path}/raw", f"{tmp_path}/out"


def test_each_file_is_read_once(spark, where):
    assert landing.ingest_landed(spark, *where) == (1, 6, 3)
    assert landing.ingest_landed(spark, *where) == (0, 0, 0)
    assert codes(spark, where[1]) == Counter(["a0", "b0", "a1", "b1", "a2", "b2"])
    # The same name under another date is another file.
    land(where[0], "20240104", "a", "new")
    land(where[0], "20240101", "c", "late")
    assert landing.ingest_landed(spark, *where) == (1, 2, 2)
    assert codes(spark, where[1]).total() == 8 and codes(spark, where[1], "20240101")["late"] == 1
    assert landing.ingest_landed(spark, *where) == (0, 0, 0)
    record = landing.record(spark, where[1])
    assert record.count() == 4  # one row per date, however many files
    assert bag(record) == bag(landing.record_by_listing(spark, where[0]))


def test_only_names_of_changed_dates_are_looked_at(spark, where, monkeypatch):
    landing.ingest_landed(spark, *where)
    land(where[0], "20240102", "c", "late")
    opened = []
    read = spark.read.__class__.parquet

    def noted(self, *paths, **options):
        opened.extend(p for p in paths if "_nomes" in p)
        return read(self, *paths, **options)

    monkeypatch.setattr(spark.read.__class__, "parquet", noted)
    assert [r.file for r in landing.new_files(spark, *where).collect()] == ["c.parquet"]
    assert opened == [f"{where[1]}/_nomes/dt_ptcm=20240102"]


def test_lots_are_bounded(spark, where):
    assert landing.ingest_landed(spark, *where, max_files_per_lot=4) == (2, 6, 3)
    assert landing.last_lot(spark, where[1]) == 2
    assert codes(spark, where[1]) == Counter(["a0", "b0", "a1", "b1", "a2", "b2"])


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_lot_that_broke_off_shows_nothing_and_is_written_again(spark, where, monkeypatch, step):
    landing.ingest_landed(spark, *where)
    before = codes(spark, where[1])
    land(where[0], "20240102", "c", "late")
    land(where[0], "20240105", "a", "new")
    writer = type(spark.range(0).write)
    write_parquet, calls = writer.parquet, []

    def breaking(self, path, *args, **options):
        calls.append(path)
        if len(calls) == step + 1:
            raise RuntimeError("broken off")
        write_parquet(self, path, *args, **options)

    monkeypatch.setattr(writer, "parquet", breaking)
    with pytest.raises(RuntimeError):
        landing.ingest_landed(spark, *where)
    monkeypatch.undo()
    assert codes(spark, where[1]) == before
    land(where[0], "20240106", "a", "newer")
    assert landing.ingest_landed(spark, *where) == (1, 3, 3)
    assert codes(spark, where[1]) == before + Counter(["late", "new", "newer"])


def test_bad_files_and_the_command(spark, where, capsys):
    land(where[0], "20240103", "z", names=["Code", "Stock", "x", "y", "z"])
    with pytest.raises(Exception, match="raw columns missing in .*20240103/z.parquet"):
        landing.ingest_landed(spark, *where)
    assert landing.read_landed(spark, where[1]).count() == 0
    os.rename(f"{where[0]}/dt_ptcm=20240103/z.parquet", f"{where[0]}/z.parquet")
    __main__.main(["land", "--raw", where[0], "--out", where[1]])
    assert capsys.readouterr().out.split() == ["1", "6", "3"]


def test_many_changed_dates(spark, where, monkeypatch):
    landing.ingest_landed(spark, *where)
    land(where[0], "20240102", "c", "late")
    monkeypatch.setattr(landing, "small_rows", lambda df: None)
    assert [r.file for r in landing.new_files(spark, *where).collect()] == ["c.parquet"]
