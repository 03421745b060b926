"""Updates of all-dates results against full rebuilds."""

import itertools
import os
import shutil

import pytest
from test_files import ROW, bag, write

from daymark import __main__, plans, schemas, sources
from daymark.plans import incremental

DATES = ["20240101", "20240102", "20240105", "20240106", "20240107"]


def land(root, dt, name="f", n=1):
    rows = [(f"C{i}", "Alfa" if i % 2 else "Beta", "ON", str(i * n), "1,5") for i in range(4)]
    write(f"{root}/dt_ptcm={dt}/{name}.parquet", [(*ROW[:3], str(int(dt) % 97), "0,5"), *rows])


def results(spark, base):
    return (
        bag(sources.read_refined(spark, f"{base}/agrupamento", schemas.SUMMARY_SCHEMA)),
        bag(sources.read_refined(spark, f"{base}/comparacao_datas", schemas.DATES_COMPARISON_SCHEMA)),
    )


def rebuilt(spark, root, base):
    plans.store_backfill(spark, root, base)
    return results(spark, base)


@pytest.mark.parametrize("order", list(itertools.permutations(range(5)))[::23])
def test_dates_in_any_order_give_what_a_rebuild_gives(spark, tmp_path, order):
    root = f"{tmp_path}/raw"
    for k, i in enumerate(order):
        land(root, DATES[i])
        done = plans.update_results(spark, root, f"{tmp_path}/base")
        assert done.refined == 1 and done.rows == 5  # only the new date is read
        assert done.compared <= 3  # it, and the two dates that follow it
    assert results(spark, f"{tmp_path}/base") == rebuilt(spark, root, f"{tmp_path}/full")
    assert plans.update_results(spark, root, f"{tmp_path}/base") == (0, 0, 0)


def test_changed_and_removed_dates(spark, tmp_path):
    root, base = f"{tmp_path}/raw", f"{tmp_path}/base"
    for dt in DATES:
        land(root, dt)
    assert plans.update_results(spark, root, base) == (5, 5, 25)
    # More rows of a date: it, and the date that is compared with it.
    land(root, DATES[1], "g", 7)
    assert plans.update_results(spark, root, base) == (1, 2, 10)
    assert results(spark, base) == rebuilt(spark, root, f"{tmp_path}/full1")
    # A date whose stocks went, and one that has no rows left.
    write(f"{root}/dt_ptcm={DATES[2]}/f.parquet", [("Z", "Zeta", "ON", "1", "1")])
    write(f"{root}/dt_ptcm={DATES[3]}/f.parquet", [])
    assert plans.update_results(spark, root, base)[:2] == (2, 3)
    assert results(spark, base) == rebuilt(spark, root, f"{tmp_path}/full2")
    # A date that is gone keeps its results and is no position any more.
    before = results(spark, base)[0]
    os.rename(f"{root}/dt_ptcm={DATES[3]}", f"{root}/gone")
    assert plans.update_results(spark, root, base)[:2] == (0, 1)
    assert results(spark, base)[0] == before


def test_broken_off_updates_are_done_again(spark, tmp_path, monkeypatch):
    root, base = f"{tmp_path}/raw", f"{tmp_path}/base"
    for dt in DATES[:3]:
        land(root, dt)
    plans.update_results(spark, root, base)
    land(root, DATES[0], "g", 3)
    land(root, DATES[4])
    expected = rebuilt(spark, root, f"{tmp_path}/full")
    for k in range(6):
        calls = itertools.count()
        put = incremental._put

        def breaking(*args, k=k, calls=calls, put=put, **more):
            if next(calls) == k % 3:
                raise RuntimeError("broken off")
            put(*args, **more)

        monkeypatch.setattr(incremental, "_put", breaking)
        with pytest.raises(RuntimeError):
            plans.update_results(spark, root, base)
        monkeypatch.undo()
        if k == 3:
            break
    assert plans.update_results(spark, root, base)[:2] == (2, 3)
    assert results(spark, base) == expected


def test_other_distances_and_the_command(spark, tmp_path, capsys):
    root, base = f"{tmp_path}/raw", f"{tmp_path}/base"
    for dt in DATES[1:]:
        land(root, dt)
    __main__.main(["update", "--raw", root, "--base", base, "--back", "1"])
    land(root, DATES[0])
    __main__.main(["update", "--raw", root, "--base", base, "--back", "1"])
    assert capsys.readouterr().out.split() == ["4", "4", "20", "1", "2", "5"]
    plans.store_backfill(spark, root, f"{tmp_path}/full", 1)
    assert results(spark, base) == results(spark, f"{tmp_path}/full")
    shutil.rmtree(f"{tmp_path}/full")


def test_changed_dates_are_replaced_all_at_once(spark, tmp_path, monkeypatch):
    """One by one only where a leaf has no rows any more."""
    root, base = f"{tmp_path}/raw", f"{tmp_path}/base"
    for dt in DATES:
        land(root, dt)
    plans.update_results(spark, root, base)
    alone, refined = [], []
    replace, write_all = incremental.replace_date, incremental.write_refined
    monkeypatch.setattr(incremental, "replace_date", lambda *a: alone.append(a[2]) or replace(*a))
    monkeypatch.setattr(incremental, "write_refined", lambda df, path: refined.append(path) or write_all(df, path))
    for dt in DATES[:4]:
        land(root, dt, "g", 7)
    assert plans.update_results(spark, root, base)[:2] == (4, 5)
    assert alone == [] and not [p for p in refined if "dt_ptcm=" in p]
    assert results(spark, base) == rebuilt(spark, root, f"{tmp_path}/full1")
    write(f"{root}/dt_ptcm={DATES[0]}/f.parquet", [("Z", "Zeta", "ON", "1", "1")])
    write(f"{root}/dt_ptcm={DATES[0]}/g.parquet", [])
    write(f"{root}/dt_ptcm={DATES[1]}/g.parquet", [])
    refined.clear()
    assert plans.update_results(spark, root, base)[0] == 2
    assert alone == [DATES[0]]  # its other values of the second level are gone
    assert results(spark, base) == rebuilt(spark, root, f"{tmp_path}/full2")
