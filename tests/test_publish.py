"""Loads that show all their rows at once, broken off at every step."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymark import catalog, plans, schemas
from daymark.plans.publish import Published

SUMMARY = "codigo string, soma_qt_teorica long, media_pc_participacao double, qtd_registros long, dt_ptcm string, acao string"
COMPARISON = "codigo string, acao string, dt_ptcm string, diferenca_qt_teorica long, diferenca_pc_participacao double"
STEPS = ("write", "write_state", "register", "show")


def bag(df):
    return Counter(map(tuple, df.collect()))


def rows_of(spark, *leaves, n=1):
    return spark.createDataFrame([("c", n, 1.0, n, dt, acao) for dt, acao in leaves], SUMMARY)


@pytest.fixture
def results(spark, tmp_path, request):
    name = "published_" + request.node.name.split("[")[0][-20:] + str(abs(hash(request.node.name)) % 10**6)
    return plans.summary_results(spark, str(tmp_path), name)


def shown(spark, results):
    return bag(spark.table(f"{results.database}.tb_agrupamento"))


def expected(spark, *parts):
    out = Counter()
    for df in parts:
        out += bag(df)
    return out


def test_leaves_replace_leaves_and_dates_replace_dates(spark, results):
    odd = [("1", "A"), ("1", None), ("2", "x/y =z%"), ("2", "+")]
    results.publish(rows_of(spark, *odd))
    assert shown(spark, results) == bag(rows_of(spark, *odd))
    assert results.publish(rows_of(spark, ("1", None), ("3", "A"), n=2)) == 2
    after = expected(spark, rows_of(spark, odd[0], *odd[2:]), rows_of(spark, ("1", None), ("3", "A"), n=2))
    assert shown(spark, results) == after
    results.publish(rows_of(spark, ("1", "B"), n=3), ["1"])
    after = expected(spark, rows_of(spark, *odd[2:]), rows_of(spark, ("3", "A"), n=2), rows_of(spark, ("1", "B"), n=3))
    assert shown(spark, results) == after


@pytest.mark.parametrize("broken", STEPS)
def test_readers_see_whole_dates_when_a_load_breaks_off(spark, results, monkeypatch, broken):
    old = rows_of(spark, ("1", "A"), ("1", "B"), ("2", "A"))
    results.publish(old)
    seen = []
    for step in STEPS:
        own = getattr(Published, step)

        def noted(self, *args, own=own, step=step):
            seen.append((step, shown(spark, results)))  # what a reader sees before the step
            if step == broken:
                raise RuntimeError(step)
            return own(self, *args)

        monkeypatch.setattr(Published, step, noted)
    new = rows_of(spark, ("1", "A"), ("1", "C"), n=5)
    with pytest.raises(RuntimeError, match=broken):
        results.publish(new, ["1"])
    assert [step for step, _ in seen] == list(STEPS[: STEPS.index(broken) + 1])
    assert all(rows == bag(old) for _, rows in seen) and shown(spark, results) == bag(old)
    monkeypatch.undo()
    assert results.publish(new, ["1"]) == 3  # the version of the broken load stays unused
    assert shown(spark, results) == expected(spark, new, rows_of(spark, ("2", "A")))


def test_a_version_is_taken_once(spark, results):
    assert [results.claim() for _ in range(3)] == [1, 2, 3]


def test_of_two_loads_at_a_time_one_is_refused(spark, results, monkeypatch):
    results.publish(rows_of(spark, ("1", "A")))
    register = Published.register

    def meanwhile(self, version):
        monkeypatch.undo()
        results.publish(rows_of(spark, ("2", "A")))
        register(self, version)

    monkeypatch.setattr(Published, "register", meanwhile)
    with pytest.raises(ValueError, match="published by another load"):
        results.publish(rows_of(spark, ("1", "B")))
    assert shown(spark, results) == bag(rows_of(spark, ("1", "A"), ("2", "A")))


def test_a_date_is_pruned_through_the_view(spark, results):
    results.publish(rows_of(spark, ("1", "A"), ("2", "A")))
    results.publish(rows_of(spark, ("2", "A"), n=2))
    day = spark.table(f"{results.database}.tb_agrupamento").where("dt_ptcm = '2'")
    assert [r.qtd_registros for r in day.collect()] == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x and "qtd_registros" in x)
    assert "dt_ptcm" in scan.split("PartitionFilters")[1] and "= 2" in scan.split("PartitionFilters")[1]


def test_vacuum_deletes_what_no_reader_needs(spark, results):
    for n in (1, 2, 3):
        results.publish(rows_of(spark, ("1", "A"), ("1", None), n=n))
    results.publish(rows_of(spark, ("2", "x/y"), n=4))
    before = shown(spark, results)
    gone = {tuple(r) for r in results.superseded().collect()}
    assert gone == {(v, "1", a) for v in (1, 2) for a in ("A", None)}
    assert results.vacuum() == 4 and results.vacuum() == 0
    assert shown(spark, results) == before
    stored = spark.read.parquet(results.root)
    assert {r.versao for r in stored.select("versao").distinct().collect()} == {3, 4}


def test_both_results_and_a_table_in_the_way(spark, tmp_path):
    summary = rows_of(spark, ("1", "A"))
    comparison = spark.createDataFrame([("c", "A", "1", 2, 0.5)], COMPARISON)
    for n in (1, 2):
        assert plans.publish(summary, comparison, str(tmp_path), "published_both") == (n, n)
    table = spark.table("published_both.tb_comparacao")
    assert table.columns == schemas.COMPARISON_SCHEMA.names and bag(table) == bag(comparison)
    plans.load(summary, comparison, f"{tmp_path}/other", "published_not")
    with pytest.raises(ValueError, match="not a view"):
        plans.publish(summary, comparison, f"{tmp_path}/other", "published_not")


def test_empty_results_are_published(spark, results):
    results.publish(rows_of(spark, ("1", "A")))
    results.publish(rows_of(spark, ("1", "A")).where("false"), ["1"])
    assert shown(spark, results) == Counter()


def test_partition_values_are_read_back(spark):
    parts = spark.createDataFrame([("a=x%2Fy",), ("a=__HIVE_DEFAULT_PARTITION__",), ("a=b+c",)], "p string")
    values = [r[0] for r in parts.select(catalog.partition_value(F.col("p"))).collect()]
    assert values == ["x/y", None, "b+c"]
