from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymark.operators import (
    compare_all_dates,
    compare_snapshots,
    date_pairs,
    latest_capture,
    summarise,
)
from daymark.operators import hotkeys, small
from daymark.operators.hotkeys import find_hot_keys, spread_left_join

REFINED = "codigo string, acao string, dt_ptcm string, qt_teorica long, pc_participacao double"
D0 = [("A", "x", 10, 1.0), ("A", "x", 20, 2.0), ("B", "y", 5, 1.0), (None, "z", 5, 1.0)]
D2 = [("A", "x", 1, 1.0), ("A", "x", 2, 1.0), (None, "z", 5, 1.0), ("C", "w", 1, 1.0)]


def refined(spark, rows, dt="20240103"):
    return spark.createDataFrame([(c, a, dt, q, p) for c, a, q, p in rows], REFINED)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("rows_per_task", [1, 1000])
def test_compare_edge_rows(spark, rows_per_task):
    out = compare_snapshots(refined(spark, D0), refined(spark, D2), rows_per_task=rows_per_task)
    assert bag(out.select("codigo", "acao", "diferenca_qt_teorica")) == Counter(
        [
            ("A", "x", 9),
            ("A", "x", 8),
            ("A", "x", 19),
            ("A", "x", 18),
            ("B", "y", None),
            (None, "z", None),
        ]
    )
    assert out.columns == [
        "codigo", "acao", "dt_ptcm", "diferenca_qt_teorica", "diferenca_pc_participacao",
    ]


def test_compare_with_nothing(spark):
    none = refined(spark, D0).limit(0)
    assert compare_snapshots(refined(spark, D0), none).where("diferenca_qt_teorica is null").count() == 4
    assert compare_snapshots(none, refined(spark, D0)).count() == 0


key = st.sampled_from(["hot", "hot", "hot", "a", "b", None])
side = st.lists(st.tuples(key, st.sampled_from(["x", "x", "y", None]), st.integers(0, 3)), max_size=40)


@settings(max_examples=8, deadline=None)
@given(side, side, st.sampled_from([1, 2, 5]))
def test_spread_join_is_the_plain_join(spark, left, right, rows_per_task):
    left_df = spark.createDataFrame(left, "k string, j string, a int")
    right_df = spark.createDataFrame(right, "k string, j string, b int")
    spread = spread_left_join(left_df, right_df, ["k", "j"], rows_per_task)
    plain = left_df.join(right_df, ["k", "j"], "left").select("k", "j", "a", "b")
    assert spread.columns == plain.columns
    assert bag(spread) == bag(plain)


def test_a_third_in_one_key_on_both_sides(spark):
    """Half of the hot rows are copies of one row; the other rows have keys of their own."""

    def side(name, n):
        return spark.range(n).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"),
            F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias(name),
        )

    left, right = side("a", 3000), side("b", 600)
    spread = spread_left_join(left, right, ["k"], rows_per_task=50)
    plain = left.join(right, "k", "left").select("k", "a", "b")
    assert spread.count() == 1000 * 200 + 2000
    assert bag(spread.groupBy("k", "a", "b").count()) == bag(plain.groupBy("k", "a", "b").count())
    # 1000 x 200 pairs, in pieces of 50 x 50 rows.
    assert "_x" in spread._jdf.queryExecution().optimizedPlan().toString()


def test_rows_with_null_keys_are_not_shuffled(spark):
    left = spark.range(1000).select(F.when(F.col("id") == 7, "a").alias("k"), "id")
    right = spark.createDataFrame([("a", 1), (None, 2)], "k string, b int")
    out = spread_left_join(left, right, ["k"], rows_per_task=100)
    assert out.count() == 1000 and out.where("b is not null").count() == 1
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()


def test_without_hot_keys_the_plan_is_one_join(spark):
    left = spark.range(1000).select(F.col("id").cast("string").alias("k"), "id")
    right = left.withColumnRenamed("id", "b")
    plan = spread_left_join(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan


def test_hot_keys_are_counted_exactly(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") < 3000, "a").when(F.col("id") < 3010, "b").otherwise(
            F.col("id").cast("string")
        ).alias("k")
    )
    few = spark.createDataFrame([("a",), ("a",)], "k string")
    hot = find_hot_keys(df, few, ["k"], rows_per_task=5)
    assert sorted(map(tuple, hot.frame.collect())) == [("a", 600, 1), ("b", 2, 1)]
    assert hot.cells == 602 and not hot.nulls
    hot = find_hot_keys(few, df.unionAll(df), ["k"], rows_per_task=1000)
    assert [tuple(r) for r in hot.frame.collect()] == [("a", 1, 6)]
    # 3000 x 3000 pairs, at most 1000 x 200 for a task: pieces of 447 rows on each side.
    hot = find_hot_keys(df, df, ["k"], rows_per_task=1000)
    assert [tuple(r) for r in hot.frame.collect()] == [("a", 7, 7)]
    assert find_hot_keys(df.limit(0), few.limit(0), ["k"], 5) == (None, False, 0)
    assert find_hot_keys(df, few, ["k"]) == (None, False, 0)
    nulls = df.select(F.lit(None).cast("string").alias("k"))
    assert find_hot_keys(nulls, few, ["k"], 5) == (None, True, 0)
    assert find_hot_keys(few, nulls, ["k"], 5) == (None, False, 0)
    # A null in one key alone does not make rows meet in one task.
    spread = df.select(F.lit(None).cast("string").alias("k"), F.monotonically_increasing_id().alias("j"))
    assert find_hot_keys(spread, spread, ["k", "j"], 5) == (None, False, 0)


@pytest.mark.parametrize("n", [10_000, 200_000])
def test_a_key_is_hot_however_many_rows_there_are(spark, n):
    df = spark.range(n).select(
        F.when(F.col("id") < 150, "a").otherwise(F.col("id").cast("string")).alias("k")
    )
    hot = find_hot_keys(df, df, ["k"], rows_per_task=1)
    assert [tuple(r) for r in hot.frame.collect()] == [("a", 150, 150)]


@pytest.mark.parametrize("known", [3, 20_000])
def test_frequent_keys_are_found_by_summaries(spark, monkeypatch, known):
    """As at 10^9 rows: all buckets are heavy, and yet few keys are counted one by one."""
    monkeypatch.setattr("daymark.operators.hotkeys.BUCKETS", 8)
    monkeypatch.setattr("daymark.operators.hotkeys.MAX_KNOWN", known)
    n = 400_000
    df = spark.range(n).select(
        # A third in one key, 50 keys of 500 rows, and 240,000 keys of one row.
        F.when(F.col("id") % 3 == 0, "a")
        .when(F.col("id") < 37_500, F.concat(F.lit("b"), (F.col("id") % 50).cast("string")))
        .otherwise(F.col("id").cast("string"))
        .alias("k")
    )
    few = spark.createDataFrame([("a",), ("b1",)], "k string")
    exact = find_hot_keys(df, few, ["k"], rows_per_task=100)
    counted = hotkeys.frequent_hashes(df, few, ["k"], 100, n).count()
    assert 51 <= counted <= 2 * n / 100
    monkeypatch.setattr("daymark.operators.hotkeys.SUMMARY_FROM_ROWS", 0)
    hot = find_hot_keys(df, few, ["k"], rows_per_task=100)
    assert bag(hot.frame) == bag(exact.frame) and hot[1:] == exact[1:]
    assert hot.frame.count() == 51
    small = df.where("k = 'a' or k like 'b%'").limit(3000)
    assert bag(spread_left_join(small, few, ["k"], 20)) == bag(small.join(few, "k", "left"))


def test_tasks_follow_the_work_of_hot_keys(spark, monkeypatch):
    """Many pieces of little work share tasks."""
    made = []
    join = hotkeys._hot_join
    monkeypatch.setattr(hotkeys, "_hot_join", lambda *a: made.append(a[-1]) or join(*a))
    df = spark.range(3000).select((F.col("id") % 500).alias("k"))
    out = spread_left_join(df, df.distinct(), ["k"], rows_per_task=1)
    assert out.count() == 3000
    # 500 keys cut into 6 pieces each, some 18 pairs of a task's 200.
    assert find_hot_keys(df, df.distinct(), ["k"], rows_per_task=1).cells >= made[0]
    hot = spark.range(30_000).select(F.lit(1).alias("k"))
    spread_left_join(hot, hot, ["k"], rows_per_task=100)
    assert made[1] > 1000


@pytest.mark.parametrize("known", [3, 20_000])
def test_small_pieces_share_tasks(spark, monkeypatch, known):
    """Tasks follow the rows, however many pieces these are cut into."""
    made = []
    join = hotkeys._hot_join
    monkeypatch.setattr(hotkeys, "_hot_join", lambda *a: made.append(a[-1]) or join(*a))
    monkeypatch.setattr(hotkeys, "MAX_KNOWN", known)
    df = spark.range(6000).select((F.col("id") % 2000).alias("k"), "id")
    out = spread_left_join(df, df.withColumnRenamed("id", "b"), ["k"], rows_per_task=1)
    assert out.count() == 18_000
    assert made == [6]  # 18,000 rows of each side in 18,000 cells


@pytest.mark.parametrize("known", [0, 1, 20_000])
def test_many_hot_keys_are_joined_without_a_broadcast(spark, monkeypatch, known):
    monkeypatch.setattr("daymark.operators.hotkeys.MAX_KNOWN", known)
    left = spark.range(300).selectExpr("if(id < 40, null, id % 5) k", "id % 7 a")
    right = spark.range(200).selectExpr("if(id < 40, null, id % 4) k", "id % 3 b")
    spread = spread_left_join(left, right, ["k"], rows_per_task=5)
    plain = left.join(right, "k", "left").select("k", "a", "b")
    assert bag(spread) == bag(plain)


def test_date_pairs_are_positions(spark):
    df = spark.createDataFrame([(d,) for d in ("20240108", "20240105", "20240101", "20240105")], "dt_ptcm string")
    assert bag(date_pairs(df)) == Counter(
        [("20240101", None), ("20240105", None), ("20240108", "20240101")]
    )


@pytest.mark.parametrize("rows_per_task", [1, 1000])
def test_compare_all_dates_is_compare_snapshots_per_date(spark, rows_per_task):
    dates = ["20240101", "20240102", "20240105", "20240106", "20240107"]
    days = {
        dt: refined(spark, (D0, D2)[i % 2] + [("A", "x", i, 1.0 * i)] * 3, dt)
        for i, dt in enumerate(dates)
    }
    everything = days[dates[0]]
    for dt in dates[1:]:
        everything = everything.unionAll(days[dt])
    got = compare_all_dates(everything, rows_per_task=rows_per_task)
    none = everything.limit(0)
    for i, dt in enumerate(dates):
        before = days[dates[i - 2]] if i >= 2 else none
        one = got.where(F.col("dt_ptcm") == dt)
        assert bag(one.drop("dt_d2")) == bag(compare_snapshots(days[dt], before))


def test_compare_all_dates_beyond_the_broadcast_bound(spark, monkeypatch):
    df = refined(spark, D0, "20240101").unionAll(refined(spark, D2, "20240102"))
    expected = bag(compare_all_dates(df, back=1))
    monkeypatch.setattr("daymark.operators.compare.broadcast_if_small", lambda d: d)
    assert bag(compare_all_dates(df, back=1)) == expected


def test_small_rows(spark):
    df = spark.range(10).where("id >= 0")
    assert small.small_rows(df, 9) is None
    assert len(small.small_rows(df, 10)) == 10
    assert small.broadcast_if_small(df, 9) is df
    assert small.broadcast_if_small(df, 10).count() == 10


def test_summarise_nulls_and_overflow(spark):
    top = 2**63 - 1
    rows = [("A", "x", None, None), ("A", "x", None, 1.0), ("B", "y", top, 1.0), ("B", "y", 1, 3.0),
            (None, None, 4, 2.0), (None, None, 5, None)]
    assert bag(summarise(refined(spark, rows)).drop("dt_ptcm")) == Counter(
        [("A", "x", None, 1.0, 2), ("B", "y", None, 2.0, 2), (None, None, 9, 2.0, 2)]
    )


def test_summarise_aggregates_before_the_shuffle(spark):
    df = refined(spark, D0)
    lines = summarise(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    steps = [w for line in lines for w in ("HashAggregate", "Exchange") if w in line]
    assert steps == ["HashAggregate", "Exchange", "HashAggregate"]


def test_latest_capture_keeps_ties_and_dates_without_capture_time(spark, monkeypatch):
    rows = [("d1", 1.0, 1), ("d1", 2.0, 2), ("d1", 2.0, 3), ("d1", None, 4), ("d2", None, 5), (None, 1.0, 6)]
    df = spark.createDataFrame(rows, "dt_ptcm string, capture_ts double, i int")
    assert sorted(r.i for r in latest_capture(df).collect()) == [2, 3, 5, 6]
    one = df.where("dt_ptcm = 'd1'")
    assert sorted(r.i for r in latest_capture(one).collect()) == [2, 3]
    none = df.where("capture_ts is null")
    assert sorted(r.i for r in latest_capture(none).collect()) == [4, 5]
    monkeypatch.setattr("daymark.operators.captures.small_rows", lambda d: None)
    assert sorted(r.i for r in latest_capture(df).collect()) == [2, 3, 5, 6]


def test_one_dates_newest_capture_is_a_scan_filter(spark, tmp_path):
    spark.createDataFrame([("d1", 1.0, 1), ("d1", 2.0, 2)], "dt_ptcm string, capture_ts double, i int").write.parquet(
        f"{tmp_path}/c"
    )
    df = latest_capture(spark.read.parquet(f"{tmp_path}/c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(capture_ts,2.0)" in plan and "Join" not in plan


def test_latest_capture_does_not_shuffle_the_rows(spark):
    df = spark.range(100).selectExpr(
        "concat('d', id % 2) dt_ptcm", "cast(id % 3 as double) capture_ts", "id"
    )
    plan = latest_capture(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
