"""Left equi-join that stays balanced when a few keys hold much of either side.

Adaptive execution splits only the left side of a left outer join, and cannot help
when one key's right rows, or identical copies of one row, are too many for a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, isqrt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.local import local_frame
from daymark.operators.small import small_rows

# The rows of a key on one side are cut into pieces of at most this size, and into
# smaller ones if a pair of pieces would give more than PAIRS_PER_ROW times as many rows.
ROWS_PER_TASK = 1_000_000
PAIRS_PER_ROW = 200
# More hot keys than this are not held as values.
MAX_KNOWN = 20_000
# Rows are first counted per hash bucket of their key; a bucket that is small on both
# sides has no hot key, and its keys are not counted one by one.
BUCKETS = 8192
# With more rows than this in large buckets, summaries of frequent items, of bounded size, choose
# the keys that are counted one by one. Each holds up to SUMMARY_ITEMS keys.
SUMMARY_FROM_ROWS = 50_000_000
SUMMARY_ITEMS = 4096
MAX_HOT_TASKS = 20_000
TASKS_FOR_WORK = 3
# However small the pieces, a task takes as many as make work of this many rows: a task per handful
# of rows costs far more than the rows.
LEAST_ROWS_PER_TASK = 20_000


class HotKeys(NamedTuple):
    """``frame`` has the keys, ``_left_splits`` and ``_right_splits``; None if no key is hot.

    ``nulls`` says whether many left rows share keys with a null, ``cells`` how many
    pairs of pieces the hot keys make.
    """

    frame: DataFrame | None
    nulls: bool
    cells: int = 0


def _matches_nothing(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(key).isNull() for key in keys])


def _sides(left: DataFrame, right: DataFrame, *columns: Column | str) -> DataFrame:
    return left.select(F.lit("left").alias("_side"), *columns).unionAll(
        right.select(F.lit("right").alias("_side"), *columns)
    )


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _heavy_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at_least: int
) -> dict[int, int]:
    """The buckets with more than ``at_least`` rows of a side, and the larger side's rows.

    No hot key is missed, as its bucket is no smaller. Each task counts before the
    shuffle, and the driver gets one number per bucket.
    """
    counts = (
        _sides(left, right, _bucket(keys).alias("_bucket"))
        .groupBy("_side", "_bucket")
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > at_least)
    )
    found: dict[int, int] = {}
    for row in counts.collect():
        found[row["_bucket"]] = max(found.get(row["_bucket"], 0), row["_rows"])
    return found


def frequent_hashes(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at_least: int, rows: int
) -> DataFrame:
    """``_hash`` of every key with more than ``at_least`` rows of a side, and of few others.

    Summaries of frequent items that tasks merge: one misses no item with more than twice its
    rows over the items it has room for, so keys are dealt to as many summaries, by hash, as it
    takes for sides of ``rows`` rows. All in all they name some ``rows / at_least`` keys, whatever
    the number of distinct ones.
    """
    room = 0.75 * SUMMARY_ITEMS * at_least / 2
    # Twice as many as needed, as groups are uneven.
    groups = 2 * ceil(rows / room)
    key = F.xxhash64(*keys).alias("_hash")
    return (
        _sides(left, right, key)
        .groupBy("_side", F.pmod(F.xxhash64("_hash"), F.lit(groups)).alias("_group"))
        .agg(F.expr(f"approx_top_k(_hash, {SUMMARY_ITEMS}, {SUMMARY_ITEMS})").alias("_items"))
        .select(F.explode("_items").alias("_item"))
        # The estimates are upper bounds.
        .where(F.col("_item.count") > at_least)
        .select(F.col("_item.item").alias("_hash"))
        .distinct()
    )


def _suspects(
    df: DataFrame, keys: Sequence[str], buckets: dict[int, int], hashes: DataFrame | None
) -> DataFrame:
    """The rows whose keys are counted one by one."""
    if len(buckets) < BUCKETS // 2:
        df = df.where(_bucket(keys).isin(sorted(buckets)))
    if hashes is None:
        return df
    rows = small_rows(hashes, MAX_KNOWN)
    if rows is not None:
        return df.where(F.xxhash64(*keys).isin([row["_hash"] for row in rows]))
    return df.withColumn("_hash", F.xxhash64(*keys)).join(hashes, "_hash", "left_semi").drop("_hash")


def _splits(own: str, other: str, rows_per_task: int) -> Column:
    """Into how many pieces ``own`` rows of a key are cut that meet ``other`` rows each."""
    pairs = rows_per_task * PAIRS_PER_ROW
    by_pairs = F.floor(F.lit(pairs) / F.greatest(F.col(other), F.lit(1)))
    piece = F.least(F.lit(rows_per_task), F.greatest(F.lit(isqrt(pairs)), by_pairs))
    return F.greatest(F.lit(1), F.ceil(F.col(own) / piece)).cast("long")


def find_hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> HotKeys:
    """The keys whose rows or pairs are too many for one task, however many rows there are.

    One pass over the key columns of both sides; only if that finds heavy buckets are keys in
    them counted, with a partial count in each task. Beyond SUMMARY_FROM_ROWS rows in such buckets
    these are the keys that another pass finds frequent. Few hot keys are held as values; more
    than can be broadcast stay a frame, for a shuffled join.
    """
    return _find(left, right, keys, rows_per_task)[0]


def _find(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows_per_task: int
) -> tuple[HotKeys, float]:
    """The hot keys, and how many tasks' work their rows and pairs are."""
    at_least = min(rows_per_task, isqrt(rows_per_task * PAIRS_PER_ROW))
    for_task = max(rows_per_task, LEAST_ROWS_PER_TASK)
    buckets = _heavy_buckets(left, right, keys, at_least)
    if not buckets:
        return HotKeys(None, False), 0.0
    rows, hashes = sum(buckets.values()), None
    if rows > SUMMARY_FROM_ROWS:
        inside = [_suspects(df.select(*keys), keys, buckets, None) for df in (left, right)]
        hashes = frequent_hashes(*inside, keys, at_least, rows)
    left, right = (_suspects(df, keys, buckets, hashes) for df in (left, right))
    grid = "_left_splits", "_right_splits"
    pairs = F.col("_left_rows").cast("double") * F.greatest("_right_rows", F.lit(1))
    hot = (
        _sides(left, right, *keys)
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("_side") == "left").alias("_left_rows"),
            F.count_if(F.col("_side") == "right").alias("_right_rows"),
        )
        .where(F.greatest("_left_rows", "_right_rows") > at_least)
        .withColumn(grid[0], _splits("_left_rows", "_right_rows", rows_per_task))
        .withColumn(grid[1], _splits("_right_rows", "_left_rows", rows_per_task))
        .withColumn("_matchless", _matches_nothing(keys))
        .where(
            F.when(F.col("_matchless"), F.col("_left_rows") > rows_per_task).otherwise(
                F.greatest(*grid) > 1
            )
        )
        .withColumn(
            "_work",
            F.greatest(
                pairs / (for_task * PAIRS_PER_ROW),
                (F.col("_left_rows") * F.col(grid[1]) + F.col("_right_rows") * F.col(grid[0])) / for_task,
            ),
        )
        .select(*keys, *grid, "_matchless", "_work")
    )
    rows = small_rows(hot, MAX_KNOWN)
    if rows is None:
        matchless = F.col("_matchless")
        nulls = bool(hot.where(matchless).limit(1).count())
        hot = hot.where(~matchless).drop("_matchless")
        cells, work = hot.agg(F.sum(F.col(grid[0]) * F.col(grid[1])), F.sum("_work")).first()
        return HotKeys(hot.drop("_work") if cells else None, nulls, cells or 0), work or 0.0
    nulls = any(row["_matchless"] for row in rows)
    known = [row for row in rows if not row["_matchless"]]
    if not known:
        return HotKeys(None, nulls), 0.0
    schema = hot.drop("_matchless", "_work").schema
    cells = sum(row[grid[0]] * row[grid[1]] for row in known)
    frame = local_frame(left.sparkSession, [tuple(row)[:-2] for row in known], schema)
    return HotKeys(F.broadcast(frame), nulls, cells), sum(row["_work"] for row in known)


def _pieces(df: DataFrame, own: str, other: str, own_axis: str, other_axis: str) -> DataFrame:
    """Hot rows laid out on a grid of ``own`` x ``other`` cells.

    Identical rows are first counted, which leaves one row per task and content.
    Each content goes to a cell chosen by its hash, and many copies to several,
    evenly. No random number is used: a recomputed task gives the same cells.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    parts = F.least("_copies", own)
    place = F.pmod(F.xxhash64(*df.columns), F.col(own)) + F.col("_part")
    zero = F.lit(0).cast("long")
    return (
        counted.withColumn("_part", F.explode(F.sequence(zero, parts - 1)))
        .withColumn(own_axis, F.pmod(place, F.col(own)))
        .withColumn(
            "_copies",
            F.floor(F.col("_copies") / parts)
            + F.when(F.col("_part") < F.col("_copies") % parts, 1).otherwise(0),
        )
        .withColumn(other_axis, F.explode(F.sequence(zero, F.col(other) - 1)))
        .drop("_part")
    )


def _hot_join(left: DataFrame, right: DataFrame, keys: Sequence[str], tasks: int) -> DataFrame:
    """Left join of the rows of hot keys; each left piece meets each right piece once.

    The number of tasks is given: the few bytes of counted rows would otherwise be
    coalesced into few tasks, though their pairs are many.

    A left row is repeated for every right piece of its key. Where there are several,
    the key has right rows, so a repetition that meets an empty piece is dropped and
    the row still appears with its partners.
    """
    rows = _pieces(left, "_left_splits", "_right_splits", "_x", "_y")
    partners = (
        _pieces(right, "_right_splits", "_left_splits", "_y", "_x")
        .drop("_left_splits", "_right_splits")
        .withColumnRenamed("_copies", "_partner_copies")
    )
    by = [*keys, "_x", "_y"]
    joined = rows.repartition(tasks, *by).join(partners.repartition(tasks, *by), by, "left")
    joined = joined.where(
        F.col("_partner_copies").isNotNull() | (F.col("_right_splits") == 1)
    )
    once = F.lit(1).cast("long")
    for copies in (F.col("_copies"), F.coalesce("_partner_copies", once)):
        joined = joined.withColumn("_again", F.explode(F.sequence(once, copies)))
    return joined


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``left.join(right, keys, "left")`` with hot keys spread over many tasks.

    Columns other than the keys must have different names on the two sides. Without
    hot keys the plan is the plain join.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    out = [*left.columns, *payload]
    hot, work = _find(left, right, keys, rows_per_task)
    # Cells are dealt out by hash, so there are some more tasks than full ones.
    tasks = max(min(hot.cells, TASKS_FOR_WORK * ceil(work), MAX_HOT_TASKS), 1)

    branches = []
    if hot.nulls:
        matchless = _matches_nothing(keys)
        empty = {c: F.lit(None).cast(right.schema[c].dataType) for c in payload}
        branches.append(left.where(matchless).withColumns(empty))
        left = left.where(~matchless)
    if hot.frame is not None:
        known = hot.frame
        branches.append(_hot_join(left.join(known, keys), right.join(known, keys), keys, tasks))
        left, right = (df.join(known, keys, "left_anti") for df in (left, right))
    branches.append(left.join(right, keys, "left"))
    return reduce(DataFrame.unionByName, [branch.select(*out) for branch in branches])
