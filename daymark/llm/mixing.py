"""Mixing sources to target weights with hash-threshold histograms.

Every document has a hash of its id. A source's budget of words is met by taking the documents
whose hash lies below a threshold. The threshold is found without sorting: words are summed by
source and hash bucket, the bucket in which a source's budget ends is cut into finer buckets, and
only the documents of such boundary buckets are summed again, until one hash is left. Thresholds
are nested: what a smaller budget takes, a larger one takes too.

A source whose target is above its own size is taken whole once, and again below the threshold.
The hash decides alone, so reruns agree, and no task sees more than the partial sums of a source.

Edge cases: a null text has no words; a null source is a source, the last one; rows repeated with
their id share a hash and go together; a source without words gets and gives nothing; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.common import all_columns, broadcast_if_few, free_name, own_columns, stored

WEIGHTS = (3, 1, 2)  # by the sources' order, repeating
SHARE = 1.5  # of all words
MOST_EPOCHS = 2
HASH_BITS = 60
LEVEL_BITS = 12  # so 4096 buckets per source and level
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def id_hash(doc_id: Column | str) -> Column:
    """The first 60 bits of the MD5 of the id as text; a null id has that of an empty one."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """(source, source_size, target) from (source, size).

    ``share`` of all words is dealt by weight; a source that would get more than ``most_epochs``
    times its size gets that, and the rest is dealt again among the others, until none is above.
    Each round is one sum over a row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int")
    ).cast("double")
    sources = stored(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_rank", F.row_number().over(order))
        .select("source", "source_size", weight.alias("weight")),
        "sources",
    )
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    limit = F.col("source_size") * F.lit(float(most_epochs))
    level = 0.0  # words per unit of weight
    while True:
        above = F.col("weight") * F.lit(level) > limit
        at_limit, open_weight = sources.agg(
            F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        raised = (budget - at_limit) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    return sources.select(
        "source", "source_size", F.least(F.col("weight") * F.lit(level), limit).alias("target")
    )


def _thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, threshold) so that the sizes of hashes below add up to about ``wanted``.

    ``sizes`` is (source, hash, size), ``wanted`` is (source, wanted). The document at the
    boundary is taken if that is nearer to the budget.
    """
    # Where each source's boundary lies: hashes >> shift == prefix; below it, ``before`` words.
    open_ = wanted.select(
        "source", "wanted", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before")
    )
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("hash", shift)
        edges = broadcast_if_few(open_)
        inside = sizes.join(edges, sizes["source"].eqNullSafe(edges["source"])).where(
            F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")
        )
        histogram = inside.groupBy(
            sizes["source"], "wanted", "before", bucket.alias("bucket")
        ).agg(F.sum("size").alias("words"), F.min("hash").alias("least"), F.max("hash").alias("most"))
        own = Window.partitionBy("source").orderBy("bucket")  # 4096 rows at most
        summed = histogram.withColumn("to", F.col("before") + F.sum("words").over(own))
        # The first bucket that reaches the budget; the last one, if none does.
        reached = summed.where(F.col("to") >= F.col("wanted")).groupBy("source", "wanted")
        open_ = stored(
            reached.agg(
                F.min_by(F.struct("bucket", "to", "words", "least", "most"), "bucket").alias("b")
            ).select(
                "source",
                "wanted",
                F.col("b.bucket").alias("prefix"),
                (F.col("b.to") - F.col("b.words")).alias("before"),
                F.col("b.words").alias("words"),
                F.col("b.least").alias("least"),
                F.col("b.most").alias("most"),
            ),
            "boundary",
        )
        if not open_.where("least < most").limit(1).count():
            break
    over = F.col("before") + F.col("words") - F.col("wanted")
    return open_.select(
        "source",
        F.when(over < F.col("wanted") - F.col("before"), F.col("most") + 1)
        .otherwise(F.col("least"))
        .alias("threshold"),
    )


def plan(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> tuple[DataFrame, DataFrame]:
    """The sizes of (doc_id, source, text), and how each source is taken.

    The second is (_source, source_size, target, whole, threshold): ``whole`` times all documents,
    and once more those with a hash below the threshold.
    """
    sizes = stored(
        own_columns(docs, "doc_id", "source", "text").select(
            "doc_id", "source", word_count("text").alias("size"), id_hash("doc_id").alias("hash")
        ),
        "sizes",
    )
    targets = stored(source_targets(sizes, weights, share, most_epochs), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    taken = targets.withColumn("whole", whole.cast("long"))
    wanted = taken.select(
        "source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("wanted")
    ).where("wanted > 0")
    bounds = _thresholds(sizes.select("source", "hash", "size"), wanted)
    bounds = bounds.withColumnRenamed("source", "_source")
    taken = taken.join(bounds, taken["source"].eqNullSafe(F.col("_source")), "left").drop("_source")
    none = F.lit(0).cast("long")
    taken = taken.withColumn("threshold", F.coalesce("threshold", none))
    return sizes, stored(taken.withColumnRenamed("source", "_source"), "plan")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of (doc_id, text, source).

    ``taken`` is the words that the mix takes of the document: its size as often as it is
    repeated, 0 where it is left out.
    """
    sizes, taken = plan(docs, weights, share, most_epochs)
    taken = broadcast_if_few(taken)
    times = F.col("whole") + (F.col("hash") < F.col("threshold")).cast("long")
    return sizes.join(taken, sizes["source"].eqNullSafe(taken["_source"])).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does, numbered by ``copy``.

    All columns of ``docs`` stay; if it has a column ``copy``, the number is ``copy_``.
    """
    _, taken = plan(docs, weights, share, most_epochs)
    copy = free_name(docs, "copy")
    source, whole, threshold, times = (
        free_name(docs, f"_mix_{x}") for x in ("source", "whole", "threshold", "times")
    )
    taken = broadcast_if_few(
        taken.select(
            F.col("_source").alias(source), F.col("whole").alias(whole), F.col("threshold").alias(threshold)
        )
    )
    extra = (id_hash("doc_id") < F.col(threshold)).cast("long")
    rows = docs.join(taken, docs["source"].eqNullSafe(taken[source]))
    rows = rows.withColumn(times, F.col(whole) + extra).where(F.col(times) > 0)
    numbers = F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))
    return rows.select(*all_columns(docs), numbers.alias(copy))
