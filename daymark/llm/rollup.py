"""Token counts as additive rollups that are kept up to date by signed deltas.

A batch brings changes of documents under one tokenizer version: a count (an insert, or a revised
count where there is one already), or none (a delete). What the changed documents counted before
is looked up in the log of earlier batches, and the difference, minus the old and plus the new,
is summed by source, language and tokenizer version. Totals are the sums of all committed
deltas, so nothing but the changes and their log entries is read again.

Layout of a rollup: ``log/batch=N`` has the changes, ``deltas/batch=N`` the signed sums, and
``commits/batch=N``, written last, makes both count. A batch that was committed is left
alone when it comes again; one that broke off is written anew. Batches are committed one after
the other, by ascending numbers.

Edge cases: a null document id, tokenizer, source or language is a value like others; of several
changes of a document in one batch that with the largest ``seq`` counts, then the largest count
(a null ``seq`` or a delete is smallest); deleting what is not there changes nothing; an empty
batch commits and changes nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.common import few, own_columns

KEY = ("doc_id", "tokenizer")
GROUP = ("source", "lang", "tokenizer")
LOG_SCHEMA = "doc_id long, tokenizer string, source string, lang string, tokens long, seq long"
DELTA_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"

# Two ways to count that every engine has; the count of any tokenizer may be given instead.
WORDS = r"[^\x20\x09-\x0D]+"
PIECES = r"[0-9A-Za-z]+|[^0-9A-Za-z\x20\x09-\x0D]"


def count_matches(text: Column | str, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)).cast("long"), F.lit(0).cast("long"))


def _batches(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows below ``path`` with their batch, or None if there are none yet."""
    try:
        return spark.read.schema(f"{schema}, batch long").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed(spark: SparkSession, base: str) -> DataFrame:
    """(batch) of all batches that count."""
    found = _batches(spark, f"{base}/commits", "done boolean")
    empty = spark.createDataFrame([], "batch long")
    return empty if found is None else found.select("batch")


def _before(spark: SparkSession, base: str, batch: int, changes: DataFrame) -> DataFrame | None:
    """The log entries of earlier batches for the changed documents, with the batch."""
    log = _batches(spark, f"{base}/log", LOG_SCHEMA)
    if log is None:
        return None
    done = F.broadcast(committed(spark, base))  # one number per batch
    log = log.where(F.col("batch") < batch).join(done, "batch", "left_semi")
    keys = changes.select(*(F.col(c).alias(f"_{c}") for c in KEY))
    if few(keys):
        keys = F.broadcast(keys)
    same = [log[c].eqNullSafe(keys[f"_{c}"]) for c in KEY]
    return log.join(keys, same, "left_semi")


def signed_deltas(changes: DataFrame, before: DataFrame | None) -> DataFrame:
    """The differences that ``changes`` make, summed as DELTA_SCHEMA has them.

    Both inputs meet in one shuffle by document; ``before`` may have several entries of one, of
    which the last batch's counts.
    """
    entry = F.struct("source", "lang", "tokens")
    rows = changes.select(*KEY, entry.alias("entry"), F.lit(None).cast("long").alias("batch"))
    if before is not None:
        rows = rows.unionByName(before.select(*KEY, entry.alias("entry"), "batch"))
    old = F.max_by(F.when(F.col("batch").isNotNull(), F.col("entry")), F.col("batch"))
    new = F.any_value(F.when(F.col("batch").isNull(), F.col("entry")), True)
    met = rows.groupBy(*KEY).agg(old.alias("old"), new.alias("new"))
    sides = F.array(
        F.struct(F.lit(-1).cast("long").alias("sign"), F.col("old").alias("entry")),
        F.struct(F.lit(1).cast("long").alias("sign"), F.col("new").alias("entry")),
    )
    return (
        met.select("tokenizer", F.explode(sides).alias("side"))
        .where(F.col("side.entry.tokens").isNotNull())
        .groupBy("side.entry.source", "side.entry.lang", "tokenizer")
        .agg(
            F.sum("side.sign").alias("docs"),
            F.sum(F.col("side.sign") * F.col("side.entry.tokens")).alias("tokens"),
        )
        .where("docs != 0 or tokens != 0")
        .select(*GROUP, "docs", "tokens")
    )


def commit(spark: SparkSession, base: str, batch: int, changes: DataFrame) -> bool:
    """Apply a batch of (doc_id, tokenizer, source, lang, tokens, seq); whether it was new.

    ``tokens`` is null for a delete.
    """
    if committed(spark, base).where(F.col("batch") == batch).limit(1).count():
        return False
    rank = F.struct(F.col("seq"), F.col("tokens"), F.col("source"), F.col("lang"))
    last = (
        own_columns(changes, *KEY, "source", "lang", "tokens", "seq")
        .groupBy(*KEY)
        .agg(F.max(rank).alias("last"))
        .select(*KEY, "last.source", "last.lang", "last.tokens", "last.seq")
    )
    log = f"{base}/log/batch={batch}"
    last.write.mode("overwrite").parquet(log)
    stored_changes = spark.read.schema(LOG_SCHEMA).parquet(log)
    before = _before(spark, base, batch, stored_changes)
    deltas = signed_deltas(stored_changes, before)
    deltas.write.mode("overwrite").parquet(f"{base}/deltas/batch={batch}")
    spark.range(1).select(F.lit(True).alias("done")).write.mode("overwrite").parquet(
        f"{base}/commits/batch={batch}"
    )
    return True


def totals(spark: SparkSession, base: str) -> DataFrame:
    """(source, lang, tokenizer, docs, tokens) of what all committed batches left."""
    deltas = _batches(spark, f"{base}/deltas", DELTA_SCHEMA)
    if deltas is None:
        return spark.createDataFrame([], DELTA_SCHEMA)
    return (
        deltas.join(F.broadcast(committed(spark, base)), "batch", "left_semi")
        .groupBy(*GROUP)
        .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        .where("docs != 0 or tokens != 0")
    )
