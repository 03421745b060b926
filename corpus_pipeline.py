"""From raw documents to a training mix, in five stages.

Each stage is written as Parquet to the shared folder and read again by the next, so a lost executor
never costs more than the stage at hand. All stages but the last return the columns of the
documents; the last one adds ``copy``, which numbers a document's repetitions.

Edge cases, stage by stage:

- Null and empty texts, and texts without a letter, have no language and go in the first stage. Very
  long texts are read whole by every stage.
- A null language or source is a value: the first stage doesn't learn from documents without a
  language, the last one mixes those without a source as a source of their own, the last in order.
- Ties: of near copies the document with the smallest id stays; scores exactly at a bound stay.
- Repeated rows: the first two stages and decontamination judge each alike; of rows that repeat an id
  and its text near-copy removal keeps one. Rows without an id are never dropped by it, nor by
  decontamination.
- Other columns go along unchanged, whatever their names; if there is a ``copy``, the last stage's is
  ``copy_`` (and so on).
- Empty tables give no rows, with the same columns. Without labels of both kinds nothing is rejected
  by quality, without benchmark items nothing by decontamination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daymark.llm import cotrain, decontaminate, jaccard, langid, mixing
from daymark.llm.common import stored, table

# What the stage of near copies takes for one; ``op3_jaccard`` has bounds of its own.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the models learn from these same documents."""
    return langid.accepted(docs, langid.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    return cotrain.accepted(docs, cotrain.train(docs, table(spark, sf_dir, "labels")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return jaccard.one_of_each_group(docs, percent=NEAR_PERCENT, size=NEAR_WORDS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much benchmark text."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixing.mixed(docs)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("deduplicated", deduplicated),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
]

# Models, links and the classifier cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages for the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
