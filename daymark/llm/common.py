"""What the operators share: tables, the folder for intermediate data, size checks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Rows of a few numbers that may be broadcast: some 20 MB in each executor.
MAX_BROADCAST_ROWS = 500_000
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``).

    Where that is unset, a session in one process gets a folder of its own, once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        base = tempfile.mkdtemp(prefix="daymark-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/daymark-llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df``, a stored table of narrow rows, has at most ``most`` rows."""
    return df.limit(most + 1).count() <= most


def broadcast_if_few(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else for a shuffled join."""
    return F.broadcast(df) if few(df, most) else df


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of at most BATCH_ROWS rows.

    Spark's default of 10,000 rows is tens of megabytes of texts, held on both sides. Only a
    larger setting is changed.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: others never clash with what an operator adds."""
    return df.select(*(F.col(f"`{name}`") for name in names))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def all_columns(df: DataFrame) -> list:
    """The columns of ``df`` by their whole names, which may contain dots."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def kept_rows(rows: DataFrame, work: Callable, schema: StructType) -> DataFrame:
    """``work``, from and to Arrow batches, over ``rows``; it returns their first columns, as ``schema``.

    Spark doesn't hand over columns with dots in their names, so these go by other names meanwhile.
    """
    names = [c if re.fullmatch(r"\w+", c) else f"_column_{i}" for i, c in enumerate(rows.columns)]
    if names == rows.columns:
        return rows.mapInArrow(work, schema)
    fields = [StructField(name, f.dataType, f.nullable) for name, f in zip(names, schema)]
    return rows.toDF(*names).mapInArrow(work, StructType(fields)).toDF(*schema.names)
