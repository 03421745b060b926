"""Refined rows and job results as Parquet directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_refined(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A job's output directory; with a schema, partition columns keep their declared types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
