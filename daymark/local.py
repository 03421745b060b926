"""Values that the driver has, as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A local relation: it takes no Python worker, and the planner knows its size."""
    columns = [pa.array([row[i] for row in rows]) for i in range(len(schema))]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)
