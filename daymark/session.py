"""Session settings the jobs are meant to run with. The library itself sets none."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Splits skewed join partitions and large leaves of a partitioned write, and joins
    # small sides found at run time by broadcast.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose partitions have all turned out this small needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Days are taken from capture times in this zone.
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder
