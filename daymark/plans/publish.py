"""Loads that readers see all at once.

Every load writes its leaves under a version of its own, beside what is there. A state file of the
version says, for every leaf partition, which version holds its rows; a view joins the two. Readers
use the view, and replacing it is one step in the catalog: before it they see the old leaves, after
it the new ones, and a load that breaks off anywhere before shows nothing. The next load takes the
state of the last view and a new version.

Under ``BASE/NAME_versoes``: ``versao=N/dt_ptcm=.../acao=.../`` the leaves, ``_estado/N`` the state,
``_usadas/N`` a marker by which a version is taken by one load only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daymark import catalog, schemas
from daymark.local import local_frame
from daymark.operators import conform
from daymark.sinks import gather_leaves
from daymark.sinks.files import hadoop
from daymark.sources import read_refined

VERSION_COL = "versao"
SUMMARY_NAME, COMPARISON_NAME = "agrupamento", "comparacao"
KEPT_VERSIONS = 2


class Published:
    """A result whose rows are stored by version, and the view that shows those published."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        name: str,
        database: str,
        view: str,
        schema: StructType,
        partitions: Sequence[str] = (),
    ):
        self.spark, self.database, self.view, self.schema = spark, database, view, schema
        self.partitions = list(partitions)
        self.root = f"{base.rstrip('/')}/{name}_versoes"
        self.store = f"{view}_versoes"
        self.state_schema = StructType(
            [schema[p] for p in self.partitions] + [StructField(VERSION_COL, LongType())]
        )

    def published(self) -> int:
        """The version that the view shows; 0 if there is no view."""
        return catalog.view_version(self.spark, self.database, self.view)

    def claim(self) -> int:
        """A version that no other load has or gets."""
        version = self.published()
        while True:
            version += 1
            path, files = hadoop(self.spark, f"{self.root}/_usadas/{version}")
            if files.createNewFile(path):
                return version

    def write(self, rows: DataFrame, version: int) -> None:
        """The leaves of a version. Nobody reads them yet."""
        path = f"{self.root}/{VERSION_COL}={version}"
        rows = conform(rows, self.schema)
        if self.partitions:
            gather_leaves(rows, self.partitions).write.partitionBy(*self.partitions).parquet(path)
        else:
            rows.write.parquet(path)

    def leaves(self, version: int) -> DataFrame:
        """The partitions that a version has rows for: one row if the result has none."""
        path = f"{self.root}/{VERSION_COL}={version}"
        rows = self.spark.read.schema(self.schema).parquet(path)
        found = rows.select(*self.partitions).distinct() if self.partitions else self.spark.range(1)
        return found.select(*self.partitions, F.lit(version).cast("long").alias(VERSION_COL))

    def state(self, version: int) -> DataFrame:
        """Which version holds each leaf, as of a version."""
        if not version:
            return local_frame(self.spark, [], self.state_schema)
        return self.spark.read.schema(self.state_schema).parquet(f"{self.root}/_estado/{version}")

    def write_state(self, version: int, before: int, replaced: Sequence[str] = ()) -> None:
        """The state ``before`` with this version's leaves instead of their old ones.

        Of ``replaced`` dates all old leaves go.
        """
        new, old = self.leaves(version), self.state(before)
        if not self.partitions:
            old = old.limit(0)
        else:
            same = [old[p].eqNullSafe(new[p]) for p in self.partitions]
            old = old.join(new, same, "left_anti")
            if replaced:
                dates = old[self.partitions[0]]
                old = old.where(~F.coalesce(dates.isin(*replaced), F.lit(False)))
        old.unionByName(new).write.mode("overwrite").parquet(f"{self.root}/_estado/{version}")

    def register(self, version: int) -> None:
        """Make the leaves of a version known to the catalog, under the table of all versions."""
        fields = [f for f in self.schema if f.name not in self.partitions]
        stored = StructType(fields + [self.state_schema[VERSION_COL]] + [self.schema[p] for p in self.partitions])
        by = [VERSION_COL, *self.partitions]
        catalog.ensure_database(self.spark, self.database)
        values = self.leaves(version).select(*[F.col(c).cast("string") for c in by])
        catalog.register_external(
            self.spark, self.database, self.store, stored, self.root, by, values.toLocalIterator()
        )

    def show(self, version: int) -> None:
        """Let the view show a version: the one step that readers notice."""
        catalog.replace_view(
            self.spark,
            self.database,
            self.view,
            self.store,
            self.schema.names,
            [VERSION_COL, *self.partitions],
            f"{self.root}/_estado/{version}",
            version,
        )

    def publish(self, rows: DataFrame, replaced: Sequence[str] = ()) -> int:
        """Store ``rows`` as a new version and show it; returns its number."""
        before, version = self.published(), self.claim()
        self.write(rows, version)
        self.write_state(version, before, replaced)
        self.register(version)
        if self.published() != before:
            raise ValueError(f"{self.view} was published by another load, version {version} is not shown")
        self.show(version)
        return version

    def superseded(self, kept: int = KEPT_VERSIONS) -> DataFrame:
        """Leaves of the store that none of the last ``kept`` published states has, and that are
        older than the version shown."""
        now, used = self.published(), self.state(0)
        path, files = hadoop(self.spark, f"{self.root}/_estado/[0-9]*")
        states = sorted(int(s.getPath().getName()) for s in files.globStatus(path) or ())
        for version in [v for v in states if v <= now][-kept:]:
            used = used.unionByName(self.state(version))
        listed = self.spark.sql(f"SHOW PARTITIONS {catalog.full_name(self.database, self.store)}")
        parts = F.split("partition", "/")
        by = [VERSION_COL, *self.partitions]
        columns = [catalog.partition_value(parts[k]).alias(c) for k, c in enumerate(by)]
        stored = listed.select(*columns).withColumn(VERSION_COL, F.col(VERSION_COL).cast("long"))
        same = [stored[c].eqNullSafe(used[c]) for c in by]
        return stored.where(F.col(VERSION_COL) <= now).join(used.distinct(), same, "left_anti")

    def vacuum(self, kept: int = KEPT_VERSIONS) -> int:
        """Drop the superseded leaves and delete their files; returns how many they were.

        Queries that began before the last ``kept`` publications may still read them.
        """
        by = [VERSION_COL, *self.partitions]
        gone = 0
        for row in self.superseded(kept).toLocalIterator():
            where = catalog.drop_partition(self.spark, self.database, self.store, by, tuple(row[c] for c in by))
            if where:
                path, files = hadoop(self.spark, where)
                files.delete(path, True)
            gone += 1
        return gone


def summary_results(spark: SparkSession, base: str, database: str) -> Published:
    return Published(
        spark, base, SUMMARY_NAME, database, schemas.SUMMARY_TABLE, schemas.SUMMARY_SCHEMA, schemas.SUMMARY_PARTITIONS
    )


def comparison_results(spark: SparkSession, base: str, database: str) -> Published:
    return Published(
        spark, base, COMPARISON_NAME, database, schemas.COMPARISON_TABLE, schemas.COMPARISON_SCHEMA
    )


def publish(
    summary: DataFrame,
    comparison: DataFrame,
    base: str,
    database: str,
    replaced_dates: Sequence[str] = (),
) -> tuple[int, int]:
    """``load``, but readers see either result's new rows all at once, or its old ones.

    Leaves that ``summary`` has rows for replace those shown; of ``replaced_dates`` all others go
    as well. Returns the versions of both results.
    """
    spark = summary.sparkSession
    renamed = comparison.withColumnsRenamed(schemas.COMPARISON_RENAMES)
    return (
        summary_results(spark, base, database).publish(summary, replaced_dates),
        comparison_results(spark, base, database).publish(renamed),
    )


def publish_stored(
    spark: SparkSession, base: str, database: str, replaced_dates: Sequence[str] = ()
) -> tuple[int, int]:
    """``publish`` of the results that ``store_results`` left under ``base``."""
    summary, comparison = (
        read_refined(spark, f"{base}/results/{name}") for name in ("summary", "comparison")
    )
    return publish(summary, comparison, base, database, replaced_dates)
