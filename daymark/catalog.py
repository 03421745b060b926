"""External tables over the result files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import batched

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}{where}")


def _bare(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def _is_registered(
    spark: SparkSession, full: str, schema: StructType, path: str, partitions: Sequence[str]
) -> bool:
    """Whether the table exists with exactly this definition."""
    if not spark.catalog.tableExists(full):
        return False
    if spark.catalog.getTable(full).tableType != "EXTERNAL":
        raise ValueError(f"{full} exists and is not an external table")
    columns = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(full)]
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").where("col_name = 'Location'").first()
    return _bare(details["data_type"]) == _bare(path) and columns == [
        (f.name, f.dataType.simpleString(), f.name in partitions) for f in schema
    ]


def register_external(
    spark: SparkSession,
    database: str,
    table: str,
    schema: StructType,
    path: str,
    partitions: Sequence[str] = (),
    added: Iterable[tuple] | None = None,
) -> None:
    """Create the table over existing files, or replace its definition; the files stay.

    An unchanged definition is kept with the partitions it has. If ``added`` gives the
    partition values that were written since, only those are registered, whether the
    definition is new or not; otherwise all partition directories are looked up. Replacing is a drop and a
    create: a reader may find no table in between. A managed table of that name is
    refused, because dropping it would delete its data.
    """
    full = f"{_name(database)}.{_name(table)}"
    if _is_registered(spark, full, schema, path, partitions):
        if added is not None:
            add_partitions(spark, database, table, partitions, added)
        else:
            repair_partitions(spark, database, table, partitions)
        spark.catalog.refreshTable(full)
        return
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(map(_name, partitions))})" if partitions else ""
    spark.sql(f"CREATE TABLE {full} ({columns}) USING PARQUET{by} LOCATION {_text(path)}")
    if added is None:
        repair_partitions(spark, database, table, partitions)
    else:
        add_partitions(spark, database, table, partitions, added)


def repair_partitions(
    spark: SparkSession, database: str, table: str, partitions: Sequence[str]
) -> None:
    """Match the registered partitions to the directories; nothing to do without partitions."""
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {_name(database)}.{_name(table)} SYNC PARTITIONS")


def _partition(partitions: Sequence[str], values: Sequence) -> str:
    """A partition of strings or numbers; empty text is stored as null."""
    texts = ["null" if v is None or v == "" else _text(str(v)) for v in values]
    pairs = [f"{_name(c)} = {text}" for c, text in zip(partitions, texts)]
    return f"PARTITION ({', '.join(pairs)})"


def add_partitions(
    spark: SparkSession,
    database: str,
    table: str,
    partitions: Sequence[str],
    values: Iterable[tuple],
    per_statement: int = 500,
) -> None:
    """Register partitions by their values, known ones included, without a look at the files."""
    for batch in batched((_partition(partitions, v) for v in values), per_statement):
        clauses = " ".join(sorted(set(batch)))
        spark.sql(f"ALTER TABLE {full_name(database, table)} ADD IF NOT EXISTS {clauses}")


def full_name(database: str, table: str) -> str:
    return f"{_name(database)}.{_name(table)}"


def partition_value(part: Column) -> Column:
    """The value in a part ``column=value`` of a partition's name; null for the default one."""
    value = F.url_decode(F.replace(F.substring_index(part, "=", -1), F.lit("+"), F.lit("%2B")))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value)


def drop_partition(
    spark: SparkSession, database: str, table: str, partitions: Sequence[str], values: tuple
) -> str | None:
    """Forget one partition of an external table; returns where its files are."""
    full, spec = full_name(database, table), _partition(partitions, values)
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {full} {spec}").where("col_name = 'Location'")
    where = details.first()
    spark.sql(f"ALTER TABLE {full} DROP IF EXISTS {spec}")
    return where["data_type"] if where else None


VERSION_PROPERTY = "daymark.version"


def view_version(spark: SparkSession, database: str, view: str) -> int:
    """The version that a view of published rows shows; 0 if there is no view."""
    full = full_name(database, view)
    if not spark.catalog.tableExists(full):
        return 0
    if spark.catalog.getTable(full).tableType != "VIEW":
        raise ValueError(f"{full} exists and is not a view of published rows")
    properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}
    return int(properties[VERSION_PROPERTY])


def replace_view(
    spark: SparkSession,
    database: str,
    view: str,
    store: str,
    columns: Sequence[str],
    keys: Sequence[str],
    state: str,
    version: int,
) -> None:
    """Let a view show those rows of ``store`` whose ``keys`` are in the ``state`` files.

    One statement: readers have the old definition or the new one.
    """
    path = "`" + state.replace("`", "``") + "`"
    shown = ", ".join(f"rows_.{_name(c)}" for c in columns)
    same = " AND ".join(f"rows_.{_name(k)} <=> state_.{_name(k)}" for k in keys)
    spark.sql(
        f"CREATE OR REPLACE VIEW {full_name(database, view)} "
        f"TBLPROPERTIES ({_text(VERSION_PROPERTY)} = {_text(str(version))}) AS "
        f"SELECT {shown} FROM {full_name(database, store)} AS rows_ "
        f"JOIN parquet.{path} AS state_ ON {same}"
    )
