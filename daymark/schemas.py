"""Column names and types of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

DATE_COL = "dt_ptcm"
CAPTURE_COL = "capture_ts"
KEYS = ("codigo", "acao")

# The two header dialects a raw file can carry, per refined column.
HEADERS = {
    "codigo": ("Código", "Code"),
    "acao": ("Ação", "Stock"),
    "tipo": ("Tipo", "Type"),
    "qt_teorica": ("Qtde. Teórica", "Theoretical Qty"),
    "pc_participacao": ("Part. (%)", "Participation (%)"),
}

# Headers in the order the cells of a captured table row have.
CAPTURE_NAMES = tuple(english for _, english in HEADERS.values())

RENAMES = {header: name for name, headers in HEADERS.items() for header in headers}


def _strings(names) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


# Both dialects side by side: a file holds one of them, the other reads as null.
RAW_SCHEMA = StructType(
    _strings(RENAMES)
    + [StructField(CAPTURE_COL, DoubleType()), StructField(DATE_COL, StringType())]
)

REFINED_SCHEMA = StructType(
    _strings(("codigo", "acao", "tipo"))
    + [
        StructField("qt_teorica", LongType()),
        StructField("pc_participacao", DoubleType()),
        StructField(DATE_COL, StringType()),
    ]
)

# Result table names, columns, and partition columns (last in the schema).
SUMMARY_TABLE = "tb_agrupamento"
SUMMARY_PARTITIONS = (DATE_COL, "acao")
SUMMARY_SCHEMA = StructType(
    [
        StructField("codigo", StringType()),
        StructField("soma_qt_teorica", LongType()),
        StructField("media_pc_participacao", DoubleType()),
        StructField("qtd_registros", LongType()),
        StructField(DATE_COL, StringType()),
        StructField("acao", StringType()),
    ]
)

COMPARISON_TABLE = "tb_comparacao"
COMPARISON_SCHEMA = StructType(
    [
        StructField("codigo", StringType()),
        StructField("acao", StringType()),
        StructField("data_atual", StringType()),
        StructField("diff_qt_teorica", LongType()),
        StructField("diff_pc_participacao", DoubleType()),
    ]
)

# The comparison of all dates, partitioned by its newer date.
DATES_COMPARISON_SCHEMA = StructType(
    [
        StructField("codigo", StringType()),
        StructField("acao", StringType()),
        StructField("diferenca_qt_teorica", LongType()),
        StructField("diferenca_pc_participacao", DoubleType()),
        StructField("dt_d2", StringType()),
        StructField(DATE_COL, StringType()),
    ]
)

# The comparison job's column names -> the table's column names.
COMPARISON_RENAMES = {
    DATE_COL: "data_atual",
    "diferenca_qt_teorica": "diff_qt_teorica",
    "diferenca_pc_participacao": "diff_pc_participacao",
}
