"""Projections: renaming, typing and shaping columns. All of them are narrow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymark.functions import parse_decimal_comma, parse_grouped_long
from daymark.schemas import CAPTURE_COL, DATE_COL, HEADERS


def quoted(name: str) -> Column:
    """A column by its whole name, which may contain dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; skip the others; keep order and the rest."""
    return df.withColumnsRenamed(dict(renames))


def refine(df: DataFrame) -> DataFrame:
    """Raw rows, in either header dialect or both, to typed refined rows.

    ``dt_ptcm`` and ``capture_ts`` are passed through where present.
    """
    present = set(df.columns)
    sources = {
        name: [h for h in (*headers, name) if h in present] for name, headers in HEADERS.items()
    }
    missing = [" / ".join(HEADERS[name]) for name, found in sources.items() if not found]
    if missing:
        raise ValueError(f"raw columns missing: {', '.join(missing)}")
    text = {name: F.coalesce(*map(quoted, found)) for name, found in sources.items()}
    text["qt_teorica"] = parse_grouped_long(text["qt_teorica"])
    text["pc_participacao"] = parse_decimal_comma(text["pc_participacao"])
    kept = [c for c in (DATE_COL, CAPTURE_COL) if c in present]
    return df.select(*[c.alias(name) for name, c in text.items()], *kept)


def apply_positional_schema(
    df: DataFrame, cells_col: str, names: Sequence[str], check: bool = True
) -> DataFrame:
    """Replace an array column by one column per name, the n-th cell under the n-th name.

    Short rows are padded with nulls. A row longer than ``names`` fails the query
    when it is read. ``check`` also refuses, right away and with one aggregate over
    the cell counts, input whose widest row is not exactly as wide as ``names``.
    """
    width = len(names)
    cells = quoted(cells_col)
    if check:
        widest = df.agg(F.max(F.size(cells))).first()[0]
        if widest is not None and widest != width:
            raise ValueError(f"{width} columns expected, widest row has {widest} cells")
    fitting = F.when(
        F.size(cells) > width,
        F.raise_error(F.format_string(f"{width} columns expected, row has %d cells", F.size(cells))),
    ).otherwise(cells)
    others = [quoted(c) for c in df.columns if c != cells_col]
    slim = df.select(*others, fitting.alias(cells_col))
    return slim.select(
        *others,
        *[F.try_element_at(cells, F.lit(i)).alias(name) for i, name in enumerate(names, start=1)],
    )


def conform(
    df: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename, order and cast columns to a declared table schema; extra columns go."""
    renamed = rename_columns(df, renames or {})
    missing = [f.name for f in schema if f.name not in renamed.columns]
    if missing:
        raise ValueError(f"columns missing for the table: {', '.join(missing)}")
    return renamed.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in schema])


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """The first ``n`` rows, of any order unless one is asked for."""
    return (df.orderBy(order_by) if order_by else df).limit(n)
