"""Locale-formatted numbers. Malformed text and overflow become null, with ANSI on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_grouped_long(col: Column | str) -> Column:
    """``"1.234.567"`` -> ``1234567``: every dot is a thousands separator."""
    text = F.col(col) if isinstance(col, str) else col
    return F.replace(text, F.lit("."), F.lit("")).try_cast("bigint")


def parse_decimal_comma(col: Column | str) -> Column:
    """``"1,25"`` -> ``1.25``.

    Thousands dots are not removed, so ``"1.234,56"`` has two dots after the
    replacement and is null.
    """
    text = F.col(col) if isinstance(col, str) else col
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def difference(a: Column | str, b: Column | str) -> Column:
    """``a - b``; null if either side is null or a long difference overflows."""
    return F.try_subtract(a, b)
