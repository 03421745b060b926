"""Snapshot dates in partition paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymark.schemas import DATE_COL


def partition_date(path: Column | str, strict: bool = False) -> Column:
    """The 8 digits of a ``dt_ptcm=YYYYMMDD`` path element, null where there is none.

    The digits need not be a calendar date; ``strict`` also requires that.
    """
    digits = F.regexp_extract(path, rf"(?:^|/){DATE_COL}=([0-9]{{8}})(?:/|$)", 1)
    valid = digits != ""
    if strict:
        # The parser also takes years of more than four digits, but not in 8 characters.
        valid = valid & F.try_to_date(digits, "yyyyMMdd").isNotNull()
    return F.when(valid, digits)
