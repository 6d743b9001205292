"""Small column helpers over built-in Spark functions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pair_part(pair: str | Column, index: int) -> Column:
    """Part ``index`` (0 = base, 1 = target) of a ``BASE_TARGET`` pair name."""
    return F.split(_c(pair), "_").getItem(index)


def iso_date(col: str | Column) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def weekday_number(col: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(col))
