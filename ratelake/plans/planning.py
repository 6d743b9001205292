"""Date spines and ingest planning as set operations.

Instead of looping over dates on the driver, requested dates are generated
with ``sequence`` and compared with what has landed using an anti-join.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.operators.quality import is_weekday


def _d(value: date | datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)[:10]).cast("date")


def date_spine(start, end) -> Column:
    """Inclusive calendar range as an array column (explode it to get rows)."""
    return F.sequence(_d(start), _d(end), F.expr("INTERVAL 1 DAY"))


def last_n_days(end, n: int) -> Column:
    """``n`` days ending at ``end`` inclusive."""
    e = _d(end)
    return F.sequence(F.date_sub(e, n - 1), e, F.expr("INTERVAL 1 DAY"))


def spine_per_key(df: DataFrame, key: str | list[str], date_col: str = "date", weekdays: bool = False) -> DataFrame:
    """Every calendar day between each key's first and last date (a generator per key, no cross join)."""
    keys = [key] if isinstance(key, str) else list(key)
    bounds = df.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    out = bounds.select(*keys, F.explode(date_spine(F.col("_lo"), F.col("_hi"))).alias(date_col))
    return out.filter(is_weekday(date_col)) if weekdays else out


def global_spine(df: DataFrame, date_col: str = "date", weekdays: bool = False) -> DataFrame:
    """Every calendar day between the table's first and last date."""
    out = df.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi")).select(
        F.explode(date_spine(F.col("_lo"), F.col("_hi"))).alias(date_col)
    )
    return out.filter(is_weekday(date_col)) if weekdays else out


def spine_summary(spine: DataFrame, date_col: str = "date") -> DataFrame:
    """Requested days, weekdays kept and weekend days skipped, in one aggregate."""
    wk = is_weekday(date_col)
    return spine.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(wk).alias("n_weekdays"),
        F.count_if(~wk).alias("n_skipped"),
    )


def dates_to_load(requested: DataFrame, present: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Requested (key, date) rows not yet landed; everything when ``force``."""
    if force:
        return requested
    return requested.join(present.select(*keys).distinct(), keys, "left_anti")


def fetch_label(date_col: str | Column = "date", run_date=None) -> Column:
    """``latest`` for the run date or later, else the ISO date (the historical endpoint)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    today = F.current_date() if run_date is None else _d(run_date)
    return F.when(d >= today, F.lit("latest")).otherwise(F.date_format(d, "yyyy-MM-dd"))
