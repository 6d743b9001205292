"""Grouped aggregates over gold / silver tables.

All are ``groupBy`` aggregates, so Spark combines them map-side before the
shuffle: a hot key costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.operators.series import PAIR
from ratelake.schemas import MIN_TRAINING_ROWS


def row_counts(**frames: DataFrame) -> DataFrame:
    """``(layer, n_rows)`` for each named frame, one aggregate per frame, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def max_date(df: DataFrame, col: str = "date") -> DataFrame:
    return df.agg(F.max(col).alias("max_date"))


def return_stats(df: DataFrame, key: str = PAIR, digits: int = 4) -> DataFrame:
    """Mean, sample std, min and max of the daily return in percent, half-even rounded.

    NULL returns are excluded; a single-return key has a NULL std.
    """
    pct = F.col("daily_return") * F.lit(100.0)
    return (
        df.filter(F.col("daily_return").isNotNull())
        .groupBy(key)
        .agg(
            F.bround(F.avg(pct), digits).alias("mean_pct"),
            F.bround(F.stddev_samp(pct), digits).alias("std_pct"),
            F.bround(F.min(pct), digits).alias("min_pct"),
            F.bround(F.max(pct), digits).alias("max_pct"),
        )
    )


def avg_volatility(df: DataFrame, vol_col: str = "volatility_30", key: str = PAIR) -> DataFrame:
    """Average volatility per key, most volatile first."""
    return (
        df.filter(F.col(vol_col).isNotNull())
        .groupBy(key)
        .agg(F.avg(vol_col).alias("avg_vol"))
        .orderBy(F.col("avg_vol").desc(), F.col(key))
    )


def volatility_pivot(df: DataFrame, pairs: Sequence[str] | None = None, vol_col: str = "volatility_30") -> DataFrame:
    """date x pair matrix of volatility (mean per cell). Without ``pairs`` one distinct job finds them in the data."""
    cells = df.filter(F.col(vol_col).isNotNull())
    return cells.groupBy("date").pivot(PAIR, list(pairs) if pairs else None).agg(F.avg(vol_col))


def volatility_pivot_by_pair(df: DataFrame, dates: Sequence[str] | None = None, vol_col: str = "volatility_30") -> DataFrame:
    """Transposed matrix: one row per pair, one column per date (ISO text); all dates of the data unless given."""
    cells = df.filter(F.col(vol_col).isNotNull()).withColumn("_d", F.date_format("date", "yyyy-MM-dd"))
    return cells.groupBy(PAIR).pivot("_d", list(dates) if dates else None).agg(F.avg(vol_col))


def distinct_keys(df: DataFrame, key: str = PAIR) -> DataFrame:
    return df.select(key).distinct()


def latest_per_key(df: DataFrame, key: str = PAIR, order: str = "date") -> DataFrame:
    """The row with the greatest ``order`` of every key (``max_by`` is combined map-side)."""
    payload = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*payload), F.col(order)).alias("_r")).select(key, "_r.*")


def training_counts(df: DataFrame, min_rows: int = MIN_TRAINING_ROWS, key: str = PAIR) -> DataFrame:
    """Rows per key (counted before NULL rates are dropped) and the training gate."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("rate").alias("n_valid"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        .withColumn("eligible", F.col("n_rows") >= F.lit(min_rows))
    )
