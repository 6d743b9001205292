"""Schemas of every layer.

The gold schema is derived from the configured windows instead of being
hard-coded, so ``windows=(5, 20)`` gives ``ma_5, ma_20``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Default parameters of the pipeline.
DEFAULT_WINDOWS: tuple[int, ...] = (7, 30, 90)
DEFAULT_VOLATILITY_WINDOW = 30
MIN_VALID_RATE = 1e-6
MAX_VALID_RATE = 1e5
FORECAST_HORIZON_DAYS = 30
MIN_TRAINING_ROWS = 30
INTERVAL_WIDTH = 0.95
OUTLIER_Z = 2.0

# One landing record per (base, date). Rates stay text so that "0.93" and
# 0.93 both survive the JSON reader; they are cast with try_cast later.
LANDING_SCHEMA = StructType(
    [
        StructField("base", StringType()),
        StructField("date", StringType()),
        StructField("rates", MapType(StringType(), StringType())),
        StructField("fetched_at", StringType()),
        StructField("source", StringType()),
    ]
)

# The layers' column names, types and order.
BRONZE_SCHEMA = StructType(
    [
        StructField("ingestion_date", DateType()),
        StructField("base_currency", StringType()),
        StructField("target_currency", StringType()),
        StructField("rate", DoubleType()),
        StructField("source", StringType()),
        StructField("ingested_at", TimestampType()),
    ]
)

SILVER_SCHEMA = StructType(
    [
        StructField("date", DateType()),
        StructField("currency_pair", StringType()),
        StructField("base_currency", StringType()),
        StructField("target_currency", StringType()),
        StructField("rate", DoubleType()),
        StructField("prev_rate", DoubleType()),
        StructField("daily_return", DoubleType()),
        StructField("processed_at", TimestampType()),
    ]
)

FORECAST_SCHEMA = StructType(
    [
        StructField("currency_pair", StringType()),
        StructField("forecast_date", DateType()),
        StructField("yhat", DoubleType()),
        StructField("yhat_lower", DoubleType()),
        StructField("yhat_upper", DoubleType()),
        StructField("model_trained_at", TimestampType()),
        StructField("training_rows", IntegerType()),
    ]
)


def ma_name(n: int) -> str:
    return f"ma_{n}"


def volatility_name(n: int) -> str:
    return f"volatility_{n}"


def gold_schema(
    windows: Sequence[int] = DEFAULT_WINDOWS,
    volatility_window: int = DEFAULT_VOLATILITY_WINDOW,
) -> StructType:
    """Gold schema for the given moving-average windows and volatility window."""
    fields = [
        StructField("date", DateType()),
        StructField("currency_pair", StringType()),
        StructField("rate", DoubleType()),
        StructField("daily_return", DoubleType()),
    ]
    fields += [StructField(ma_name(n), DoubleType()) for n in windows]
    fields += [
        StructField(volatility_name(volatility_window), DoubleType()),
        StructField("rate_z_score", DoubleType()),
        StructField("created_at", TimestampType()),
    ]
    return StructType(fields)


GOLD_SCHEMA = gold_schema()
