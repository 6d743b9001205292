"""Bronze dedup and silver cleaning / returns."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ratelake.operators.frames import deduplicate, enforce_schema, require_columns
from ratelake.operators.quality import filter_valid_rates, rejected_counts
from ratelake.operators.series import add_currency_pair, add_date_column, compute_daily_returns
from ratelake.plans import layers
from ratelake.schemas import BRONZE_SCHEMA, SILVER_SCHEMA

RAW = "ingestion_date string, base_currency string, target_currency string, rate double, source string, ingested_at string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_latest_ingestion_wins(spark):
    df = raw(
        spark,
        [
            ("2024-01-15", "USD", "EUR", 0.92, "s", "2024-01-15T10:00:00"),
            ("2024-01-15", "USD", "EUR", 0.93, "s", "2024-01-15T11:00:00"),
        ],
    )
    out = layers.transform_to_bronze(df).collect()
    assert len(out) == 1 and out[0].rate == 0.93
    assert [f.dataType for f in layers.transform_to_bronze(df).schema] == [f.dataType for f in BRONZE_SCHEMA]


def test_tie_breaker_makes_dedup_deterministic(spark):
    df = raw(
        spark,
        [("2024-01-15", "USD", "EUR", 0.92, "s", "2024-01-15T10:00:00"), ("2024-01-15", "USD", "EUR", 0.95, "s", "2024-01-15T10:00:00")],
    ).withColumn("rid", F.when(F.col("rate") == 0.92, 2).otherwise(1))
    assert layers.transform_to_bronze(df, tie_breakers=["rid"]).first().rate == 0.92


def test_distinct_keys_survive(spark):
    df = raw(
        spark,
        [
            ("2024-01-13", "USD", "EUR", 0.90, "s", "2024-01-15T10:00:00"),
            ("2024-01-14", "USD", "EUR", 0.91, "s", "2024-01-15T10:00:00"),
            ("2024-01-15", "USD", "SEK", 10.45, "s", "2024-01-15T10:00:00"),
            ("2024-01-15", "USD", "GBP", 0.79, "s", "2024-01-15T10:00:00"),
        ],
    )
    assert layers.transform_to_bronze(df).count() == 4


def test_dedup_hot_key_many_copies(spark):
    df = spark.range(0, 20000).select(F.lit("k").alias("key"), F.col("id").alias("v"), (F.col("id") % 7).alias("w"))
    out = deduplicate(df, ["key"], ["w", "v"]).collect()
    assert len(out) == 1 and out[0].v == 19998 and out[0].w == 6


def test_enforce_schema_missing_and_extra(spark):
    df = raw(spark, [("2024-01-15", "USD", "EUR", 0.9, "s", "2024-01-15T10:00:00")]).withColumn("extra", F.lit(1))
    out = enforce_schema(df.withColumn("ingestion_date", F.to_date("ingestion_date")), BRONZE_SCHEMA)
    assert out.columns == BRONZE_SCHEMA.fieldNames()
    with pytest.raises(ValueError, match="rate"):
        require_columns(df.drop("rate"), BRONZE_SCHEMA.fieldNames())


def bronze_rows(spark, rows):
    return layers.transform_to_bronze(raw(spark, [(d, "USD", t, r, "s", "2024-01-20T00:00:00") for d, t, r in rows]))


def test_filter_removes_null_zero_negative_nan_inf_and_keeps_bounds(spark):
    df = bronze_rows(
        spark,
        [
            ("2024-01-01", "A", None),
            ("2024-01-01", "B", 0.0),
            ("2024-01-01", "C", -1.5),
            ("2024-01-01", "D", float("nan")),
            ("2024-01-01", "E", float("inf")),
            ("2024-01-01", "F", float("-inf")),
            ("2024-01-01", "G", 1e-6),
            ("2024-01-01", "H", 1e5),
            ("2024-01-01", "I", 0.92),
        ],
    )
    kept = sorted(r.target_currency for r in filter_valid_rates(df).collect())
    assert kept == ["G", "H", "I"]
    counts = {r.outcome: r.n_rows for r in rejected_counts(df).collect()}
    assert counts == {"valid": 3, "null_rate": 1, "below_min": 3, "nan_rate": 1, "above_max": 1}


def test_pair_and_rename(spark):
    df = add_date_column(add_currency_pair(bronze_rows(spark, [("2024-01-15", "EUR", 0.9), ("2024-01-15", "SEK", 10.4)])))
    assert sorted(r.currency_pair for r in df.collect()) == ["USD_EUR", "USD_SEK"]
    assert "date" in df.columns and "ingestion_date" not in df.columns


def test_returns_first_null_then_simple_return(spark):
    s = layers.transform_to_silver(
        bronze_rows(spark, [("2024-01-13", "EUR", 0.90), ("2024-01-14", "EUR", 0.92), ("2024-01-15", "EUR", 0.91)]),
        run_ts="2024-02-01 00:00:00",
    )
    rows = s.orderBy("date").collect()
    assert rows[0].daily_return is None and rows[0].prev_rate is None
    assert rows[1].daily_return == pytest.approx(0.92 / 0.90 - 1, rel=1e-4)
    assert s.columns == SILVER_SCHEMA.fieldNames()


def test_pairs_are_independent(spark):
    s = layers.transform_to_silver(
        bronze_rows(
            spark,
            [
                ("2024-01-14", "EUR", 0.90),
                ("2024-01-15", "EUR", 0.92),
                ("2024-01-14", "SEK", 10.0),
                ("2024-01-15", "SEK", 10.5),
                ("2024-01-14", "GBP", 0.78),
                ("2024-01-15", "GBP", 0.79),
            ],
        )
    )
    got = {(r.currency_pair, str(r.date)): r.daily_return for r in s.collect()}
    assert got[("USD_SEK", "2024-01-14")] is None
    assert got[("USD_SEK", "2024-01-15")] == pytest.approx(0.05)
    assert got[("USD_GBP", "2024-01-15")] == pytest.approx(0.79 / 0.78 - 1)


def test_zero_previous_rate_gives_null_return(spark):
    df = spark.createDataFrame([("p", "2024-01-01", 0.0), ("p", "2024-01-02", 1.0)], "currency_pair string, d string, rate double")
    out = compute_daily_returns(df.withColumn("date", F.to_date("d"))).orderBy("date").collect()
    assert out[1].prev_rate == 0.0 and out[1].daily_return is None


def test_invalid_rows_dropped_in_silver(spark):
    s = layers.transform_to_silver(bronze_rows(spark, [("2024-01-15", "EUR", -0.5), ("2024-01-15", "SEK", 10.45), ("2024-01-15", "GBP", 0.79)]))
    assert s.count() == 2 and all(r.rate > 0 for r in s.collect())
    assert not math.isnan(s.agg(F.sum("rate")).first()[0])
