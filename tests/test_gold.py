"""Gold features: rolling frames, volatility, z-score, derived schema."""

from __future__ import annotations

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ratelake.operators.series import add_rate_z_score_by_join, latest_change, rolling_average, tail_rows, z_score_column
from ratelake.plans import layers
from ratelake.schemas import gold_schema

SILVER = "date date, currency_pair string, base_currency string, target_currency string, rate double, prev_rate double, daily_return double, processed_at timestamp"


def sine_silver(spark, n_days=60, pairs=(("USD_EUR", 0.92),)):
    rows = []
    for pair, base in pairs:
        prev = None
        for i in range(n_days):
            r = base + 0.02 * math.sin(i / 5)
            ret = None if prev is None else r / prev - 1
            rows.append((date(2024, 1, 1) + timedelta(days=i), pair, "USD", pair[4:], r, prev, ret, None))
            prev = r
    return spark.createDataFrame(rows, SILVER)


def series(spark, values, pair="P", returns=None):
    rows = [
        (date(2024, 1, 1) + timedelta(days=i), pair, "B", "T", float(v), None, None if returns is None else returns[i], None)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SILVER)


def test_gold_columns_and_schema(spark):
    g = layers.transform_to_gold(sine_silver(spark, 20), run_ts="2024-03-01 00:00:00")
    assert g.columns == gold_schema().fieldNames()
    assert g.filter(F.col("ma_7").isNull()).count() == 0


def test_partial_row_frames(spark):
    g = layers.transform_to_gold(series(spark, range(1, 11))).orderBy("date").collect()
    assert g[9].ma_7 == 7.0  # mean of 4..10
    assert g[2].ma_7 == 2.0  # partial frame: mean of 1..3
    assert g[0].ma_90 == 1.0


def test_constant_series_moving_average(spark):
    g = layers.transform_to_gold(series(spark, [1.0] * 10)).collect()
    assert all(r.ma_7 == 1.0 for r in g)
    assert all(r.rate_z_score is None for r in g)  # stddev 0 -> NULL, not a divide-by-zero failure


def test_constant_return_volatility_zero_and_first_rows_null(spark):
    g = layers.transform_to_gold(series(spark, range(1, 36), returns=[None] + [0.001] * 34)).orderBy("date").collect()
    assert g[0].volatility_30 is None and g[1].volatility_30 is None
    assert all(abs(r.volatility_30) < 1e-10 for r in g[2:])


def test_volatility_non_negative_and_z_mean_zero(spark):
    g = layers.transform_to_gold(sine_silver(spark, 60, (("USD_EUR", 0.92), ("USD_SEK", 10.45), ("USD_GBP", 0.79))))
    assert g.count() == 180
    assert g.filter(F.col("volatility_30") < 0).count() == 0
    for r in g.groupBy("currency_pair").agg(F.avg("rate_z_score").alias("m")).collect():
        assert abs(r.m) < 1e-6


def test_gold_idempotent(spark):
    s = sine_silver(spark, 30)
    a = layers.transform_to_gold(s, run_ts="2024-03-01 00:00:00").collect()
    b = layers.transform_to_gold(s, run_ts="2024-03-01 00:00:00").collect()
    assert sorted(a) == sorted(b)


def test_gold_schema_follows_windows(spark):
    g = layers.transform_to_gold(sine_silver(spark, 30), windows=(5, 20), volatility_window=10)
    assert {"ma_5", "ma_20", "volatility_10"} <= set(g.columns)
    assert "ma_7" not in g.columns


def test_duplicate_dates_guarded(spark):
    s = series(spark, [1.0, 2.0, 3.0]).unionByName(series(spark, [1.0, 5.0, 3.0]))
    assert layers.transform_to_gold(s).count() == 3


def test_calendar_day_frames_skip_gaps(spark):
    rows = [(date(2024, 1, d), "P", "B", "T", float(d), None, None, None) for d in (1, 2, 10)]
    df = spark.createDataFrame(rows, SILVER)
    out = rolling_average(df, 7, calendar_days=True, alias="ma").orderBy("date").collect()
    assert [r.ma for r in out] == [1.0, 1.5, 10.0]
    rows_frame = rolling_average(df, 7, alias="ma").orderBy("date").collect()
    assert rows_frame[2].ma == pytest.approx(13 / 3)


def test_z_score_join_equals_window(spark):
    s = sine_silver(spark, 40)
    w = {(r.date, r.currency_pair): r.rate_z_score for r in layers.transform_to_gold(s).collect()}
    j = {(r.date, r.currency_pair): r.rate_z_score for r in add_rate_z_score_by_join(s).collect()}
    assert all(w[k] == pytest.approx(j[k], abs=1e-12) for k in w)


def test_latest_change_and_tail(spark):
    df = series(spark, [1.0, 2.0, 4.0]).unionByName(series(spark, [5.0], pair="Q"))
    got = {r.currency_pair: r.change_pct for r in latest_change(df).collect()}
    assert got == {"P": 100.0, "Q": 0.0}
    assert tail_rows(df, 2).count() == 3


def test_split_strategy_equals_plain_windows(spark):
    s = sine_silver(spark, 50, (("USD_EUR", 0.92), ("USD_SEK", 10.45)))
    plain = layers.transform_to_gold(s, windows=(3, 5), volatility_window=4, run_ts="2024-03-01 00:00:00")
    split = layers.transform_to_gold(s, windows=(3, 5), volatility_window=4, run_ts="2024-03-01 00:00:00", split_chunk_rows=6)
    a = {(r.date, r.currency_pair): r for r in plain.collect()}
    b = {(r.date, r.currency_pair): r for r in split.collect()}
    assert a.keys() == b.keys()
    for k, r in a.items():
        for c in ("ma_3", "ma_5", "volatility_4", "rate_z_score"):
            assert (r[c] is None and b[k][c] is None) or r[c] == pytest.approx(b[k][c], abs=1e-12)
    with pytest.raises(ValueError, match="chunk_rows"):
        layers.transform_to_gold(s, split_chunk_rows=10)


def test_row_positions_across_blocks_with_gaps(spark):
    from ratelake.operators.series import row_positions

    days = [0, 1, 2, 9, 10, 30, 31, 32, 33, 60]
    rows = [(date(2024, 1, 1) + timedelta(days=d), p, "B", "T", 1.0, None, None, None) for d in days for p in ("P", "Q")]
    df = spark.createDataFrame(rows, SILVER)
    out = row_positions(df, block_days=7).collect()
    for pair in ("P", "Q"):
        got = sorted((r.date, r._pos) for r in out if r.currency_pair == pair)
        assert [p for _, p in got] == list(range(len(days)))
    split = layers.transform_to_gold(df, windows=(3,), volatility_window=2, split_chunk_rows=3)
    plain = layers.transform_to_gold(df, windows=(3,), volatility_window=2)
    assert sorted((r.date, r.currency_pair, r.ma_3) for r in split.collect()) == sorted(
        (r.date, r.currency_pair, r.ma_3) for r in plain.collect()
    )


def test_split_forms_keep_rows_without_a_date(spark):
    s = sine_silver(spark, 20).unionByName(spark.createDataFrame([(None, "USD_EUR", "USD", "EUR", 1.0, None, None, None)], SILVER))
    for days in (False, True):
        plain = layers.transform_to_gold(s, windows=(3,), volatility_window=2, calendar_days=days)
        split = layers.transform_to_gold(s, windows=(3,), volatility_window=2, calendar_days=days, split_chunk_rows=4)
        a, b = ({r.date: (r.ma_3, r.volatility_2) for r in x.collect()} for x in (plain, split))
        assert len(a) == 21 and a.keys() == b.keys()
        for k in a:
            assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_silver_split_equals_plain(spark):
    bronze = "ingestion_date date, base_currency string, target_currency string, rate double, source string, ingested_at timestamp"
    rows = [(date(2024, 1, 1) + timedelta(days=3 * i), "USD", t, 1.0 + 0.1 * i, "s", None) for i in range(25) for t in ("EUR", "SEK")]
    df = spark.createDataFrame([*rows, (None, "USD", "EUR", 2.0, "s", None), (date(2024, 1, 1), "USD", "SEK", -1.0, "s", None)], bronze)
    a, b = (
        sorted((tuple(r) for r in layers.transform_to_silver(df, run_ts="2024-03-01 00:00:00", split_chunk_rows=n).collect()), key=str)
        for n in (None, 4)
    )
    assert a == b and len(a) == 51


def test_z_score_by_join_keeps_a_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 4.0), ("A", 3.0), ("A", 5.0)], "currency_pair string, rate double")
    plain = df.withColumn("rate_z_score", z_score_column()).collect()
    split = add_rate_z_score_by_join(df).collect()
    key = lambda rows: sorted((str(r.currency_pair), r.rate, round(r.rate_z_score, 9)) for r in rows)
    assert split[0].__fields__ == plain[0].__fields__ and key(split) == key(plain)


def test_blocks_equal_plain_windows_on_sparse_null_and_constant_series(spark):
    import random
    from datetime import date, timedelta

    draw = random.Random(5)
    rows = []
    for pair, step in (("DENSE", 1), ("SPARSE", 40), (None, 7), ("FLAT", 3)):
        day = date(2001, 1, 1)
        for k in range(60):
            rate = 0.1 if pair == "FLAT" else round(draw.uniform(1, 2), 6)
            rows.append((day, pair, None if k % 11 == 5 and pair != "FLAT" else rate, None if k == 0 else draw.uniform(-0.1, 0.1)))
            day += timedelta(days=draw.randint(1, step))
    rows += [(None, "DENSE", 1.5, 0.0), (date(2001, 1, 1), "ONE", 2.0, None), (date(2001, 1, 1), "NO", None, None)]
    silver = spark.createDataFrame(rows, "date date, currency_pair string, rate double, daily_return double")

    def table(split):
        g = layers.transform_to_gold(silver, windows=(3, 7), volatility_window=5, run_ts="2024-03-01 00:00:00", split_chunk_rows=split)
        return {(r.currency_pair, r.date): [None if r[c] is None else round(r[c], 9) for c in ("rate", "daily_return", "ma_3", "ma_7", "volatility_5", "rate_z_score")] for r in g.collect()}

    plain = table(None)
    assert len(plain) == len(rows)
    assert table(6) == plain and table(50) == plain
    assert all(v[-1] is None for (pair, _), v in plain.items() if pair in ("FLAT", "ONE", "NO"))
