"""Serving views and analytical queries."""

from __future__ import annotations

from datetime import date

from ratelake.operators import aggregates as agg
from ratelake.operators.quality import outliers, select_pairs
from ratelake.plans import serving

GOLD = "date date, currency_pair string, rate double, daily_return double, ma_7 double, ma_30 double, ma_90 double, volatility_30 double, rate_z_score double"


def gold(spark):
    rows = []
    for d in range(1, 11):
        rows.append((date(2024, 1, d), "A", 1.0 + d, 0.01 * d, 1.0, 1.0, 1.0, 0.1, 2.0 if d == 3 else 0.5 * d / 10))
    for d in range(1, 10):
        rows.append((date(2024, 1, d), "B", 2.0 + d, None, 2.0, 2.0, 2.0, None if d < 3 else 0.3, -2.5 if d == 4 else 0.0))
    return spark.createDataFrame(rows, GOLD)


def test_latest_global_vs_per_pair(spark):
    g = gold(spark)
    assert [r.currency_pair for r in serving.latest_rates(g).collect()] == ["A"]
    per = {r.currency_pair: r.date for r in serving.latest_per_pair(g).collect()}
    assert per == {"A": date(2024, 1, 10), "B": date(2024, 1, 9)}


def test_outliers_strict_and_top_k(spark):
    g = gold(spark)
    assert [r.currency_pair for r in outliers(g).collect()] == ["B"]  # z = 2.0 exactly is not an outlier
    top = serving.top_outliers(g, k=1, threshold=1.0).collect()
    assert len(top) == 1 and top[0].rate_z_score == -2.5


def test_selection_empty_means_all(spark):
    g = gold(spark)
    assert select_pairs(g, []).count() == g.count()
    assert select_pairs(g, ["B"]).count() == 9


def test_return_stats_and_avg_volatility(spark):
    g = gold(spark)
    stats = {r.currency_pair: r for r in agg.return_stats(g).collect()}
    assert set(stats) == {"A"}
    assert stats["A"].mean_pct == 5.5 and stats["A"].min_pct == 1.0 and stats["A"].max_pct == 10.0
    vol = agg.avg_volatility(g).collect()
    assert [r.currency_pair for r in vol] == ["B", "A"]


def test_pivots(spark):
    g = gold(spark)
    p = agg.volatility_pivot(g, ["A", "B"])
    assert p.columns == ["date", "A", "B"] and p.count() == 10
    t = agg.volatility_pivot_by_pair(g, ["2024-01-01", "2024-01-05"])
    row = {r.currency_pair: r for r in t.collect()}
    assert row["A"]["2024-01-01"] == 0.1 and row["B"]["2024-01-01"] is None


def test_views_registry_and_sql(spark, tmp_dir):
    g = gold(spark)
    g.write.mode("overwrite").parquet(f"{tmp_dir}/gold")
    assert serving.load_parquet_as_table(spark, "gold_t", f"{tmp_dir}/gold") == 19
    assert serving.load_parquet_as_table(spark, "fc_t", f"{tmp_dir}/missing") == 0
    made = serving.create_views(spark, gold_table="gold_t", forecast_table="fc_t_absent")
    assert "v_forecast_summary" not in made and serving.table_exists(spark, "v_latest_rates")
    names = {r.table_name for r in serving.list_tables(spark).collect()}
    assert {"gold_t", "v_latest_rates", "v_latest_per_pair"} <= names
    out = serving.run_sql(spark, "SELECT count(*) AS n FROM gold_t WHERE currency_pair = :p", {"p": "A"}).first()
    assert out.n == 10


def test_forecast_summary_and_history(spark):
    fcs = spark.createDataFrame(
        [("A", date(2024, 1, 11), 12.0, 11.0, 13.5, None, 10)],
        "currency_pair string, forecast_date date, yhat double, yhat_lower double, yhat_upper double, model_trained_at timestamp, training_rows int",
    )
    s = serving.forecast_summary(fcs).first()
    assert s.uncertainty_range == 2.5 and s.forecast_rate == 12.0
    h = serving.history_and_forecast(gold(spark), fcs, history_rows=3)
    kinds = {(r.currency_pair, r.kind) for r in h.collect()}
    assert h.count() == 7 and ("A", "forecast") in kinds
    disp = serving.forecast_display(fcs)
    assert disp.columns == ["currency_pair", "Date", "Forecast", "Lower (95%)", "Upper (95%)"]


def test_chart_series(spark):
    g = gold(spark)
    r = serving.chart_returns(g, ["A"]).orderBy("date").first()
    assert r.daily_return_pct == 1.0
    assert serving.chart_rates_ma(g, None).columns == ["date", "currency_pair", "rate", "ma_7", "ma_30", "ma_90"]
    assert agg.distinct_keys(g).count() == 2
    assert agg.max_date(g).first().max_date == date(2024, 1, 10)
    counts = {r.currency_pair: r.eligible for r in agg.training_counts(g, min_rows=10).collect()}
    assert counts == {"A": True, "B": False}
