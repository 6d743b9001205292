"""The forecast by normal equations: against numpy's solution, known seasonality, interval, gate and plan."""

from __future__ import annotations

from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest

from ratelake.plans import seasonal
from ratelake.plans.forecast import run_forecasting, z_value
from ratelake.schemas import FORECAST_SCHEMA, GOLD_SCHEMA

START = date(2021, 1, 4)
TS = "2024-01-01 00:00:00"


def series(days, level=1.2, slope=1e-4, season=0.05, noise=0.002, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(days):
        d = START + timedelta(days=k)
        n = (d - date(1970, 1, 1)).days
        rate = level + slope * k + season * np.sin(2 * np.pi * n / 365.25) + 0.01 * (d.weekday() == 4) + noise * rng.standard_normal()
        out.append((d, float(rate)))
    return out


@pytest.fixture(scope="module")
def gold(spark):
    rows = [("USD_EUR", *r) for r in series(1000)]
    rows += [("USD_GBP", *r) for r in series(400, 0.8, -2e-4, 0.02, seed=1)]
    rows += [(None, *r) for r in series(200, 3.0, seed=2)]
    rows += [("USD_FEW", *r) for r in series(10)]
    rows += [("USD_ONE", START, 1.0)] * 40
    rows += [("USD_GAP", d, r if k < 5 else None) for k, (d, r) in enumerate(series(40))]
    rows += [("USD_NUL", d, None) for d, _ in series(40)]
    rows += [("USD_NAN", d, float("nan")) for d, _ in series(40)]
    return spark.createDataFrame(rows, "currency_pair string, date date, rate double").repartition(3)


@pytest.fixture(scope="module")
def result(gold):
    fc, skipped = seasonal.forecast_seasonal(gold, run_ts=TS)
    return fc.collect(), skipped.collect()


def columns(days, first, span):
    n = np.array([(d - date(1970, 1, 1)).days for d in days], dtype=float)
    t = (n - first) / span
    x = [np.ones_like(t), t, *(np.maximum(t - k, 0) for k in seasonal.KNOTS), *(np.array([d.weekday() == w for d in days], dtype=float) for w in range(1, 7))]
    for k in (1, 2):
        x += [np.sin(2 * np.pi * k * n / 365.25), np.cos(2 * np.pi * k * n / 365.25)]
    return np.stack(x, axis=1)


def test_matches_a_direct_solution(result):
    fc, _ = result
    first, span = (START - date(1970, 1, 1)).days, 999
    for pair, rows in (("USD_EUR", series(1000)), ("USD_GBP", series(400, 0.8, -2e-4, 0.02, seed=1)), (None, series(200, 3.0, seed=2)), ("USD_GAP", series(40)[:5])):
        x, y = columns([d for d, _ in rows], first, span), np.array([r for _, r in rows])
        a = x.T @ x + np.diag([0, 0, 1, 1, 1, 1] + [0.1] * 10)
        inverse = np.linalg.inv(a)
        beta = inverse @ x.T @ y
        sigma = np.sqrt(max(y @ y - beta @ (x.T @ y), 0) / max(len(y) - 6, 1))
        mine = sorted((r for r in fc if r.currency_pair == pair), key=lambda r: r.forecast_date)
        assert len(mine) == 30
        ahead = columns([r.forecast_date for r in mine], first, span)
        assert np.allclose([r.yhat for r in mine], ahead @ beta, rtol=1e-6, atol=1e-6)
        half = z_value() * sigma * np.sqrt(1 + np.einsum("ri,ij,rj->r", ahead[:, :6], inverse[:6, :6], ahead[:, :6]))
        assert np.allclose([r.yhat_upper - r.yhat for r in mine], half, rtol=1e-4, atol=1e-9)


def test_follows_the_year(result):
    """A season of 0.05 over the year: the forecast of a 1,000-day series stays near the truth, a line would not."""
    mine = sorted((r for r in result[0] if r.currency_pair == "USD_EUR"), key=lambda r: r.forecast_date)
    truth = [r for _, r in series(1030, noise=0.0)][1000:]
    assert max(abs(r.yhat - v) for r, v in zip(mine, truth, strict=True)) < 0.01


def test_interval_grows_with_the_lead(result):
    for pair in {r.currency_pair for r in result[0]}:
        mine = sorted((r for r in result[0] if r.currency_pair == pair), key=lambda r: r.forecast_date)
        width = [r.yhat_upper - r.yhat_lower for r in mine]
        assert all(b > a > 0 for a, b in zip(width, width[1:], strict=False)), pair


def test_gate_and_reasons(result, gold):
    fc, skipped = result
    assert Counter(r.currency_pair for r in fc) == dict.fromkeys(["USD_EUR", "USD_GBP", None, "USD_GAP"], 30)
    assert {(r.currency_pair, r.n_rows, r.reason) for r in skipped} == {
        ("USD_FEW", 10, "too_few_rows"),
        ("USD_ONE", 40, "degenerate_fit"),
        ("USD_NUL", 40, "degenerate_fit"),
        ("USD_NAN", 40, "non_finite_fit"),
    }
    fc, skipped = seasonal.forecast_seasonal(gold.where("1 = 0"), run_ts=TS)
    assert fc.count() == skipped.count() == 0


def test_one_exchange_and_partial_sums(gold):
    fc, _ = seasonal.forecast_seasonal(gold, run_ts=TS)
    plan = fc._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(currency_pair") == 1 and "partial_sum" in plan
    assert "Join" not in plan and "Window" not in plan and "Python" not in plan and "Pandas" not in plan


def test_job_with_the_seasonal_model(spark, gold, tmp_dir):
    full = gold.where("currency_pair IN ('USD_EUR', 'USD_FEW')")
    for f in GOLD_SCHEMA:
        if f.name not in full.columns:
            full = full.withColumn(f.name, seasonal.F.lit(None).cast(f.dataType))
    full.select(*[f.name for f in GOLD_SCHEMA]).write.parquet(f"{tmp_dir}/gold")
    out = run_forecasting(spark, f"{tmp_dir}/gold", f"{tmp_dir}/fc", model="seasonal", skipped_path=f"{tmp_dir}/skipped", run_ts=TS)
    assert out.schema == FORECAST_SCHEMA and out.count() == 30
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/skipped").collect()] == [("USD_FEW", 10, "too_few_rows")]
