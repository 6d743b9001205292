"""Forecast contract: gate, horizon dates, exact line, bounds, isolation."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from ratelake.plans import forecast as fc

GOLD = "currency_pair string, date date, rate double"


def gold(spark, pairs):
    rows = []
    for pair, start, values in pairs:
        for i, v in enumerate(values):
            rows.append((pair, start + timedelta(days=i), v))
    return spark.createDataFrame(rows, GOLD)


def wiggle(n, a=2.0, b=0.5):
    return [a + b * i + (0.1 if i % 3 == 0 else -0.05) for i in range(n)]


def test_gate_counts_rows_before_dropping_nulls(spark):
    g = gold(
        spark,
        [
            ("A", date(2024, 1, 1), wiggle(29)),
            ("B", date(2024, 1, 1), wiggle(30)),
            ("C", date(2024, 1, 1), [None, None, *wiggle(28)]),
        ],
    )
    out = fc.forecast(g, run_ts="2024-03-01 00:00:00")
    got = {r.currency_pair: r.training_rows for r in out.select("currency_pair", "training_rows").distinct().collect()}
    assert got == {"B": 30, "C": 30}
    _, skipped = fc.fit_default_model(g)
    assert {(r.currency_pair, r.reason) for r in skipped.collect()} == {("A", "too_few_rows")}


def test_horizon_dates_follow_each_pair(spark):
    g = gold(spark, [("A", date(2024, 1, 1), wiggle(40)), ("B", date(2024, 1, 5), wiggle(31))])
    out = fc.forecast(g, horizon=30).collect()
    for pair, last in (("A", date(2024, 2, 9)), ("B", date(2024, 2, 4))):
        days = sorted(r.forecast_date for r in out if r.currency_pair == pair)
        assert days == [last + timedelta(days=h) for h in range(1, 31)]


def test_exact_line_is_recovered(spark):
    g = gold(spark, [("L", date(2024, 1, 1), [2.0 + 0.5 * i for i in range(40)])])
    model, _ = fc.fit_default_model(g)
    m = model.first()
    assert m.a == pytest.approx(2.0) and m.b == pytest.approx(0.5) and m.sigma == pytest.approx(0.0, abs=1e-9)
    first = fc.forecast(g).orderBy("forecast_date").first()
    assert first.yhat == pytest.approx(2.0 + 0.5 * 40, abs=1e-8)


def test_bounds_ordered_and_width_monotone(spark):
    g = gold(spark, [("A", date(2024, 1, 1), wiggle(60))])
    narrow = {r.forecast_date: r for r in fc.forecast(g, interval_width=0.80).collect()}
    wide = {r.forecast_date: r for r in fc.forecast(g, interval_width=0.99).collect()}
    for d, r in wide.items():
        assert r.yhat_lower <= r.yhat <= r.yhat_upper
        assert (r.yhat_upper - r.yhat_lower) > (narrow[d].yhat_upper - narrow[d].yhat_lower)
    with pytest.raises(ValueError):
        fc.z_value(1.0)


def test_single_date_pair_is_skipped_others_unaffected(spark):
    g = gold(spark, [("ONE", date(2024, 1, 1), [1.0]), ("OK", date(2024, 1, 1), wiggle(10))])
    out = fc.forecast(g, min_rows=1)
    assert {r.currency_pair for r in out.select("currency_pair").distinct().collect()} == {"OK"}
    _, skipped = fc.fit_default_model(g, min_rows=1)
    assert [(r.currency_pair, r.reason) for r in skipped.collect()] == [("ONE", "degenerate_fit")]


def test_output_schema_enforced(spark):
    g = gold(spark, [("A", date(2024, 1, 1), wiggle(30))])
    out = fc.forecast(g)
    assert out.schema.simpleString() == fc.FORECAST_SCHEMA.simpleString()


def test_pandas_model_contract(spark):
    g = gold(spark, [("A", date(2022, 1, 1), wiggle(800)), ("S", date(2024, 1, 1), wiggle(10))])
    out = fc.forecast_pandas(g, run_ts="2024-03-01 00:00:00", horizon=14).collect()
    assert {r.currency_pair for r in out} == {"A"}
    assert len(out) == 14
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out)
    assert min(r.forecast_date for r in out) == date(2022, 1, 1) + timedelta(days=800)


def test_split_fit_equals_plain_fit(spark):
    g = gold(spark, [("A", date(2024, 1, 1), wiggle(60)), ("B", date(2024, 1, 5), wiggle(31, b=-0.2)), ("S", date(2024, 1, 1), wiggle(3))])
    plain, split = (sorted(tuple(r) for r in fc.forecast(g, run_ts="2024-03-01 00:00:00", split=s).collect()) for s in (False, True))
    assert [r[:2] for r in plain] == [r[:2] for r in split] and len(plain) == 60
    for a, b in zip(plain, split, strict=True):
        assert a[2:5] == pytest.approx(b[2:5])
    assert [r.reason for r in fc.fit_default_model(g, split=True)[1].collect()] == ["too_few_rows"]


def test_infinite_rates_are_skipped_with_a_reason(spark):
    g = gold(spark, [("I", date(2024, 1, 1), [*wiggle(30), float("inf")]), ("A", date(2024, 1, 1), wiggle(30))])
    assert {r.currency_pair for r in fc.forecast(g).collect()} == {"A"}
    assert [(r.currency_pair, r.reason) for r in fc.fit_default_model(g)[1].collect()] == [("I", "non_finite_fit")]
    done, skipped = fc.split_outcomes(fc.fit_predict_pandas(g, horizon=3))
    assert {r.currency_pair for r in done.collect()} == {"A"}
    assert [(r.currency_pair, r.n_rows, r.reason) for r in skipped.collect()] == [("I", 31, "non_finite_fit")]


@pytest.mark.parametrize("n", [40, 729, 731])
def test_yearly_terms_are_kept_at_every_length(spark, n):
    g = gold(spark, [("A", date(2022, 1, 1), wiggle(n))])
    a, b = (fc.forecast_pandas(g, horizon=2, yearly=y).orderBy("forecast_date").first().yhat for y in (True, False))
    assert a != b


def test_job_writes_forecasts_and_skipped_pairs(spark, tmp_dir):
    g = gold(spark, [("A", date(2024, 1, 1), wiggle(40)), ("S", date(2024, 1, 1), wiggle(5))])
    g.write.parquet(f"{tmp_dir}/gold")
    for model in ("default", "grouped"):
        out = fc.run_forecasting(spark, f"{tmp_dir}/gold", f"{tmp_dir}/fc", 5, model=model, skipped_path=f"{tmp_dir}/skipped")
        assert out.count() == 5
        assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/skipped").collect()] == [("S", 5, "too_few_rows")]
    # No forecast: the file of the run before stays, the reasons are written.
    assert fc.run_forecasting(spark, f"{tmp_dir}/gold", f"{tmp_dir}/fc", 5, min_rows=99, skipped_path=f"{tmp_dir}/skipped") is None
    assert spark.read.parquet(f"{tmp_dir}/fc").count() == 5 and spark.read.parquet(f"{tmp_dir}/skipped").count() == 2
    with pytest.raises(ValueError, match="Unknown forecast model"):
        fc.run_forecasting(spark, f"{tmp_dir}/gold", f"{tmp_dir}/fc", model="none")


def test_split_fit_keeps_a_null_pair(spark):
    g = gold(spark, [(None, date(2024, 1, 1), wiggle(40)), ("B", date(2024, 1, 1), wiggle(35))])
    plain, split = ({(r.currency_pair, r.last_date, r.n_rows, round(r.sigma, 9)) for r in fc.fit_default_model(g, split=s)[0].collect()} for s in (False, True))
    assert plain == split and {r[0] for r in split} == {None, "B"}
    for g, names in ((g, []), (gold(spark, [(None, date(2024, 1, 1), wiggle(5))]), [(None, "too_few_rows")])):
        for s in (False, True):
            assert [(r.currency_pair, r.reason) for r in fc.fit_default_model(g, split=s)[1].collect()] == names
