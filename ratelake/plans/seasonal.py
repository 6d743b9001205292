"""Forecast with change points, weekly and yearly seasonality, fitted by normal equations.

Every gold row becomes a row x of the design matrix: 1, the time t, hinges max(t - knot, 0) at change points, an indicator per
weekday but Monday, sine and cosine of the year's harmonics. Time runs from 0 to 1 over the dates of all pairs, so the row
does not depend on its pair: one aggregate sums the products of all columns per pair, map-side first, and a pair of any
length is a few hundred sums. Each pair's equations (X'X + ridge) beta = X'y are then solved, with the inverse, by
Gauss-Jordan elimination on an array column. Change points and seasonality are ridge-penalised (as priors are in Taylor
and Letham, 2018), so a short history or a weekday without rows keeps them at 0; level and slope are not.

The interval of a forecast is that of a new observation: its standard deviation is
sigma * sqrt(1 + x' (X'X + ridge)^-1 x), x the trend columns at the forecast's date. It grows with the lead.

Plan: one small aggregate for the dates, then one exchange on the pair (none if gold is dealt by it); predicting is a
generator. Results: NULL rates count for the gate of ``min_rows`` but are not fitted; a NULL pair is a pair like others;
pairs below the gate, with fewer than two dates with a rate, or with a fit that is not finite are returned as skipped.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.operators.frames import enforce_schema, run_timestamp
from ratelake.operators.series import PAIR
from ratelake.plans.forecast import z_value
from ratelake.schemas import FORECAST_HORIZON_DAYS, FORECAST_SCHEMA, INTERVAL_WIDTH, MIN_TRAINING_ROWS

YEAR_DAYS = 365.25
KNOTS = (0.2, 0.4, 0.6, 0.8)


def design(day: Column, first: int, span: int, knots: Sequence[float] = KNOTS, harmonics: int = 2) -> list[Column]:
    """The columns of the design matrix for a date; ``first`` and ``span`` are the first day and the days of all dates."""
    number = F.unix_date(day).cast("double")
    t = (number - F.lit(float(first))) / F.lit(float(max(span, 1)))
    out = [F.lit(1.0), t, *(F.greatest(t - F.lit(k), F.lit(0.0)) for k in knots)]
    out += [(F.weekday(day) == F.lit(w)).cast("double") for w in range(1, 7)]
    for k in range(1, harmonics + 1):
        angle = number * F.lit(2.0 * math.pi * k / YEAR_DAYS)
        out += [F.sin(angle), F.cos(angle)]
    return out


def date_bounds(gold: DataFrame) -> tuple[int, int] | None:
    """First day number and days between the first and last date with a rate."""
    day = F.unix_date("date")
    row = gold.where("rate IS NOT NULL AND date IS NOT NULL").agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    return None if row["a"] is None else (row["a"], row["b"] - row["a"])


def moments(gold: DataFrame, first: int, span: int, knots: Sequence[float] = KNOTS, harmonics: int = 2) -> DataFrame:
    """Per pair: n_rows (NULL rates included), n_fit, first_date, last_date, and the sums of all products of columns as
    m_i_j, where the last column is the rate."""
    fit = F.col("rate").isNotNull() & F.col("date").isNotNull()
    x = [F.when(fit, c) for c in [*design(F.col("date"), first, span, knots, harmonics), F.col("rate")]]
    rows = gold.select(PAIR, "date", fit.alias("fit"), *(c.alias(f"x{i}") for i, c in enumerate(x)))
    sums = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"m_{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    fitted = F.when(F.col("fit"), F.col("date"))
    return rows.groupBy(PAIR).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("fit").alias("n_fit"),
        F.max("date").alias("last_date"),
        F.min(fitted).alias("first_fit"),
        F.max(fitted).alias("last_fit"),
        *sums,
    )


def solve(size: int, entry) -> Column:
    """[A | b | I] flattened by rows, ``entry(i, j)`` giving A and b (j = size), reduced so that A is I: the last columns
    then hold the solution and the inverse. A zero pivot makes the entries NULL."""
    width = 2 * size + 1
    cells = [entry(i, j) if j <= size else F.lit(float(j - size - 1 == i)) for i in range(size) for j in range(width)]

    def step(a: Column, k: Column) -> Column:
        def reduced(value: Column, at: Column) -> Column:
            row, col = F.floor(at / width).cast("int"), F.pmod(at, F.lit(width)).cast("int")
            lead = F.try_divide(F.element_at(a, k * width + col + 1), F.element_at(a, k * width + k + 1))
            return F.when(row == k, lead).otherwise(value - F.element_at(a, row * width + k + 1) * lead)

        return F.transform(a, reduced)

    return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.array(*cells), step)


def fit_seasonal(
    gold: DataFrame,
    min_rows: int = MIN_TRAINING_ROWS,
    knots: Sequence[float] = KNOTS,
    harmonics: int = 2,
    trend_ridge: float = 1.0,
    season_ridge: float = 0.1,
    bounds: tuple[int, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(model per pair, skipped pairs with a reason). The model has n_rows, last_date, beta, spread (the trend block of the
    inverse, by rows) and sigma."""
    first, span = bounds or date_bounds(gold) or (0, 1)
    sums = moments(gold, first, span, knots, harmonics)
    trend, size = 2 + len(knots), 8 + len(knots) + 2 * harmonics
    ridge = [0.0, 0.0, *[trend_ridge] * len(knots), *[season_ridge] * (6 + 2 * harmonics)]

    def m(i: int, j: int) -> Column:
        return F.col(f"m_{min(i, j)}_{max(i, j)}")

    ready = (F.col("n_rows") >= F.lit(min_rows)) & (F.col("first_fit") < F.col("last_fit"))
    solved = F.when(ready, solve(size, lambda i, j: m(i, j) + F.lit(ridge[i] if i == j else 0.0)))
    width = 2 * size + 1
    totals = [F.array(*(m(i, size) for i in range(size))).alias("xy"), m(size, size).alias("yy")]
    rows = sums.select(PAIR, "n_rows", "n_fit", "first_fit", "last_fit", "last_date", *totals, solved.alias("solved"))
    beta = F.array(*(F.element_at("solved", i * width + size + 1) for i in range(size)))
    spread = F.array(*(F.element_at("solved", i * width + size + 2 + j) for i in range(trend) for j in range(trend)))
    rows = rows.withColumn("beta", beta).withColumn("spread", spread).drop("solved")
    # residual and penalty together: y'y - beta' X'y is least for the fitted beta
    dot = F.aggregate(F.zip_with("beta", "xy", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    left = F.greatest(F.col("yy") - dot, F.lit(0.0))
    sigma = F.when(ready, F.sqrt(left / F.greatest(F.col("n_fit") - F.lit(trend), F.lit(1)).cast("double")))
    rows = rows.withColumn("sigma", sigma)
    finite = F.col("sigma").isNotNull() & ~F.isnan("sigma") & (F.col("sigma") != F.lit(float("inf")))
    reason = (
        F.when(F.col("n_rows") < F.lit(min_rows), F.lit("too_few_rows"))
        .when(~F.coalesce(F.col("first_fit") < F.col("last_fit"), F.lit(False)), F.lit("degenerate_fit"))
        .when(~finite, F.lit("non_finite_fit"))
    )
    rows = rows.withColumn("reason", reason)
    model = rows.where("reason IS NULL").select(PAIR, "n_rows", "last_date", "beta", "spread", "sigma")
    return model, rows.where("reason IS NOT NULL").select(PAIR, "n_rows", "reason")


def predict_seasonal(
    model: DataFrame,
    bounds: tuple[int, int],
    horizon: int = FORECAST_HORIZON_DAYS,
    interval_width: float = INTERVAL_WIDTH,
    knots: Sequence[float] = KNOTS,
    harmonics: int = 2,
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """The next ``horizon`` calendar days after each pair's last date."""
    trend = 2 + len(knots)
    ahead = F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon)))
    days = model.select("*", ahead.alias("forecast_date"))
    days = days.withColumn("x", F.array(*design(F.col("forecast_date"), *bounds, knots, harmonics)))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    yhat = total(F.zip_with("beta", "x", lambda a, b: a * b))
    terms = [F.element_at("spread", i * trend + j + 1) * F.element_at("x", i + 1) * F.element_at("x", j + 1) for i in range(trend) for j in range(trend)]
    width = F.lit(z_value(interval_width)) * F.col("sigma") * F.sqrt(F.lit(1.0) + total(F.array(*terms)))
    out = days.select(PAIR, "forecast_date", yhat.alias("yhat"), width.alias("w"), F.col("n_rows").alias("training_rows"))
    out = out.withColumns({"yhat_lower": F.col("yhat") - F.col("w"), "yhat_upper": F.col("yhat") + F.col("w"), "model_trained_at": run_timestamp(run_ts)})
    return enforce_schema(out, FORECAST_SCHEMA)


def forecast_seasonal(
    gold: DataFrame,
    horizon: int = FORECAST_HORIZON_DAYS,
    min_rows: int = MIN_TRAINING_ROWS,
    interval_width: float = INTERVAL_WIDTH,
    run_ts: datetime | str | None = None,
    knots: Sequence[float] = KNOTS,
    harmonics: int = 2,
    **ridges: float,
) -> tuple[DataFrame, DataFrame]:
    """(forecasts, skipped pairs with a reason)."""
    bounds = date_bounds(gold) or (0, 1)
    model, skipped = fit_seasonal(gold, min_rows, knots, harmonics, bounds=bounds, **ridges)
    return predict_seasonal(model, bounds, horizon, interval_width, knots, harmonics, run_ts), skipped
