"""Per-pair forecasts as one distributed job over all pairs.

Default model, Spark aggregates only (no per-group Python):

* ``t`` = days since the pair's first date; line ``a + b t`` by ordinary
  least squares (``regr_intercept`` / ``regr_slope``);
* weekly profile: mean residual per weekday ``s_w``;
* noise: sample stddev ``sigma`` of the residual after the weekly profile;
* the next ``horizon`` calendar days after the pair's own last date get
  ``yhat = a + b t + s_w`` and ``yhat -+ z sigma`` with ``z`` the normal
  quantile of the interval width.

The plain fit is one window and two aggregates, all keyed by the pair, and the
prediction is a generator: on gold (already shuffled on the pair) the whole
forecast adds no exchange. The split fit, used by the job, has aggregates only:
a pair of any length is combined map-side and no task holds one whole pair.

An optional grouped-map model (piecewise-linear trend + Fourier seasonality,
ridge-fitted with numpy in ``applyInPandas``) follows the structure of
Taylor & Letham, "Forecasting at Scale" (2018).
"""

from __future__ import annotations

from datetime import datetime
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelake.operators.frames import enforce_schema, run_timestamp
from ratelake.operators.series import PAIR
from ratelake.plans.layers import read_layer
from ratelake.schemas import FORECAST_HORIZON_DAYS, FORECAST_SCHEMA, INTERVAL_WIDTH, MIN_TRAINING_ROWS


def z_value(interval_width: float = INTERVAL_WIDTH) -> float:
    if not 0.0 < interval_width < 1.0:
        msg = f"interval_width must be in (0, 1), got {interval_width}"
        raise ValueError(msg)
    return NormalDist().inv_cdf((1.0 + interval_width) / 2.0)


def training_set(gold: DataFrame) -> DataFrame:
    """(pair, ds, y) with NULL ``y`` dropped."""
    return gold.select(PAIR, F.col("date").alias("ds"), F.col("rate").alias("y")).filter(F.col("y").isNotNull())


def _with_lines(gold: DataFrame, split: bool) -> DataFrame:
    """Gold rows with their pair's row count, date bounds and least-squares line."""
    day = F.unix_date("date").cast("double")
    stats = {
        "n_rows": F.count(F.lit(1)),
        "first_date": F.min("date"),
        "last_date": F.max("date"),
        "a_day0": F.regr_intercept("rate", day),
        "b": F.regr_slope("rate", day),
    }
    rows = gold.select(PAIR, "date", "rate")
    if split:
        lines = rows.groupBy(F.col(PAIR).alias("_pair")).agg(*[c.alias(k) for k, c in stats.items()])
        return rows.join(lines, F.col(PAIR).eqNullSafe(F.col("_pair"))).drop("_pair")  # a NULL pair too, as in the window
    return rows.select("*", *[c.over(Window.partitionBy(PAIR)).alias(k) for k, c in stats.items()])


def fit_default_model(gold: DataFrame, min_rows: int = MIN_TRAINING_ROWS, split: bool = False) -> tuple[DataFrame, DataFrame]:
    """Fit every eligible pair. Returns (model per pair, skipped pairs with a reason).

    * per pair, over an unordered window on the pair (``split``: an aggregate joined back): row count (NULL rates
      included, as the gate counts them), first / last date and the
      least-squares line on the day number;
    * residual ``e0`` per row, aggregated per (pair, weekday) into count,
      mean ``s_w`` and sum of squared deviations;
    * per pair: sigma from the pooled within-weekday sum of squares (the
      residual after the weekday profile has mean 0, so its sample variance
      is that sum over ``n - 1``) and the profile as a 7-entry map.

    Gold is one row per (pair, day), so a pair's window is bounded by the
    days it covers. The window and both aggregates are keyed by the pair:
    after gold's own shuffle on the pair, the fit adds no exchange.
    """
    day = F.unix_date("date").cast("double")
    rows = _with_lines(gold, split)
    fit_rows = rows.filter((F.col("n_rows") >= F.lit(min_rows)) & F.col("b").isNotNull() & F.col("rate").isNotNull())
    profile = (
        fit_rows.select(
            PAIR,
            F.weekday("date").alias("wd"),
            (F.col("rate") - (F.col("a_day0") + F.col("b") * day)).alias("e0"),
            "n_rows",
            "first_date",
            "last_date",
            "a_day0",
            "b",
        )
        .groupBy(PAIR, "wd")
        .agg(
            F.count(F.lit(1)).alias("n_w"),
            F.avg("e0").alias("s_w"),
            (F.var_pop("e0") * F.count(F.lit(1))).alias("ss_w"),
            F.first("n_rows").alias("n_rows"),
            F.first("first_date").alias("first_date"),
            F.first("last_date").alias("last_date"),
            F.first("a_day0").alias("a_day0"),
            F.first("b").alias("b"),
        )
    )
    model = profile.groupBy(PAIR).agg(
        F.first("n_rows").alias("n_rows"),
        F.first("first_date").alias("first_date"),
        F.first("last_date").alias("last_date"),
        (F.first("a_day0") + F.first("b") * F.unix_date(F.first("first_date")).cast("double")).alias("a"),
        F.first("b").alias("b"),
        F.sqrt(F.sum("ss_w") / F.nullif(F.sum("n_w") - F.lit(1), F.lit(0))).alias("sigma"),
        F.map_from_entries(F.collect_list(F.struct("wd", "s_w"))).alias("weekly"),
    )
    stats = rows.groupBy(PAIR).agg(F.first("n_rows").alias("n_rows"), F.first("b").alias("b"))
    sigmas = model.select(F.col(PAIR).alias("_pair"), "sigma")
    skipped = stats.join(sigmas, F.col(PAIR).eqNullSafe(F.col("_pair")), "left").select(
        PAIR,
        "n_rows",
        F.when(F.col("n_rows") < F.lit(min_rows), F.lit("too_few_rows"))
        .when(F.col("b").isNull() | F.col("sigma").isNull(), F.lit("degenerate_fit"))
        .when(F.isnan("sigma") | F.isnan("b"), F.lit("non_finite_fit"))
        .alias("reason"),
    ).filter(F.col("reason").isNotNull())
    return model.filter(F.col("sigma").isNotNull() & ~F.isnan("sigma") & ~F.isnan("b")), skipped


def predict_default_model(
    model: DataFrame,
    horizon: int = FORECAST_HORIZON_DAYS,
    interval_width: float = INTERVAL_WIDTH,
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """The next ``horizon`` calendar days after each pair's last date (a generator, no join)."""
    z = z_value(interval_width)
    days = model.select(
        "*",
        F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", horizon))).alias("forecast_date"),
    )
    yhat = (
        F.col("a")
        + F.col("b") * F.datediff("forecast_date", "first_date").cast("double")
        + F.coalesce(F.element_at("weekly", F.weekday("forecast_date")), F.lit(0.0))
    )
    out = days.select(PAIR, "forecast_date", yhat.alias("yhat"), "sigma", F.col("n_rows").alias("training_rows")).select(
        PAIR,
        "forecast_date",
        "yhat",
        (F.col("yhat") - F.lit(z) * F.col("sigma")).alias("yhat_lower"),
        (F.col("yhat") + F.lit(z) * F.col("sigma")).alias("yhat_upper"),
        run_timestamp(run_ts).alias("model_trained_at"),
        "training_rows",
    )
    return enforce_schema(out, FORECAST_SCHEMA)


def forecast(
    gold: DataFrame,
    horizon: int = FORECAST_HORIZON_DAYS,
    min_rows: int = MIN_TRAINING_ROWS,
    interval_width: float = INTERVAL_WIDTH,
    run_ts: datetime | str | None = None,
    split: bool = False,
) -> DataFrame:
    model, _ = fit_default_model(gold, min_rows, split)
    return predict_default_model(model, horizon, interval_width, run_ts)


def run_forecasting(
    spark,
    gold_path: str,
    forecasts_path: str,
    horizon: int = FORECAST_HORIZON_DAYS,
    min_rows: int = MIN_TRAINING_ROWS,
    interval_width: float = INTERVAL_WIDTH,
    run_ts: datetime | str | None = None,
    model: str = "default",
    model_params: dict | None = None,
    skipped_path: str | None = None,
) -> DataFrame | None:
    """Forecast every pair of a gold table and write the result.

    ``model`` is ``default``, ``seasonal`` (change points, weekly and yearly terms by normal equations, see
    ``plans.seasonal``) or ``grouped`` (the grouped-map model); the last two take ``model_params``. Pairs without a forecast are written to ``skipped_path`` with their reason.
    When no pair yields a forecast, the previous output stays in place and
    ``None`` is returned. The result is checkpointed to the cluster's
    checkpoint folder first, so the emptiness test and the write read the
    same rows without fitting twice.
    """
    gold = read_layer(spark, gold_path)
    if model == "default":
        fitted, skipped = fit_default_model(gold, min_rows, split=True)
        fc = predict_default_model(fitted, horizon, interval_width, run_ts).checkpoint()
    elif model == "seasonal":
        from ratelake.plans.seasonal import forecast_seasonal  # it imports this module

        fc, skipped = forecast_seasonal(gold, horizon, min_rows, interval_width, run_ts, **(model_params or {}))
        fc = fc.checkpoint()
    elif model == "grouped":
        params = {"horizon": horizon, "min_rows": min_rows, "interval_width": interval_width, **(model_params or {})}
        rows = fit_predict_pandas(gold, **params).checkpoint()
        fc, skipped = split_outcomes(rows, run_ts)
    else:
        msg = f"Unknown forecast model: {model}"
        raise ValueError(msg)
    if skipped_path:
        skipped.write.mode("overwrite").parquet(skipped_path)
    if fc.isEmpty():
        return None
    fc.write.mode("overwrite").parquet(forecasts_path)
    return spark.read.schema(FORECAST_SCHEMA).parquet(forecasts_path)


# --------------------------------------------------------------------------
# Optional grouped-map model.
# --------------------------------------------------------------------------

PANDAS_OUT = "currency_pair string, forecast_date date, yhat double, yhat_lower double, yhat_upper double, training_rows int, reason string"


def _design(t: np.ndarray, knots: np.ndarray, period_days: list[tuple[float, int]]) -> np.ndarray:
    cols = [np.ones_like(t), t]
    cols += [np.maximum(t - k, 0.0) for k in knots]
    for period, order in period_days:
        for k in range(1, order + 1):
            ang = 2.0 * np.pi * k * t / period
            cols += [np.sin(ang), np.cos(ang)]
    return np.column_stack(cols)


def make_pandas_model(
    horizon: int = FORECAST_HORIZON_DAYS,
    min_rows: int = MIN_TRAINING_ROWS,
    interval_width: float = INTERVAL_WIDTH,
    n_changepoints: int = 10,
    changepoint_prior_scale: float = 0.05,
    seasonality_prior_scale: float = 10.0,
    weekly: bool = True,
    yearly: bool = True,
):
    """Build the per-pair function for ``groupBy(pair).applyInPandas``.

    Trend: line plus hinge terms at evenly spaced change points (in the first
    80% of the history), seasonality: Fourier terms (weekly order 3, yearly
    order 10; the ridge keeps a short history well defined). Ridge penalties are the
    inverse squared prior scales. Interval: residual stddev times ``z``.
    A pair that cannot be forecast gives one row that holds only its row count and the reason.
    """
    z = z_value(interval_width)

    def fit_predict(pdf: pd.DataFrame) -> pd.DataFrame:
        pair = pdf[PAIR].iloc[0]
        n_rows = len(pdf)

        def skip(reason: str) -> pd.DataFrame:
            row = (pair, None, None, None, None, n_rows, reason)
            return pd.DataFrame([row], columns=["currency_pair", "forecast_date", "yhat", "yhat_lower", "yhat_upper", "training_rows", "reason"])

        if n_rows < min_rows:
            return skip("too_few_rows")
        d = pdf.dropna(subset=["rate", "date"]).sort_values("date")
        if d["date"].nunique() < 2:
            return skip("degenerate_fit")
        if not np.isfinite(d["rate"]).all():
            return skip("non_finite_fit")
        try:
            dates = pd.to_datetime(d["date"])
            t = ((dates - dates.iloc[0]).dt.days).to_numpy(dtype=float)
            span = max(t[-1], 1.0)
            ts = t / span
            y = d["rate"].to_numpy(dtype=float)
            y_scale = float(np.max(np.abs(y))) or 1.0
            knots = np.linspace(0, 0.8, n_changepoints + 2)[1:-1] if n_changepoints else np.array([])
            seasons = []
            if weekly:
                seasons.append((7.0 / span, 3))
            if yearly:
                seasons.append((365.25 / span, 10))
            X = _design(ts, knots, seasons)
            penalty = np.zeros(X.shape[1])
            penalty[2 : 2 + len(knots)] = 1.0 / changepoint_prior_scale**2
            penalty[2 + len(knots) :] = 1.0 / seasonality_prior_scale**2
            A = X.T @ X + np.diag(penalty) * len(y) * 1e-4
            coef = np.linalg.solve(A, X.T @ (y / y_scale))
            resid = y / y_scale - X @ coef
            sigma = float(np.std(resid, ddof=1)) * y_scale if len(resid) > 1 else 0.0
            last = dates.iloc[-1]
            fut = pd.date_range(last + pd.Timedelta(days=1), periods=horizon, freq="D")
            tf = ((fut - dates.iloc[0]).days.to_numpy(dtype=float)) / span
            yhat = (_design(tf, knots, seasons) @ coef) * y_scale
        except Exception as exc:  # noqa: BLE001 - one failing pair must not stop the others; its row says why
            return skip(f"failed: {type(exc).__name__}")
        return pd.DataFrame(
            {
                "currency_pair": pair,
                "forecast_date": fut.date,
                "yhat": yhat,
                "yhat_lower": yhat - z * sigma,
                "yhat_upper": yhat + z * sigma,
                "training_rows": n_rows,
                "reason": None,
            }
        )

    return fit_predict


def fit_predict_pandas(gold: DataFrame, **params) -> DataFrame:
    """Optional model, one grouped-map task per pair: forecast rows, and one row with a reason per pair without a forecast.

    A pair's gold series holds at most one row per day, so a group is bounded
    by the calendar span of the data, not by the size of the raw input.
    """
    return gold.select(PAIR, "date", "rate").groupBy(PAIR).applyInPandas(make_pandas_model(**params), PANDAS_OUT)


def split_outcomes(rows: DataFrame, run_ts: datetime | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(forecasts, skipped pairs with a reason) of :func:`fit_predict_pandas`."""
    done = rows.filter(F.col("reason").isNull()).withColumn("model_trained_at", run_timestamp(run_ts))
    skipped = rows.filter(F.col("reason").isNotNull()).select(PAIR, F.col("training_rows").cast("long").alias("n_rows"), "reason")
    return enforce_schema(done, FORECAST_SCHEMA), skipped


def forecast_pandas(gold: DataFrame, run_ts: datetime | str | None = None, **params) -> DataFrame:
    """Forecasts of the optional model."""
    return split_outcomes(fit_predict_pandas(gold, **params), run_ts)[0]
