"""Filters, predicates and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ratelake.schemas import MAX_VALID_RATE, MIN_VALID_RATE, OUTLIER_Z


def valid_rate(col: str | Column = "rate", min_rate: float = MIN_VALID_RATE, max_rate: float = MAX_VALID_RATE) -> Column:
    """Not NULL and inside the inclusive bounds; NaN and +-Infinity fail the bounds."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & c.between(F.lit(min_rate), F.lit(max_rate))


def filter_valid_rates(df: DataFrame, min_rate: float = MIN_VALID_RATE, max_rate: float = MAX_VALID_RATE) -> DataFrame:
    return df.filter(valid_rate("rate", min_rate, max_rate))


def rejection_reason(col: str = "rate", min_rate: float = MIN_VALID_RATE, max_rate: float = MAX_VALID_RATE) -> Column:
    c = F.col(col)
    return (
        F.when(c.isNull(), F.lit("null_rate"))
        .when(F.isnan(c), F.lit("nan_rate"))
        .when(c < F.lit(min_rate), F.lit("below_min"))
        .when(c > F.lit(max_rate), F.lit("above_max"))
    )


def rejected_rates(df: DataFrame, min_rate: float = MIN_VALID_RATE, max_rate: float = MAX_VALID_RATE) -> DataFrame:
    """Rows the validity filter drops, each with its reason."""
    return df.filter(~F.coalesce(valid_rate("rate", min_rate, max_rate), F.lit(False))).withColumn(
        "reason", rejection_reason("rate", min_rate, max_rate)
    )


def rejected_counts(df: DataFrame, min_rate: float = MIN_VALID_RATE, max_rate: float = MAX_VALID_RATE) -> DataFrame:
    """Count of rows per outcome (``valid`` or a rejection reason)."""
    outcome = F.coalesce(rejection_reason("rate", min_rate, max_rate), F.lit("valid"))
    return df.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))


def observe_validity(
    df: DataFrame, min_rate: float = MIN_VALID_RATE, max_rate: float = MAX_VALID_RATE, name: str = "validity"
) -> tuple[DataFrame, Observation]:
    """Attach row / rejected counters that are filled by the next action on the frame.

    One pass instead of two extra ``count()`` jobs.
    """
    obs = Observation(name)
    ok = valid_rate("rate", min_rate, max_rate)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~F.coalesce(ok, F.lit(False))).alias("rows_rejected"),
    )
    return observed, obs


def select_pairs(df: DataFrame, pairs: Sequence[str] | None, col: str = "currency_pair") -> DataFrame:
    """Keep the given pairs; an empty or missing selection keeps all of them."""
    if not pairs:
        return df
    return df.filter(F.col(col).isin(list(pairs)))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def outliers(df: DataFrame, threshold: float = OUTLIER_Z, col: str = "rate_z_score") -> DataFrame:
    """Rows whose |z| is strictly above the threshold."""
    return df.filter(F.abs(F.col(col)) > F.lit(threshold))


def is_weekday(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.weekday(c) < 5


def weekdays_only(df: DataFrame, col: str = "date") -> DataFrame:
    return df.filter(is_weekday(col))


def missing_targets(records: DataFrame, expected: Sequence[str], rates_col: str = "rates") -> DataFrame:
    """Per landing record, the expected target currencies it does not carry (warn-only check)."""
    expected_arr = F.array(*[F.lit(x) for x in expected])
    keys = F.coalesce(F.map_keys(F.col(rates_col)), F.array().cast("array<string>"))
    return records.withColumn("missing_targets", F.array_except(expected_arr, keys))
