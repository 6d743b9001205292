"""Catalog of queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver tables (through :mod:`ratelake.sources.tables`) and
runs the library's operators over the whole of them. Float features are
rounded at the very end, for comparison with the SQL oracle only: at 8
decimals, averages of prices and forecasts at 6.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.functions import scalar
from ratelake.operators import aggregates as agg
from ratelake.operators import quality, series
from ratelake.operators.frames import enforce_schema
from ratelake.operators.quality import filter_valid_rates
from ratelake.operators.series import rolling_average
from ratelake.plans import forecast as fc
from ratelake.plans import seasonal
from ratelake.plans import layers, planning, serving
from ratelake.plans.oracle import (
    EXPECTED_TARGETS,
    RUN_DATE,
    RUN_TS,
    SELECTED_PAIRS,
)
from ratelake.schemas import BRONZE_SCHEMA
from ratelake.session import ensure_checkpoint_dir
from ratelake.sources import landing, tables
from ratelake.streaming.latest_stream import read_latest, start_landing_to_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def r8(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 8) + F.lit(0.0)


def r6(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 6) + F.lit(0.0)


def mean6(col: str) -> Column:
    """An average of prices (six digits before the point) at 6 decimals.

    Averages of 32 or 64 cent amounts lie exactly between two such values;
    the billionth moves them to the upper one, whatever the order of the sum.
    """
    return F.round(F.col(col) + F.lit(1e-9), 6)


def rounded(df: DataFrame, cols: list[str], digits: int = 8) -> DataFrame:
    fn = r8 if digits == 8 else r6
    return df.select(*[(mean6 if c.startswith("ma_") else fn)(c).alias(c) if c in cols else F.col(c) for c in df.columns])


#: The series of this catalog are prices, so their valid range is wider than that of the default (exchange rates).
MAX_PRICE = 1e9
#: Prices have no |z| above 2; at this threshold there are more rows than the top-k keeps.
PRICE_OUTLIER_Z = 1.5

# ---- shared chains over the orders-derived series --------------------------


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return layers.transform_to_bronze(tables.rates(spark, sf), tie_breakers=["record_id"])


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return layers.transform_to_silver(bronze(spark, sf), max_rate=MAX_PRICE, run_ts=RUN_TS)


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return layers.transform_to_gold(silver(spark, sf), run_ts=RUN_TS)


GOLD_FLOATS = ["daily_return", "ma_7", "ma_30", "ma_90", "volatility_30", "rate_z_score"]


def gold_view(spark: SparkSession, sf: str) -> DataFrame:
    """Gold without the run timestamp, float features at 8 decimals."""
    return rounded(gold(spark, sf).drop("created_at"), GOLD_FLOATS)


# ---- WIN-1 / FLT-1 / WIN-3 / WIN-4 / WIN-11 / WIN-12 ------------------------


@query("dedup_latest")
def q_dedup_latest(spark, sf):
    return bronze(spark, sf)


@query("filter_valid")
def q_filter_valid(spark, sf):
    return filter_valid_rates(bronze(spark, sf))


@query("daily_return")
def q_daily_return(spark, sf):
    s = silver(spark, sf)
    return s.select("date", "currency_pair", "rate", "prev_rate", r8("daily_return").alias("daily_return"))


@query("ma_7")
def q_ma_7(spark, sf):
    s = silver(spark, sf).select("date", "currency_pair", "rate")
    return rounded(rolling_average(s, 7), ["ma_7"])


@query("silver_rates")
def q_silver_rates(spark, sf):
    """Silver with the default validity bounds: prices above them are dropped."""
    s = layers.transform_to_silver(bronze(spark, sf), run_ts=RUN_TS)
    return rounded(s.drop("processed_at"), ["daily_return"])


@query("silver_rates_split")
def q_silver_rates_split(spark, sf):
    """Silver of every price, each pair cut into 64-row chunks with a halo of one row."""
    s = layers.transform_to_silver(bronze(spark, sf), max_rate=MAX_PRICE, run_ts=RUN_TS, split_chunk_rows=64)
    return rounded(s.drop("processed_at"), ["daily_return"])


@query("rejected_rates")
def q_rejected_rates(spark, sf):
    return quality.rejected_rates(bronze(spark, sf))


@query("gold_rates")
def q_gold_rates(spark, sf):
    return gold_view(spark, sf)




def daily_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold features of the events-derived daily series (already one row per day and type)."""
    d = series.compute_daily_returns(tables.daily(spark, sf))
    return layers.gold_core(d)


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return fc.forecast(gold(spark, sf), run_ts=RUN_TS)


LATEST_FLOATS = ["ma_7", "ma_30", "ma_90", "volatility_30", "rate_z_score"]

# ---- SRC / SNK ---------------------------------------------------------------


@query("explode_rates")
def q_explode_rates(spark, sf):
    p = tables.payloads(spark, sf)
    return p.select("event_id", "date", F.explode("rates").alias("target_currency", "_raw")).select(
        "event_id", "date", "target_currency", F.col("_raw").try_cast("double").alias("rate")
    )


@query("row_counts")
def q_row_counts(spark, sf):
    return agg.row_counts(
        raw=tables.rates(spark, sf), bronze=bronze(spark, sf), silver=silver(spark, sf), gold=gold(spark, sf)
    )


def _landing_versions(spark, sf):
    """Records landed first (earliest copy, up to 1999) and a later re-fetch (latest copy, from mid-1999)."""
    raw = tables.rates(spark, sf)
    early = layers.transform_to_bronze(raw.withColumn("_first", -F.col("record_id")), tie_breakers=["_first"])
    late = layers.transform_to_bronze(raw, tie_breakers=["record_id"])
    existing = landing.records_from_rows(early.filter(F.col("ingestion_date") <= F.lit("1999-12-31").cast("date")))
    incoming = landing.records_from_rows(late.filter(F.col("ingestion_date") >= F.lit("1999-07-01").cast("date")))
    return existing, incoming


def _record_rows(records: DataFrame) -> DataFrame:
    return records.select(
        "base", F.to_date("date").alias("date"), F.explode("rates").alias("target_currency", "_raw")
    ).select("base", "date", "target_currency", F.col("_raw").try_cast("double").alias("rate"))


@query("upsert_insert_only")
def q_upsert_insert_only(spark, sf):
    existing, incoming = _landing_versions(spark, sf)
    return _record_rows(landing.upsert_records(existing, incoming, force=False))


@query("upsert_force")
def q_upsert_force(spark, sf):
    existing, incoming = _landing_versions(spark, sf)
    return _record_rows(landing.upsert_records(existing, incoming, force=True))


# ---- PRJ ---------------------------------------------------------------------


@query("enforce_schema")
def q_enforce_schema(spark, sf):
    return enforce_schema(tables.rates(spark, sf), BRONZE_SCHEMA)


@query("currency_pair")
def q_currency_pair(spark, sf):
    r = tables.rates(spark, sf)
    return series.add_currency_pair(r).select("record_id", "base_currency", "target_currency", "currency_pair")


@query("rename_date")
def q_rename_date(spark, sf):
    return series.add_date_column(bronze(spark, sf))


@query("parse_dates")
def q_parse_dates(spark, sf):
    o = tables.table(spark, sf, "orders")
    text = o.select(
        F.col("o_orderkey").alias("record_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ingestion_date"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("ingested_at"),
    )
    return layers.parse_bronze_columns(text)


@query("bronze_rates")
def q_bronze_rates(spark, sf):
    """Rows -> landing JSON text -> scan -> quarantine split -> bronze, over the whole table."""
    raw = layers.transform_to_bronze(tables.rates(spark, sf), tie_breakers=["record_id"])
    records = landing.records_from_rows(raw)
    text = records.select(F.to_json(F.struct(*landing.LANDING_SCHEMA.fieldNames())).alias("line"))
    parsed = text.select(F.from_json("line", landing.LANDING_SCHEMA).alias("r"), F.lit(None).cast("string").alias(landing.CORRUPT))
    good, _ = landing.split_landing(parsed.select("r.*", landing.CORRUPT), run_ts=RUN_TS)
    return layers.transform_to_bronze(good)


@query("dedup_ties")
def q_dedup_ties(spark, sf):
    """Bronze of lineitem without a record id: copies tie on time and source, the rate ends the order."""
    return layers.transform_to_bronze(tables.line_rates(spark, sf))


def _land_files(spark: SparkSession, sf: str) -> str:
    """Folder of landing files written from the whole orders table.

    Next to the good records every order adds one unusable line, of a kind given by its priority.
    """
    good = landing.records_from_rows(bronze(spark, sf))
    key = F.col("o_orderkey").cast("string")
    rates = F.create_map(F.lit("F"), key)
    kind = F.substring("o_orderpriority", 1, 1)
    day = F.lit("2001-01-01").alias("date")
    base = key.alias("base")
    bad = tables.table(spark, sf, "orders").select(
        F.when(kind == "1", F.concat(F.lit('{"base": "'), key))
        .when(kind == "2", F.to_json(F.struct(day, rates.alias("rates"))))
        .when(kind == "3", F.to_json(F.struct(base, F.lit("never").alias("date"), rates.alias("rates"))))
        .when(kind == "4", F.to_json(F.struct(base, day, rates.alias("rates"), F.lit("garbage").alias("fetched_at"))))
        .otherwise(F.to_json(F.struct(base, day, F.create_map(F.lit("F"), F.lit("n/a")).alias("rates"))))
        .alias("line")
    )
    lines = good.select(F.to_json(F.struct(*landing.LANDING_SCHEMA.fieldNames())).alias("line")).unionByName(bad)
    folder = os.path.join(ensure_checkpoint_dir(spark), f"landing-{uuid.uuid4().hex}")
    lines.write.text(os.path.join(folder, "raw"))
    return folder


def _landed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Good and quarantined rows of the landing files, scanned once."""
    folder = _land_files(spark, sf)
    return landing.load_raw_rates(spark, os.path.join(folder, "raw"), "part-*.txt", RUN_TS, os.path.join(folder, "staged"))


@query("landing_bronze")
def q_landing_bronze(spark, sf):
    """Landing files with unusable lines, scanned, split and deduplicated."""
    return layers.transform_to_bronze(_landed(spark, sf)[0])


@query("quarantine_counts")
def q_quarantine_counts(spark, sf):
    return _landed(spark, sf)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("latest_stream")
def q_latest_stream(spark, sf):
    """The landing files as a stream of micro-batches; the latest rate of every pair kept as state and merged into a table."""
    folder = _land_files(spark, sf)
    source, table, state = (os.path.join(folder, x) for x in ("raw", "latest", "state"))
    start_landing_to_latest(spark, source, table, state, "part-*.txt", max_files=2, run_ts=RUN_TS, max_rate=MAX_PRICE).awaitTermination()
    return read_latest(spark, table)


@query("chart_returns")
def q_chart_returns(spark, sf):
    return rounded(serving.chart_returns(gold(spark, sf)), ["daily_return_pct"])


@query("forecast_display")
def q_forecast_display(spark, sf):
    return serving.forecast_display(forecasts(spark, sf)).select(
        *[(F.col(c) + F.lit(0.0)).alias(c) if c in ("Forecast", "Lower (95%)", "Upper (95%)") else F.col(c)
          for c in ["currency_pair", "Date", "Forecast", "Lower (95%)", "Upper (95%)"]]
    )


# ---- FLT -----------------------------------------------------------------------


@query("rejected_counts")
def q_rejected_counts(spark, sf):
    return quality.rejected_counts(bronze(spark, sf))


@query("pair_selection")
def q_pair_selection(spark, sf):
    return quality.select_pairs(gold_view(spark, sf), SELECTED_PAIRS)


@query("nonnull_returns")
def q_nonnull_returns(spark, sf):
    s = quality.not_null(silver(spark, sf), "daily_return")
    return s.select("date", "currency_pair", "rate", r8("daily_return").alias("daily_return"))


@query("outliers")
def q_outliers(spark, sf):
    o = quality.outliers(gold(spark, sf), PRICE_OUTLIER_Z)
    return o.select("date", "currency_pair", "rate", r8("rate_z_score").alias("rate_z_score"))


@query("daily_outliers")
def q_daily_outliers(spark, sf):
    """Outliers of the daily event series at the default threshold."""
    o = quality.outliers(daily_gold(spark, sf))
    return o.select("date", "currency_pair", "rate", r8("rate_z_score").alias("rate_z_score"))


@query("weekday_filter")
def q_weekday_filter(spark, sf):
    d = bronze(spark, sf).select(F.col("ingestion_date").alias("date")).distinct()
    return quality.weekdays_only(d).withColumn("weekday", scalar.weekday_number("date"))


@query("missing_targets")
def q_missing_targets(spark, sf):
    records = landing.records_from_rows(bronze(spark, sf))
    m = quality.missing_targets(records, EXPECTED_TARGETS)
    return m.select("base", F.to_date("date").alias("date"), F.explode("missing_targets").alias("missing_target"))


# ---- PLN --------------------------------------------------------------------------


def _bronze_dates(spark, sf):
    return bronze(spark, sf).select(F.col("ingestion_date").alias("date"), F.col("base_currency").alias("base"))


@query("date_spine")
def q_date_spine(spark, sf):
    return planning.global_spine(_bronze_dates(spark, sf))


@query("weekday_spine")
def q_weekday_spine(spark, sf):
    return planning.global_spine(_bronze_dates(spark, sf), weekdays=True)


@query("spine_summary")
def q_spine_summary(spark, sf):
    return planning.spine_summary(planning.global_spine(_bronze_dates(spark, sf)))


@query("dates_to_load")
def q_dates_to_load(spark, sf):
    present = _bronze_dates(spark, sf)
    requested = planning.spine_per_key(present, "base", weekdays=True)
    return planning.dates_to_load(requested, present, ["base", "date"]).select("base", "date")


@query("recent_days")
def q_recent_days(spark, sf):
    """The 30 days up to each base's last date, without the days that have landed."""
    present = _bronze_dates(spark, sf)
    last = present.groupBy("base").agg(F.max("date").alias("_last"))
    requested = last.select("base", F.explode(planning.last_n_days(F.col("_last"), 30)).alias("date"))
    return planning.dates_to_load(requested, present, ["base", "date"])


@query("fetch_label")
def q_fetch_label(spark, sf):
    d = _bronze_dates(spark, sf).select("date").distinct()
    return d.select("date", planning.fetch_label("date", RUN_DATE).alias("label"))


# ---- JON ----------------------------------------------------------------------------


@query("latest_rates")
def q_latest_rates(spark, sf):
    return rounded(serving.latest_rates(gold(spark, sf)), LATEST_FLOATS)


@query("latest_rates_5_20")
def q_latest_rates_5_20(spark, sf):
    """Serving follows the windows of the gold table."""
    g = layers.transform_to_gold(silver(spark, sf), windows=(5, 20), volatility_window=10, run_ts=RUN_TS)
    return rounded(serving.latest_rates(g), ["ma_5", "ma_20", "volatility_10", "rate_z_score"])


@query("rate_z_score_join")
def q_rate_z_score_join(spark, sf):
    s = silver(spark, sf).select("date", "currency_pair", "rate")
    return rounded(series.add_rate_z_score_by_join(s), ["rate_z_score"])


@query("history_and_forecast")
def q_history_and_forecast(spark, sf):
    return rounded(serving.history_and_forecast(gold(spark, sf), forecasts(spark, sf)), ["value", "lower", "upper"], 6)


# ---- AGG ---------------------------------------------------------------------------


@query("max_date")
def q_max_date(spark, sf):
    return agg.max_date(gold(spark, sf))


@query("return_stats")
def q_return_stats(spark, sf):
    return agg.return_stats(gold(spark, sf))


@query("avg_volatility")
def q_avg_volatility(spark, sf):
    return rounded(agg.avg_volatility(gold(spark, sf)), ["avg_vol"])


@query("volatility_pivot")
def q_volatility_pivot(spark, sf):
    """The date x pair matrix, one row per cell (empty cells too); its columns come from the data."""
    wide = agg.volatility_pivot(daily_gold(spark, sf))
    return rounded(wide.unpivot("date", wide.columns[1:], "currency_pair", "avg_vol"), ["avg_vol"])


@query("volatility_pivot_by_pair")
def q_volatility_pivot_by_pair(spark, sf):
    """The pair x date matrix, one row per cell (empty cells too); its columns come from the data."""
    wide = agg.volatility_pivot_by_pair(daily_gold(spark, sf))
    return rounded(wide.unpivot("currency_pair", wide.columns[1:], "date", "avg_vol"), ["avg_vol"])


@query("distinct_pairs")
def q_distinct_pairs(spark, sf):
    return agg.distinct_keys(gold(spark, sf))


@query("latest_per_pair")
def q_latest_per_pair(spark, sf):
    return rounded(serving.latest_per_pair(gold(spark, sf)), LATEST_FLOATS)


@query("training_counts")
def q_training_counts(spark, sf):
    return agg.training_counts(gold(spark, sf))


# ---- WIN -------------------------------------------------------------------------


@query("prev_rate")
def q_prev_rate(spark, sf):
    return silver(spark, sf).select("date", "currency_pair", "rate", "prev_rate")


@query("moving_averages")
def q_moving_averages(spark, sf):
    return gold_view(spark, sf).select("date", "currency_pair", "ma_7", "ma_30", "ma_90")


@query("volatility_30")
def q_volatility_30(spark, sf):
    return gold_view(spark, sf).select("date", "currency_pair", "volatility_30")


@query("rate_z_score")
def q_rate_z_score(spark, sf):
    return gold_view(spark, sf).select("date", "currency_pair", "rate", "rate_z_score")


@query("latest_change")
def q_latest_change(spark, sf):
    return rounded(series.latest_change(gold(spark, sf)), ["change_pct"])


@query("tail_90")
def q_tail_90(spark, sf):
    return series.tail_rows(gold(spark, sf).select("currency_pair", "date", "rate"), 90)


@query("order_key")
def q_order_key(spark, sf):
    s = silver(spark, sf)
    return s.select("date", "currency_pair", series.day_number("date").cast("bigint").alias("order_key"))


@query("ma_calendar_days")
def q_ma_calendar_days(spark, sf):
    s = silver(spark, sf).select("date", "currency_pair", "rate", "daily_return")
    s = series.rolling_average(s, 30, alias="ma_30d", calendar_days=True)
    s = series.rolling_stddev(s, 30, alias="volatility_30d", calendar_days=True)
    return rounded(s.drop("daily_return"), ["ma_30d", "volatility_30d"])


@query("ma_calendar_days_split")
def q_ma_calendar_days_split(spark, sf):
    """The same frames with every pair cut into 64-day blocks."""
    s = silver(spark, sf).select("date", "currency_pair", "rate", "daily_return")
    s = series.rolling_days_split(s, [30], 30, block_days=64)
    s = s.withColumnsRenamed({"ma_30": "ma_30d", "volatility_30": "volatility_30d"})
    return rounded(s.drop("daily_return"), ["ma_30d", "volatility_30d"])


# ---- SRT / SET ------------------------------------------------------------------


@query("training_set")
def q_training_set(spark, sf):
    return fc.training_set(gold(spark, sf)).orderBy("currency_pair", "ds")


@query("top_outliers")
def q_top_outliers(spark, sf):
    return rounded(serving.top_outliers(gold(spark, sf), threshold=PRICE_OUTLIER_Z), ["rate_z_score"])


@query("table_preview")
def q_table_preview(spark, sf):
    return serving.table_preview(gold_view(spark, sf))


@query("gold_rates_split")
def q_gold_rates_split(spark, sf):
    """Gold with every pair cut into 128-row chunks plus a lookback halo (the hot-key strategy)."""
    g = layers.transform_to_gold(silver(spark, sf), run_ts=RUN_TS, split_chunk_rows=128)
    return rounded(g.drop("created_at"), GOLD_FLOATS)


@query("line_gold_rates")
def q_line_gold_rates(spark, sf):
    """Gold over the lineitem-derived series (many copies per key: the dedup-heavy bench input)."""
    b = layers.transform_to_bronze(tables.line_rates(spark, sf), tie_breakers=["record_id"])
    g = layers.transform_to_gold(layers.transform_to_silver(b, max_rate=MAX_PRICE, run_ts=RUN_TS), run_ts=RUN_TS)
    return rounded(g.drop("created_at"), GOLD_FLOATS)


@query("supplier_gold_rates")
def q_supplier_gold_rates(spark, sf):
    """Gold over one series per supplier and line status: many keys."""
    b = layers.transform_to_bronze(tables.supplier_rates(spark, sf), tie_breakers=["record_id"])
    g = layers.transform_to_gold(layers.transform_to_silver(b, max_rate=MAX_PRICE, run_ts=RUN_TS), run_ts=RUN_TS)
    return rounded(g.drop("created_at"), GOLD_FLOATS)


@query("union_pairs")
def q_union_pairs(spark, sf):
    def pairs(df, name):
        b = layers.transform_to_bronze(df, tie_breakers=["record_id"])
        return series.add_currency_pair(b).select(
            F.col("ingestion_date").alias("date"), "currency_pair", "rate", F.lit(name).alias("series")
        )

    return pairs(tables.rates(spark, sf), "orders").unionByName(pairs(tables.line_rates(spark, sf), "lineitem"))


# ---- FC --------------------------------------------------------------------------


@query("forecast")
def q_forecast(spark, sf):
    return rounded(forecasts(spark, sf).drop("model_trained_at"), ["yhat", "yhat_lower", "yhat_upper"], 6)


@query("forecast_split")
def q_forecast_split(spark, sf):
    """The forecast fitted by aggregates only, over the split silver and gold."""
    s = layers.transform_to_silver(bronze(spark, sf), max_rate=MAX_PRICE, run_ts=RUN_TS, split_chunk_rows=128)
    g = layers.transform_to_gold(s, run_ts=RUN_TS, split_chunk_rows=128)
    f = fc.forecast(g, run_ts=RUN_TS, split=True)
    return rounded(f.drop("model_trained_at"), ["yhat", "yhat_lower", "yhat_upper"], 6)


@query("forecast_seasonal")
def q_forecast_seasonal(spark, sf):
    """Change points, weekly and yearly terms by normal equations; intervals that grow with the lead."""
    f, _ = seasonal.forecast_seasonal(gold(spark, sf), run_ts=RUN_TS)
    values = [(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")]
    return f.select("currency_pair", "forecast_date", *values, "training_rows")


@query("forecast_skipped")
def q_forecast_skipped(spark, sf):
    """Daily event series that a gate of 31 rows leaves out, with the reason."""
    return fc.fit_default_model(daily_gold(spark, sf), min_rows=31)[1]


@query("forecast_model")
def q_forecast_model(spark, sf):
    model, _ = fc.fit_default_model(gold(spark, sf))
    return rounded(
        model.select("currency_pair", "n_rows", "first_date", "last_date", "a", "b", "sigma"), ["a", "b", "sigma"], 6
    )


@query("forecast_summary")
def q_forecast_summary(spark, sf):
    return rounded(
        serving.forecast_summary(forecasts(spark, sf)).drop("model_trained_at"),
        ["forecast_rate", "lower_bound", "upper_bound", "uncertainty_range"],
        6,
    )


# ---- SRV -------------------------------------------------------------------------


@query("adhoc_sql")
def q_adhoc_sql(spark, sf):
    serving.register_table(spark, gold(spark, sf), serving.GOLD_TABLE)
    return serving.run_sql(
        spark,
        "SELECT currency_pair, year(date) AS year, count(*) AS days, count_if(abs(daily_return) > :move) AS large_moves "
        "FROM gold_exchange_rates GROUP BY currency_pair, year(date)",
        {"move": 0.5},
    )


@query("chart_rates")
def q_chart_rates(spark, sf):
    return serving.chart_rates(gold(spark, sf))


@query("chart_rates_ma")
def q_chart_rates_ma(spark, sf):
    return rounded(serving.chart_rates_ma(gold(spark, sf)), ["ma_7", "ma_30", "ma_90"])


# ---- scalar functions ----------------------------------------------------------


@query("fn_string")
def q_fn_string(spark, sf):
    r = tables.rates(spark, sf)
    pair = series.currency_pair()
    return r.select(
        "record_id",
        pair.alias("currency_pair"),
        scalar.pair_part(pair, 0).alias("base_part"),
        scalar.pair_part(pair, 1).alias("target_part"),
        F.trim(F.concat(F.lit("  "), F.col("base_currency"), F.lit("  "))).alias("trimmed"),
        F.length("base_currency").alias("base_len"),
    )


@query("fn_datetime")
def q_fn_datetime(spark, sf):
    o = tables.table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_orderkey").alias("record_id"),
        d.alias("d"),
        F.unix_date(d).alias("unix_day"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("unix_seconds"),
        scalar.iso_date(d).alias("iso_date"),
        F.date_add(d, 30).alias("plus_30"),
        scalar.weekday_number(d).alias("weekday"),
        (d >= F.lit("2001-06-01").cast("date")).alias("is_recent"),
    )


@query("fn_math")
def q_fn_math(spark, sf):
    s = silver(spark, sf)
    return s.select(
        "date",
        "currency_pair",
        r8(F.col("rate") / F.col("prev_rate") - F.lit(1.0)).alias("simple_return"),
        r8(F.abs("daily_return") * F.lit(100.0)).alias("abs_return_pct"),
        (F.round("rate", 2) + F.lit(0.0)).alias("rate_2dp"),
        (F.bround(F.col("rate") / F.lit(1000.0), 1) + F.lit(0.0)).alias("rate_k_even"),
    )


@query("fn_null")
def q_fn_null(spark, sf):
    s = silver(spark, sf)
    return s.select(
        "date",
        "currency_pair",
        F.coalesce("prev_rate", "rate").alias("prev_or_rate"),
        F.col("prev_rate").isNotNull().alias("has_prev"),
        F.col("rate").between(F.lit(10000.0), F.lit(50000.0)).alias("mid_band"),
        F.when(F.col("prev_rate").isNull(), F.lit("first"))
        .when(F.col("rate") != F.col("prev_rate"), F.lit("moved"))
        .otherwise(F.lit("flat"))
        .alias("state"),
        F.nullif(F.col("target_currency"), F.lit("F")).alias("open_target"),
    )


@query("fn_json_map")
def q_fn_json_map(spark, sf):
    p = tables.payloads(spark, sf)
    return p.select(
        "event_id",
        F.size("rates").alias("n_keys"),
        F.map_keys("rates")[0].alias("first_key"),
        F.col("rates")["k"].try_cast("double").alias("k_value"),
    )
