"""Serving: tables and views over gold / forecasts, and the analytical queries on them.

Views are session temp views (or catalog tables with ``save_as_table``);
their definitions take the table names as parameters, so renaming a table
never breaks a view. Spark views promise no order: queries sort at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ratelake.operators.aggregates import avg_volatility, latest_per_key
from ratelake.operators.quality import outliers, select_pairs
from ratelake.operators.series import PAIR, tail_rows

# Default serving names.
GOLD_TABLE = "gold_exchange_rates"
FORECAST_TABLE = "ml_forecasts"
LATEST_VIEW = "v_latest_rates"
LATEST_PER_PAIR_VIEW = "v_latest_per_pair"
FORECAST_VIEW = "v_forecast_summary"


def latest_columns(gold: DataFrame) -> list[str]:
    """Key, rate and every feature the gold table has, whatever its windows."""
    features = [c for c in gold.columns if c.startswith(("ma_", "volatility_")) or c == "rate_z_score"]
    return [PAIR, "date", "rate", *features]


def latest_rates(gold: DataFrame, columns: Sequence[str] | None = None, stored: bool = False) -> DataFrame:
    """Rows on the global latest date (a semi-join with the one-row global max). For a ``stored`` table a scalar subquery
    finds the date first: of one partitioned by the date only that partition is read, of others only the row groups that
    may hold it."""
    if stored:
        rows = gold.where(F.col("date") == gold.agg(F.max("date")).scalar())
    else:
        last = gold.agg(F.max("date").alias("_max_date"))  # exactly one row: safe to broadcast
        rows = gold.join(F.broadcast(last), F.col("date") == F.col("_max_date"), "left_semi")
    return rows.select(*(columns or latest_columns(gold))).orderBy(PAIR)


def latest_per_pair(gold: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each pair's own latest row (pairs that stopped earlier are still shown)."""
    columns = list(columns or latest_columns(gold))
    return latest_per_key(gold.select(*columns), PAIR, "date").select(*columns)


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    return forecasts.select(
        PAIR,
        "forecast_date",
        F.col("yhat").alias("forecast_rate"),
        F.col("yhat_lower").alias("lower_bound"),
        F.col("yhat_upper").alias("upper_bound"),
        (F.col("yhat_upper") - F.col("yhat_lower")).alias("uncertainty_range"),
        "model_trained_at",
    )


def forecast_display(forecasts: DataFrame, interval_width: float = 0.95, digits: int = 5) -> DataFrame:
    """Forecast table as shown to users: Date / Forecast / Lower / Upper, rounded."""
    pct = f"{round(interval_width * 100):d}%"
    return forecasts.select(
        PAIR,
        F.col("forecast_date").alias("Date"),
        F.round("yhat", digits).alias("Forecast"),
        F.round("yhat_lower", digits).alias(f"Lower ({pct})"),
        F.round("yhat_upper", digits).alias(f"Upper ({pct})"),
    )


def top_outliers(gold: DataFrame, k: int = 20, threshold: float = 2.0) -> DataFrame:
    """The ``k`` largest |z| above the threshold (a top-k, planned as TakeOrderedAndProject)."""
    return (
        outliers(gold, threshold)
        .select("date", PAIR, "rate", "rate_z_score")
        .orderBy(F.abs("rate_z_score").desc(), F.col("date"), F.col(PAIR))
        .limit(k)
    )


def table_preview(df: DataFrame, n: int = 10, order: Sequence[str] = ("date", PAIR)) -> DataFrame:
    return df.orderBy(*order).limit(n)


def history_and_forecast(gold: DataFrame, forecasts: DataFrame, history_rows: int = 90) -> DataFrame:
    """Last ``history_rows`` observations per pair stacked on the forecast, tagged by kind."""
    hist = tail_rows(gold.select(PAIR, "date", "rate"), history_rows).select(
        PAIR,
        "date",
        F.lit("history").alias("kind"),
        F.col("rate").alias("value"),
        F.lit(None).cast("double").alias("lower"),
        F.lit(None).cast("double").alias("upper"),
    )
    fc = forecasts.select(
        PAIR,
        F.col("forecast_date").alias("date"),
        F.lit("forecast").alias("kind"),
        F.col("yhat").alias("value"),
        F.col("yhat_lower").alias("lower"),
        F.col("yhat_upper").alias("upper"),
    )
    return hist.unionByName(fc)


def chart_rates(gold: DataFrame, pairs: Sequence[str] | None = None) -> DataFrame:
    return select_pairs(gold, pairs).select("date", PAIR, "rate")


def chart_rates_ma(gold: DataFrame, pairs: Sequence[str] | None = None, windows: Sequence[int] | None = None) -> DataFrame:
    """Rates with the given moving averages, by default all that the gold table has."""
    names = [f"ma_{n}" for n in windows] if windows else [c for c in gold.columns if c.startswith("ma_")]
    return select_pairs(gold, pairs).select("date", PAIR, "rate", *names)


def chart_returns(gold: DataFrame, pairs: Sequence[str] | None = None) -> DataFrame:
    """Daily returns in percent for the selected pairs (NULL returns dropped)."""
    return (
        select_pairs(gold, pairs)
        .filter(F.col("daily_return").isNotNull())
        .select("date", PAIR, (F.col("daily_return") * F.lit(100.0)).alias("daily_return_pct"))
    )


# --------------------------------------------------------------------------
# Catalog: register tables and views, list them, run ad-hoc SQL.
# --------------------------------------------------------------------------


def register_table(spark: SparkSession, df: DataFrame, name: str, save_as_table: bool = False) -> None:
    """Create or replace ``name``: a temp view by default, a managed table with ``save_as_table``."""
    if save_as_table:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)


def load_parquet_as_table(spark: SparkSession, name: str, path: str, recursive: bool = False) -> int:
    """Register a parquet file, flat directory or hive-partitioned tree as ``name`` (replacing it).

    Returns the row count (answered from parquet footers), 0 when the path
    does not exist (nothing registered). ``recursive`` reads nested folders
    without partition discovery."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    try:
        df = reader.parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return 0
        raise
    df.createOrReplaceTempView(name)
    return df.count()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_views(
    spark: SparkSession,
    gold_table: str = GOLD_TABLE,
    forecast_table: str = FORECAST_TABLE,
) -> list[str]:
    """Create the serving views over the named tables; the forecast view only when forecasts exist."""
    gold = spark.table(gold_table)
    latest_rates(gold, stored=True).createOrReplaceTempView(LATEST_VIEW)
    latest_per_pair(gold).createOrReplaceTempView(LATEST_PER_PAIR_VIEW)
    made = [LATEST_VIEW, LATEST_PER_PAIR_VIEW]
    if table_exists(spark, forecast_table):
        forecast_summary(spark.table(forecast_table)).createOrReplaceTempView(FORECAST_VIEW)
        made.append(FORECAST_VIEW)
    return made


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current session with their type."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_name string, table_type string, is_temporary boolean").orderBy("table_name")


def run_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the registered tables; values go in as named parameter markers."""
    return spark.sql(text, args=args or None)


def example_queries(gold: DataFrame, top: int = 20, gold_table: str = GOLD_TABLE) -> dict[str, str]:
    """SQL texts over our tables and views, for the windows this gold table has; every order is total."""
    spread = [c for c in gold.columns if c.startswith("volatility_")]
    texts = {
        "newest_day": f"SELECT * FROM {LATEST_VIEW} ORDER BY {PAIR}",
        "newest_by_pair": f"SELECT * FROM {LATEST_PER_PAIR_VIEW} ORDER BY {PAIR}, date",
        "days_by_pair": f"SELECT {PAIR}, count(*) AS days, min(date) AS first_day, max(date) AS last_day FROM {gold_table} GROUP BY {PAIR} ORDER BY {PAIR}",
        "widest_z_scores": f"SELECT {PAIR}, date, rate_z_score FROM {gold_table} WHERE abs(rate_z_score) > :threshold "
        f"ORDER BY abs(rate_z_score) DESC, {PAIR}, date LIMIT {top}",
    }
    for c in spread:
        texts[f"mean_{c}"] = f"SELECT {PAIR}, avg({c}) AS mean_{c} FROM {gold_table} GROUP BY {PAIR} ORDER BY mean_{c} DESC NULLS LAST, {PAIR}"
    return texts


__all__ = [
    "chart_rates",
    "chart_rates_ma",
    "chart_returns",
    "create_views",
    "example_queries",
    "forecast_display",
    "forecast_summary",
    "history_and_forecast",
    "latest_columns",
    "latest_per_pair",
    "latest_rates",
    "list_tables",
    "load_parquet_as_table",
    "register_table",
    "run_sql",
    "table_exists",
    "table_preview",
    "top_outliers",
]
