"""Bronze, silver and gold transforms and the layer jobs around them.

Shuffle budget per layer (see README, "Plans"):

* bronze: one exchange on the (date, base, target) key, after a map-side
  partial ``max_by`` that collapses copies of a key inside each task;
* silver: one exchange on ``currency_pair``, shared by the (pair, date) guard,
  the LAG and everything else in the layer;
* gold: one exchange on ``currency_pair``, shared by the guard, all rolling
  frames and the lifetime z-score.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.operators.frames import (
    deduplicate,
    enforce_schema,
    first_per_sub_key,
    require_columns,
    run_timestamp,
)
from ratelake.operators.quality import filter_valid_rates, observe_validity, rejected_rates
from ratelake.operators.series import (
    PAIR,
    add_currency_pair,
    add_date_column,
    add_rate_z_score_by_join,
    prev_value,
    prev_value_blocks,
    rolling_days_split,
    rolling_feature_columns,
    rolling_features_blocks,
    simple_return,
    z_score_column,
)
from ratelake.schemas import (
    BRONZE_SCHEMA,
    DEFAULT_VOLATILITY_WINDOW,
    DEFAULT_WINDOWS,
    MAX_VALID_RATE,
    MIN_VALID_RATE,
    SILVER_SCHEMA,
    gold_schema,
)

BRONZE_KEY = ["ingestion_date", "base_currency", "target_currency"]
SILVER_KEY = ["date", PAIR]


def parse_bronze_columns(df: DataFrame) -> DataFrame:
    """Text ``ingestion_date`` / ``ingested_at`` to DATE / TIMESTAMP; typed input passes through, unparsable text becomes NULL."""
    out = df
    if dict(df.dtypes).get("ingestion_date") == "string":
        out = out.withColumn("ingestion_date", F.try_to_date("ingestion_date"))
    if dict(df.dtypes).get("ingested_at") == "string":
        out = out.withColumn("ingested_at", F.try_to_timestamp("ingested_at"))
    return out


def transform_to_bronze(df: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Parse, enforce the bronze schema, keep the latest ingestion per key.

    ``tie_breakers`` are extra input columns ordering rows with equal
    ``ingested_at`` (e.g. a record id); source and rate end the order, so it is total.
    """
    parsed = parse_bronze_columns(df)
    extra = [c for c in tie_breakers if c not in BRONZE_SCHEMA.fieldNames()]
    require_columns(parsed, BRONZE_SCHEMA.fieldNames() + extra)
    typed = parsed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields], *extra)
    latest = deduplicate(typed, BRONZE_KEY, ["ingested_at", *tie_breakers, "source", "rate"])
    return enforce_schema(latest, BRONZE_SCHEMA)


def silver_core(
    bronze: DataFrame,
    min_rate: float = MIN_VALID_RATE,
    max_rate: float = MAX_VALID_RATE,
) -> DataFrame:
    """Filter, name the pair, guard (date, pair) uniqueness and add LAG / return.

    Every window here is partitioned by the pair alone, so the guard and the
    LAG share a single exchange (and gold reuses it when chained). Input is bronze, unique on
    (date, base, target), so one pair holds at most one row per day per
    (base, target) spelling of the pair.
    """
    df = add_date_column(add_currency_pair(filter_valid_rates(bronze, min_rate, max_rate)))
    df = first_per_sub_key(
        df,
        [PAIR],
        "date",
        [F.col("ingested_at").desc(), F.col("base_currency").desc(), F.col("target_currency").desc()],
    )
    return df.withColumn("prev_rate", prev_value("rate")).withColumn("daily_return", simple_return())


def silver_core_split(
    bronze: DataFrame,
    min_rate: float = MIN_VALID_RATE,
    max_rate: float = MAX_VALID_RATE,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Silver for pairs too long for one task: copies are collapsed by a map-side
    aggregate, the LAG runs in blocks of ``chunk_rows`` days (one row a day at most) with a halo of one row."""
    df = add_date_column(add_currency_pair(filter_valid_rates(bronze, min_rate, max_rate)))
    df = deduplicate(df, SILVER_KEY, ["ingested_at", "base_currency", "target_currency"])
    return prev_value_blocks(df, block_days=chunk_rows).withColumn("daily_return", simple_return())


def transform_to_silver(
    bronze: DataFrame,
    min_rate: float = MIN_VALID_RATE,
    max_rate: float = MAX_VALID_RATE,
    run_ts: datetime | str | None = None,
    split_chunk_rows: int | None = None,
) -> DataFrame:
    """Silver layer. ``split_chunk_rows`` spreads one pair over many tasks (:func:`silver_core_split`)."""
    if split_chunk_rows:
        core = silver_core_split(bronze, min_rate, max_rate, split_chunk_rows)
    else:
        core = silver_core(bronze, min_rate, max_rate)
    df = core.withColumn("processed_at", run_timestamp(run_ts))
    return enforce_schema(df, SILVER_SCHEMA)


def gold_core(
    silver: DataFrame,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    volatility_window: int = DEFAULT_VOLATILITY_WINDOW,
    calendar_days: bool = False,
) -> DataFrame:
    """Rolling features and lifetime z-score on one exchange of the pair."""
    df = silver.select("date", PAIR, "rate", "daily_return")
    df = first_per_sub_key(df, [PAIR], "date", [F.col("rate").desc(), F.col("daily_return").desc()])
    df = df.select("*", *rolling_feature_columns(windows, volatility_window, calendar_days=calendar_days))
    return df.withColumn("rate_z_score", z_score_column("rate"))


def gold_core_split(
    silver: DataFrame,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    volatility_window: int = DEFAULT_VOLATILITY_WINDOW,
    chunk_rows: int = 100_000,
    calendar_days: bool = False,
) -> DataFrame:
    """Gold for series too long for one task: the pair is cut into blocks of ``chunk_rows`` days with a lookback halo, a scan
    over one short row per block gives halos and lifetime moments, and (pair, date) uniqueness is enforced with the
    map-side ``max_by`` dedup. Frames over ``calendar_days`` copy their days forward and join the z-score's aggregate."""
    df = deduplicate(silver.select("date", PAIR, "rate", "daily_return"), [PAIR, "date"], ["rate", "daily_return"])
    if calendar_days:
        return add_rate_z_score_by_join(rolling_days_split(df, windows, volatility_window, block_days=chunk_rows))
    return rolling_features_blocks(df, windows, volatility_window, block_days=chunk_rows)


def transform_to_gold(
    silver: DataFrame,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    volatility_window: int = DEFAULT_VOLATILITY_WINDOW,
    run_ts: datetime | str | None = None,
    calendar_days: bool = False,
    split_chunk_rows: int | None = None,
) -> DataFrame:
    """Gold layer. ``split_chunk_rows`` switches to :func:`gold_core_split` (for keys whose
    series does not fit one task); the default keeps one window partition per pair."""
    if split_chunk_rows:
        core = gold_core_split(silver, windows, volatility_window, split_chunk_rows, calendar_days)
    else:
        core = gold_core(silver, windows, volatility_window, calendar_days)
    df = core.withColumn("created_at", run_timestamp(run_ts))
    return enforce_schema(df, gold_schema(windows, volatility_window))


# --------------------------------------------------------------------------
# Layer jobs: read -> transform -> write -> read back. One action per layer.
# --------------------------------------------------------------------------


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    rebuild: bool = False,
    max_records_per_file: int | None = None,
    rebalance: bool = False,
) -> None:
    """Overwrite a layer. With ``partition_by`` only the partitions present are replaced (dynamic overwrite), unless
    it is a full ``rebuild`` (static overwrite: partitions that no longer have rows go too).
    ``rebalance`` shapes the files: rows are dealt by ``partition_by``, and AQE cuts partitions over, and joins ones under,
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a hot value gives several files and rare ones share a task.
    ``max_records_per_file`` bounds the size of the files; ``single_file`` mirrors a one-file layer for small data; it funnels the last stage into one task."""
    out = df.hint("rebalance", *partition_by) if rebalance and not single_file else df
    out = out.coalesce(1) if single_file else out
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static" if rebuild else "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


class DatasetMissing(FileNotFoundError):
    """A layer table that should exist has not been written yet."""


def read_layer(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a written layer (with its schema when given); a missing table raises ``DatasetMissing``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        df = reader.parquet(path)
    except Exception as exc:  # noqa: BLE001 - only a missing path is translated
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            raise DatasetMissing(f"No dataset at {path}; run the upstream layer first") from exc
        raise
    return df.select(*schema.fieldNames()) if schema is not None else df


def run_bronze(
    spark: SparkSession, raw: DataFrame, bronze_path: str, tie_breakers: Sequence[str] = (), **layout
) -> DataFrame:
    """Bronze job; ``layout`` (partition_by, max_records_per_file) goes to :func:`write_layer`, as in the jobs below."""
    write_layer(transform_to_bronze(raw, tie_breakers), bronze_path, rebuild=True, **layout)
    return read_layer(spark, bronze_path, BRONZE_SCHEMA)


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    min_rate: float = MIN_VALID_RATE,
    max_rate: float = MAX_VALID_RATE,
    run_ts: datetime | str | None = None,
    split_chunk_rows: int | None = None,
    rejected_path: str | None = None,
    **layout,
) -> tuple[DataFrame, dict]:
    """Silver job; returns the written table and the validity counters of the same pass.

    With ``rejected_path`` the rows the validity filter drops are written there, each with its reason.
    """
    source = read_layer(spark, bronze_path, BRONZE_SCHEMA)
    bronze, obs = observe_validity(source, min_rate, max_rate)
    write_layer(transform_to_silver(bronze, min_rate, max_rate, run_ts, split_chunk_rows), silver_path, rebuild=True, **layout)
    if rejected_path:
        write_layer(rejected_rates(source, min_rate, max_rate), rejected_path, rebuild=True)
    return read_layer(spark, silver_path, SILVER_SCHEMA), dict(obs.get)


def run_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    windows: Sequence[int] = DEFAULT_WINDOWS,
    volatility_window: int = DEFAULT_VOLATILITY_WINDOW,
    run_ts: datetime | str | None = None,
    calendar_days: bool = False,
    split_chunk_rows: int | None = None,
    **layout,
) -> DataFrame:
    silver = read_layer(spark, silver_path, SILVER_SCHEMA)
    gold = transform_to_gold(silver, windows, volatility_window, run_ts, calendar_days, split_chunk_rows)
    write_layer(gold, gold_path, rebuild=True, **layout)
    return read_layer(spark, gold_path, gold_schema(windows, volatility_window))
