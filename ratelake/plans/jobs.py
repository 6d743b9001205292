"""Whole batch job: chosen layers in a fixed order on one session.

Each layer reads the previous layer's table, writes its own and reads it back
(one write job per layer; lineage is cut at every layer boundary, so a lost
executor only recomputes inside the current layer). The job stops at the
first failing layer.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import SparkSession

from ratelake.plans import forecast as fc
from ratelake.plans import layers, serving
from ratelake.schemas import (
    BRONZE_SCHEMA,
    DEFAULT_VOLATILITY_WINDOW,
    DEFAULT_WINDOWS,
    FORECAST_HORIZON_DAYS,
    INTERVAL_WIDTH,
    MAX_VALID_RATE,
    MIN_TRAINING_ROWS,
    MIN_VALID_RATE,
)
from ratelake.sources import landing

log = logging.getLogger(__name__)

LAYER_ORDER = ("bronze", "silver", "gold", "forecast", "serving")


@dataclass
class LakePaths:
    root: str
    raw: str = ""
    bronze: str = ""
    silver: str = ""
    gold: str = ""
    forecasts: str = ""
    quarantine: str = ""
    staged: str = ""
    rejected: str = ""
    skipped: str = ""

    def __post_init__(self) -> None:
        for name in ("raw", "bronze", "silver", "gold", "forecasts", "quarantine", "staged", "rejected", "skipped"):
            if not getattr(self, name):
                setattr(self, name, os.path.join(self.root, name))


@dataclass
class JobParams:
    min_rate: float = MIN_VALID_RATE
    max_rate: float = MAX_VALID_RATE
    windows: Sequence[int] = DEFAULT_WINDOWS
    volatility_window: int = DEFAULT_VOLATILITY_WINDOW
    horizon: int = FORECAST_HORIZON_DAYS
    min_training_rows: int = MIN_TRAINING_ROWS
    interval_width: float = INTERVAL_WIDTH
    raw_glob: str | None = landing.DEFAULT_GLOB
    run_ts: datetime | str | None = None
    calendar_days: bool = False
    split_chunk_rows: int | None = None  # spreads one pair over many tasks in silver and gold
    partition_by: Sequence[str] = ()  # of silver and gold
    max_records_per_file: int | None = None
    rebalance: bool = False
    model: str = "default"
    model_params: dict | None = None
    gold_table: str = serving.GOLD_TABLE
    forecast_table: str = serving.FORECAST_TABLE


@dataclass
class JobResult:
    layers_run: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)


def run_layers(
    spark: SparkSession,
    paths: LakePaths,
    params: JobParams | None = None,
    layers_to_run: Sequence[str] = LAYER_ORDER,
) -> JobResult:
    """Run the chosen layers in pipeline order; raises on the first failing layer."""
    params = params or JobParams()
    unknown = set(layers_to_run) - set(LAYER_ORDER)
    if unknown:
        msg = f"Unknown layers: {sorted(unknown)}"
        raise ValueError(msg)
    result = JobResult()
    layout = {"partition_by": params.partition_by, "max_records_per_file": params.max_records_per_file, "rebalance": params.rebalance}
    # bronze has no pair yet: it takes the partition columns that it has
    in_bronze = [c for c in params.partition_by if c in BRONZE_SCHEMA.fieldNames()]
    for layer in [x for x in LAYER_ORDER if x in layers_to_run]:
        log.info("running layer %s", layer)
        if layer == "bronze":
            try:
                # Raises when no row is usable, before anything is overwritten.
                good, quarantine = landing.load_raw_rates(spark, paths.raw, params.raw_glob, params.run_ts, paths.staged)
            except FileNotFoundError:
                log.warning("no landing files in %s: bronze skipped", paths.raw)
                result.skipped.append("bronze")
                continue
            quarantine.write.mode("overwrite").json(paths.quarantine)
            layers.run_bronze(spark, good, paths.bronze, **{**layout, "partition_by": in_bronze})
        elif layer == "silver":
            _, counters = layers.run_silver(
                spark,
                paths.bronze,
                paths.silver,
                params.min_rate,
                params.max_rate,
                params.run_ts,
                params.split_chunk_rows,
                paths.rejected,
                **layout,
            )
            result.metrics["silver"] = counters
        elif layer == "gold":
            layers.run_gold(
                spark,
                paths.silver,
                paths.gold,
                params.windows,
                params.volatility_window,
                params.run_ts,
                params.calendar_days,
                params.split_chunk_rows,
                **layout,
            )
        elif layer == "forecast":
            out = fc.run_forecasting(
                spark,
                paths.gold,
                paths.forecasts,
                params.horizon,
                params.min_training_rows,
                params.interval_width,
                params.run_ts,
                params.model,
                params.model_params,
                paths.skipped,
            )
            if out is None:
                log.warning("no pair produced a forecast; previous forecasts kept")
        elif layer == "serving":
            serving.load_parquet_as_table(spark, params.gold_table, paths.gold)
            serving.load_parquet_as_table(spark, params.forecast_table, paths.forecasts)
            result.metrics["views"] = serving.create_views(spark, params.gold_table, params.forecast_table)
        result.layers_run.append(layer)
    return result
