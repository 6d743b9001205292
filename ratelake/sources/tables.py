"""Rate series derived from the driver's parquet tables.

Every query of the catalog reads these, so its work grows with the tables:

* ``rates``     - ``orders`` as bronze-shaped landing rows: date = order date,
  base = order priority, target = order status, rate = total price,
  ``record_id`` = order key (tie-breaker among rows ingested at the same time).
* ``line_rates`` - the same shape from ``lineitem`` (the bench-size series):
  base = return flag, target = line status, rate = extended price.
* ``daily``     - ``events`` averaged per (day, event type): an already
  deduplicated daily series, 30 days per type.
* ``payloads``  - ``events.props`` parsed as a JSON map.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("date").alias("ingestion_date"),
        F.col("o_orderpriority").alias("base_currency"),
        F.col("o_orderstatus").alias("target_currency"),
        F.col("o_totalprice").alias("rate"),
        F.lit("orders").alias("source"),
        F.col("o_orderdate").cast("timestamp").alias("ingested_at"),
        F.col("o_orderkey").alias("record_id"),
    )


def line_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
        F.col("l_returnflag").alias("base_currency"),
        F.col("l_linestatus").alias("target_currency"),
        F.col("l_extendedprice").alias("rate"),
        F.lit("lineitem").alias("source"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("record_id"),
    )


def supplier_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with one series per supplier and line status: many keys, so every layer grows with the table."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("date").alias("ingestion_date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("base_currency"),
        F.col("l_linestatus").alias("target_currency"),
        F.col("l_extendedprice").alias("rate"),
        F.lit("lineitem").alias("source"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("record_id"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("currency_pair")).agg(
        F.round(F.avg("value"), 8).alias("rate")
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("ts").cast("date").alias("date"),
        F.col("event_type"),
        F.from_json("props", "map<string,string>").alias("rates"),
    )
