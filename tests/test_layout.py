"""Layout of the written layers: file sizes under a hot key, bronze through the job, pruning of the latest day."""

from __future__ import annotations

import json
import os
from datetime import date, timedelta

from pyspark.sql import functions as F

from ratelake.plans import layers, serving
from ratelake.plans.jobs import JobParams, LakePaths, run_layers


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_rebalance_cuts_a_hot_partition(spark, tmp_dir):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    rows = spark.range(0, 200_000, 1, 8).select(  # AQE cuts between the outputs of map tasks
        F.when(F.col("id") % 20 == 0, F.concat(F.lit("P"), (F.col("id") % 7).cast("string"))).otherwise("HOT").alias("currency_pair"), F.rand(3).alias("rate")
    )
    try:
        spark.conf.set(size, "256k")
        layers.write_layer(rows, f"{tmp_dir}/t", ["currency_pair"], rebalance=True)
    finally:
        spark.conf.set(size, old)
    hot = files(f"{tmp_dir}/t/currency_pair=HOT")
    assert len(hot) >= 4 and max(map(os.path.getsize, hot)) < 1_000_000
    # rare values that share the hot value's partition lie in some of its pieces, never in more
    assert all(1 <= len(files(f"{tmp_dir}/t/currency_pair=P{k}")) <= len(hot) for k in range(7))
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 200_000


def test_bronze_gets_its_layout_through_the_job(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/rates_USD.jsonl", "w") as f:
        for k in range(5):
            day = str(date(2024, 1, 1) + timedelta(days=k))
            f.write(json.dumps({"base": "USD", "date": day, "rates": {"EUR": 0.9 + k / 100, "GBP": 0.8}, "fetched_at": f"{day}T08:00:00"}) + "\n")
    paths = LakePaths(tmp_dir)
    run_layers(spark, paths, JobParams(raw_glob="rates_*.jsonl", partition_by=["base_currency"], rebalance=True), ["bronze"])
    assert os.path.isdir(os.path.join(paths.bronze, "base_currency=USD"))
    assert layers.read_layer(spark, paths.bronze).count() == 10


def test_latest_rates_reads_one_partition(spark, tmp_dir):
    rows = [(date(2024, 1, 1) + timedelta(days=d), f"P{p}", float(d + p)) for d in range(12) for p in range(3)]
    spark.createDataFrame(rows, "date date, currency_pair string, rate double").write.partitionBy("date").parquet(f"{tmp_dir}/gold")
    latest = serving.latest_rates(spark.read.parquet(f"{tmp_dir}/gold"), stored=True)
    assert {(r.date, r.currency_pair, r.rate) for r in latest.collect()} == {(date(2024, 1, 12), f"P{p}", 11.0 + p) for p in range(3)}
    latest = serving.latest_rates(spark.read.parquet(f"{tmp_dir}/gold"), stored=True)
    latest.collect()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "Subquery" in plan and "BroadcastExchange" not in plan
    empty = serving.latest_rates(spark.createDataFrame([], "date date, currency_pair string, rate double"), stored=True)
    assert empty.count() == 0


def test_no_silent_local_checkpoint_folder_on_a_cluster():
    import pytest

    from ratelake.session import ensure_checkpoint_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="checkpoint"):
        ensure_checkpoint_dir(Session())
