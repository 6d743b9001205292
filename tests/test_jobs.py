"""End to end: landing JSON lines -> bronze -> silver -> gold -> forecast -> views; re-run identical."""

from __future__ import annotations

import json
import math
import os
from datetime import date, timedelta

from ratelake.plans.jobs import JobParams, LakePaths, run_layers
from ratelake.plans.serving import FORECAST_VIEW, LATEST_VIEW


def landing_fixture(path, n_days=45):
    os.makedirs(path, exist_ok=True)
    lines = []
    for i in range(n_days):
        d = date(2024, 1, 1) + timedelta(days=i)
        if d.weekday() >= 5:
            continue
        rates = {"EUR": 0.92 + 0.01 * math.sin(i / 4), "SEK": 10.4 + 0.1 * math.cos(i / 6), "GBP": 0.79}
        lines.append(json.dumps({"base": "USD", "date": d.isoformat(), "rates": rates, "fetched_at": f"{d}T06:00:00+00:00", "source": "fixture"}))
    lines.append("not json")
    with open(os.path.join(path, "rates_USD.jsonl"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return len(lines) - 1


def snapshot(spark, paths):
    out = {}
    for name in ("bronze", "silver", "gold", "forecasts"):
        out[name] = sorted(tuple(r) for r in spark.read.parquet(getattr(paths, name)).collect())
    return out


def test_full_job_and_rerun_identity(spark, tmp_dir):
    paths = LakePaths(root=tmp_dir)
    n_records = landing_fixture(paths.raw)
    params = JobParams(min_training_rows=30, run_ts="2024-03-01 00:00:00")
    res = run_layers(spark, paths, params)
    assert res.layers_run == ["bronze", "silver", "gold", "forecast", "serving"]
    first = snapshot(spark, paths)
    assert len(first["bronze"]) == 3 * n_records
    assert len(first["gold"]) == 3 * n_records
    assert len(first["forecasts"]) == 3 * 30
    assert res.metrics["silver"] == {"rows_in": 3 * n_records, "rows_rejected": 0}
    assert spark.read.json(paths.quarantine).count() == 1
    assert spark.table(LATEST_VIEW).count() == 3 and spark.catalog.tableExists(FORECAST_VIEW)
    run_layers(spark, paths, params)
    assert snapshot(spark, paths) == first


def test_bronze_skipped_without_landing_and_unknown_layer(spark, tmp_dir):
    paths = LakePaths(root=tmp_dir)
    res = run_layers(spark, paths, layers_to_run=["bronze"])
    assert res.skipped == ["bronze"] and res.layers_run == []
    try:
        run_layers(spark, paths, layers_to_run=["platinum"])
    except ValueError as exc:
        assert "platinum" in str(exc)
    else:
        raise AssertionError("unknown layer accepted")


def test_partitioned_layer_write_replaces_only_present_partitions(spark, tmp_dir):
    from pyspark.sql import functions as F

    from ratelake.plans.layers import DatasetMissing, read_layer, write_layer

    out = f"{tmp_dir}/gold"
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "currency_pair string, rate double")
    write_layer(df, out, partition_by=["currency_pair"])
    write_layer(df.filter("currency_pair = 'A'").withColumn("rate", F.lit(9.0)), out, partition_by=["currency_pair"])
    got = {r.currency_pair: r.rate for r in read_layer(spark, out).collect()}
    assert got == {"A": 9.0, "B": 2.0}
    try:
        read_layer(spark, f"{tmp_dir}/nothing")
    except DatasetMissing:
        pass
    else:
        raise AssertionError("missing dataset not reported")


def test_job_with_other_windows_layout_and_names(spark, tmp_dir):
    from ratelake.plans.serving import example_queries, run_sql

    paths = LakePaths(root=tmp_dir)
    n_records = landing_fixture(paths.raw)
    params = JobParams(
        windows=(5, 20), volatility_window=10, max_rate=5.0, split_chunk_rows=20, partition_by=["currency_pair"],
        max_records_per_file=7, model="grouped", model_params={"yearly": False}, gold_table="g2", forecast_table="f2",
    )
    run_layers(spark, paths, params)
    gold = spark.table("g2")
    assert {"ma_5", "ma_20", "volatility_10"} <= set(gold.columns) and gold.count() == 2 * n_records
    assert sorted(x for x in os.listdir(paths.gold) if "=" in x) == ["currency_pair=USD_EUR", "currency_pair=USD_GBP"]
    files = [x for x in os.listdir(os.path.join(paths.gold, "currency_pair=USD_EUR")) if x.endswith(".parquet")]
    assert len(files) >= n_records // 7
    assert {r.reason for r in spark.read.parquet(paths.rejected).collect()} == {"above_max"}
    assert spark.read.parquet(paths.rejected).count() == n_records
    assert spark.table("f2").count() == 2 * 30 and spark.read.parquet(paths.skipped).count() == 0
    for name, text in example_queries(gold, gold_table="g2").items():
        args = {"threshold": 1.0} if ":threshold" in text else None
        assert run_sql(spark, text, args).count() > 0, name


def test_partition_without_rows_is_gone_after_a_rebuild(spark, tmp_dir):
    from ratelake.plans.layers import read_layer, write_layer

    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "currency_pair string, rate double")
    write_layer(df, f"{tmp_dir}/t", ["currency_pair"], rebuild=True)
    write_layer(df.filter("currency_pair = 'A'"), f"{tmp_dir}/t", ["currency_pair"], rebuild=True)
    assert [tuple(r) for r in read_layer(spark, f"{tmp_dir}/t", df.schema).collect()] == [("A", 1.0)]


def test_tied_rows_give_one_result_in_any_order(spark, tmp_dir):
    from ratelake.plans.layers import transform_to_bronze
    from ratelake.streaming.landing_stream import merge_into_bronze, read_bronze

    rows = [(date(2024, 1, 1), "USD", "EUR", r, "s", None) for r in (0.92, 0.93, 0.91)]
    kind = "ingestion_date date, base_currency string, target_currency string, rate double, source string, ingested_at timestamp"
    for k, order in enumerate((rows, rows[::-1])):
        df = spark.createDataFrame(order, kind)
        assert [r.rate for r in transform_to_bronze(df).collect()] == [0.93]
        for row in order:  # one micro-batch per row
            merge_into_bronze(spark, spark.createDataFrame([row], kind), f"{tmp_dir}/b{k}")
        assert [r.rate for r in read_bronze(spark, f"{tmp_dir}/b{k}").collect()] == [0.93]
