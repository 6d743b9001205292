"""Physical plans: shuffles, pruning and pushdown are what we claim."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelake.plans import catalog, forecast, layers
from ratelake.plans.oracle import RUN_TS
from ratelake.sources import tables

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chain_to_forecast_has_two_exchanges(spark):
    df = forecast.forecast(catalog.gold(spark, SF), run_ts=RUN_TS)
    assert plan_of(df).count("Exchange hashpartitioning") == 2


def test_gold_layer_from_parquet_has_one_exchange(spark, tmp_dir):
    layers.transform_to_silver(catalog.bronze(spark, SF), run_ts=RUN_TS).write.parquet(f"{tmp_dir}/silver")
    g = layers.transform_to_gold(spark.read.parquet(f"{tmp_dir}/silver"), run_ts=RUN_TS)
    p = plan_of(g)
    assert p.count("Exchange") == 1 and "hashpartitioning(currency_pair" in p


def test_bronze_dedup_is_partial_aggregate_before_shuffle(spark):
    p = plan_of(catalog.bronze(spark, SF))
    assert "partial_max_by" in p
    assert p.index("Exchange") < p.index("partial_max_by")  # the partial step sits below (before) the exchange


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    r = tables.rates(spark, SF).filter(F.col("ingestion_date") >= F.lit("1998-01-01").cast("date")).select("rate")
    p = plan_of(r)
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in p
    assert "PushedFilters: [IsNotNull(o_orderdate)" in p


def test_latest_rates_broadcasts_only_the_one_row_max(spark):
    p = plan_of(catalog.QUERIES["latest_rates"](spark, SF))
    assert "BroadcastExchange" in p and "LeftSemi" in p


def test_split_mode_has_no_window_on_the_whole_pair(spark):
    s = layers.transform_to_silver(catalog.bronze(spark, SF), max_rate=catalog.MAX_PRICE, run_ts=RUN_TS, split_chunk_rows=128)
    g = layers.transform_to_gold(s, run_ts=RUN_TS, split_chunk_rows=128)
    specs = [x for x in plan_of(forecast.forecast(g, run_ts=RUN_TS, split=True)).splitlines() if "+- Window [" in x]
    assert specs
    # The only window over a whole pair sums the per-block row counts: one row per pair and year.
    assert all("_chunk" in x or "_blk" in x for x in specs)


def test_split_gold_reads_its_input_once(spark, tmp_dir):
    layers.transform_to_silver(catalog.bronze(spark, SF), run_ts=RUN_TS).write.parquet(f"{tmp_dir}/silver")
    silver = spark.read.parquet(f"{tmp_dir}/silver")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows the reuse before it runs
    try:
        p = plan_of(layers.transform_to_gold(silver, run_ts=RUN_TS, split_chunk_rows=366))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("FileScan") == 1 and p.count("ReusedExchange") == 1
    # dedup, blocks, scan of the blocks' short rows, and those rows back to their blocks (broadcast or shuffled);
    # the line of the reused exchange names it again
    assert p.count("Exchange hashpartitioning") - 1 + p.count("BroadcastExchange") <= 4


def test_stream_merge_reads_only_the_touched_years(spark, tmp_dir):
    from ratelake.streaming.landing_stream import merge_into_bronze, touched_years

    rows = catalog.bronze(spark, SF)
    merge_into_bronze(spark, rows, f"{tmp_dir}/bronze")
    batch = rows.filter("ingestion_date < '1996-01-01'").withColumn("year", F.year("ingestion_date"))
    p = plan_of(touched_years(spark.read.parquet(f"{tmp_dir}/bronze"), batch))
    years = sorted({r.year for r in batch.select("year").collect()})
    part = p[p.index("PartitionFilters") :].split("PushedFilters")[0]
    assert years and all(str(y) in part for y in years) and "1997" not in part
