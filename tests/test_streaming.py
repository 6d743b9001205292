"""Incremental landing -> bronze stream equals the batch bronze over the same files."""

from __future__ import annotations

import json
import os

from ratelake.plans import layers
from ratelake.sources import landing
from ratelake.streaming.landing_stream import read_bronze, start_landing_to_bronze


def put(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(records) + "\n")


def rec(date, rates, fetched):
    return json.dumps({"base": "USD", "date": date, "rates": rates, "fetched_at": fetched, "source": "api"})


def test_stream_merges_batches_like_batch_bronze(spark, tmp_dir):
    src, bronze, quarantine, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "bronze", "quarantine", "ckpt"))
    put(src, "rates_USD_1.jsonl", [rec("2024-01-15", {"EUR": 0.92, "SEK": 10.4}, "2024-01-15T10:00:00+00:00"), "broken"])
    q = start_landing_to_bronze(spark, src, bronze, quarantine, ckpt)
    q.awaitTermination(120)
    assert read_bronze(spark, bronze).count() == 2

    # A re-fetch of the same day (newer) and a backfill of an older year.
    put(src, "rates_USD_2.jsonl", [rec("2024-01-15", {"EUR": 0.93}, "2024-01-15T11:00:00+00:00"), rec("2019-03-01", {"EUR": 0.88}, "2024-01-16T10:00:00+00:00")])
    q = start_landing_to_bronze(spark, src, bronze, quarantine, ckpt)
    q.awaitTermination(120)
    got = {(str(r.ingestion_date), r.target_currency): r.rate for r in read_bronze(spark, bronze).collect()}
    assert got == {("2024-01-15", "EUR"): 0.93, ("2024-01-15", "SEK"): 10.4, ("2019-03-01", "EUR"): 0.88}
    assert sorted(os.listdir(bronze)).count("year=2019") == 1

    good, _ = landing.load_raw_rates(spark, src, glob="rates_*.jsonl")
    batch = {tuple(r) for r in layers.transform_to_bronze(good).collect()}
    assert {tuple(r) for r in read_bronze(spark, bronze).collect()} == batch
    assert spark.read.json(quarantine).count() == 1


def test_latest_stream_after_restart_equals_the_batch(spark, tmp_dir):
    from ratelake.operators.aggregates import latest_per_key
    from ratelake.operators.series import add_currency_pair
    from ratelake.streaming.latest_stream import STATE_STORE, read_latest, start_landing_to_latest

    src, table, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "latest", "ckpt"))
    setting = spark.conf.get(STATE_STORE)

    def run():
        assert start_landing_to_latest(spark, src, table, ckpt, max_files=1).awaitTermination(120)
        assert spark.conf.get(STATE_STORE) == setting
        return {(r.base_currency, r.target_currency): (str(r.date), r.rate, r.source, r.ingested_at) for r in read_latest(spark, table).collect()}

    def batch():
        good, _ = landing.load_raw_rates(spark, src, glob="rates_*.jsonl")
        rows = latest_per_key(add_currency_pair(layers.transform_to_bronze(good)), order="ingestion_date")
        return {(r.base_currency, r.target_currency): (str(r.ingestion_date), r.rate, r.source, r.ingested_at) for r in rows.collect()}

    put(src, "rates_USD_1.jsonl", [rec("2024-01-15", {"EUR": 0.92, "SEK": 10.4}, "2024-01-15T10:00:00+00:00"), "broken"])
    put(src, "rates_USD_2.jsonl", [rec("2024-01-16", {"EUR": 0.95, "SEK": "n/a"}, "2024-01-16T10:00:00+00:00")])
    assert run() == batch()
    # after a restart: a repeated file, a late older day, a correction of the latest day, an older version of it, a new pair
    put(src, "rates_USD_3.jsonl", [rec("2024-01-15", {"EUR": 0.92, "SEK": 10.4}, "2024-01-15T10:00:00+00:00"), rec("2019-01-15", {"EUR": 0.5}, "2024-02-15T10:00:00+00:00")])
    put(src, "rates_USD_4.jsonl", [rec("2024-01-16", {"EUR": 0.96}, "2024-01-16T12:00:00+00:00"), rec("2024-01-16", {"EUR": 0.94, "JPY": 0.0}, "2024-01-16T08:00:00+00:00")])
    got = run()
    assert got == batch()
    assert got["USD", "EUR"][:2] == ("2024-01-16", 0.96) and got["USD", "SEK"][:2] == ("2024-01-15", 10.4)
    assert {r.currency_pair: r.valid for r in read_latest(spark, table).collect()} == {"USD_EUR": True, "USD_SEK": True, "USD_JPY": False}
    assert os.path.isdir(os.path.join(ckpt, "state"))


def test_latest_table_reads_only_touched_buckets_and_is_idempotent(spark, tmp_dir):
    from ratelake.streaming.latest_stream import COLUMNS, merge_latest, read_latest

    table = os.path.join(tmp_dir, "latest")
    assert read_latest(spark, table).count() == 0
    rows = spark.range(200).selectExpr(
        "concat('B', id, '_T') currency_pair", "concat('B', id) base_currency", "'T' target_currency", "date'2024-01-01' date", "double(id) rate", "'s' source", "timestamp'2024-01-01 00:00:00' ingested_at", "true valid"
    )
    merge_latest(spark, rows.select(*COLUMNS), table, 16)
    before = {f: os.path.getmtime(os.path.join(table, f)) for f in os.listdir(table) if f.startswith("bucket=")}
    one = rows.where("base_currency = 'B7'").withColumn("date", rows.date + 1)
    for _ in range(2):  # the second time is a replay
        merge_latest(spark, one.select(*COLUMNS), table, 16)
    changed = [f for f, t in before.items() if os.path.getmtime(os.path.join(table, f)) != t]
    assert len(before) > 10 and len(changed) <= 1
    merge_latest(spark, rows.where("base_currency = 'B7'").select(*COLUMNS), table, 16)  # older than what is there
    got = {r.base_currency: str(r.date) for r in read_latest(spark, table).collect()}
    assert len(got) == 200 and got["B7"] == "2024-01-02" and got["B8"] == "2024-01-01"
