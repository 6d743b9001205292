"""Landing zone: JSON-lines scan, quarantine, keyed upsert, planning."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ratelake.operators.quality import missing_targets
from ratelake.plans import planning
from ratelake.sources import landing


def write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def record(date, rates, base="USD", fetched="2024-01-15T10:00:00+00:00"):
    return json.dumps({"base": base, "date": date, "rates": rates, "fetched_at": fetched, "source": "test"})


def test_two_dates_three_currencies_give_six_rows(spark, tmp_dir):
    write_lines(
        tmp_dir,
        "rates_USD.jsonl",
        [record("2024-01-15", {"EUR": 0.92, "SEK": 10.45, "GBP": 0.79}), record("2024-01-16", {"EUR": 0.93, "SEK": 10.5, "GBP": 0.8})],
    )
    good, bad = landing.load_raw_rates(spark, tmp_dir)
    rows = good.collect()
    assert len(rows) == 6
    assert all(isinstance(r.rate, float) for r in rows)
    assert bad.count() == 0


def test_empty_rates_give_no_rows_and_malformed_line_is_quarantined(spark, tmp_dir):
    write_lines(tmp_dir, "rates_USD.jsonl", [record("2024-01-15", {}), record("2024-01-16", {"EUR": 0.9}), "not valid json", ""])
    good, bad = landing.load_raw_rates(spark, tmp_dir)
    assert good.count() == 1
    assert [r.reason for r in bad.collect()] == ["malformed_json"]


def test_missing_files_raise(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="rates_"):
        landing.read_landing(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        landing.read_landing(spark, os.path.join(tmp_dir, "nope"))


def test_empty_file_raises_no_rows(spark, tmp_dir):
    write_lines(tmp_dir, "rates_USD.jsonl", [""])
    with pytest.raises(ValueError, match="No rows parsed"):
        landing.load_raw_rates(spark, tmp_dir)


def test_quarantine_reasons_and_lenient_numbers(spark, tmp_dir):
    write_lines(
        tmp_dir,
        "rates_USD.jsonl",
        [
            json.dumps({"date": "2024-01-15", "rates": {"EUR": 0.9}}),
            json.dumps({"base": "USD", "rates": {"EUR": 0.9}}),
            '{"base": "USD", "date": "2024-01-17", "rates": {"EUR": null, "SEK": "0.93", "GBP": NaN}}',
        ],
    )
    good, bad = landing.load_raw_rates(spark, tmp_dir, run_ts="2024-02-01 00:00:00")
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad_rate", "missing_base", "missing_date"]
    got = {r.target_currency: r.rate for r in good.collect()}
    assert got["SEK"] == 0.93
    assert got["GBP"] != got["GBP"]  # NaN is kept in bronze, the silver filter drops it
    defaults = good.select("source", "ingested_at").first()
    assert defaults.source == "unknown"
    assert str(defaults.ingested_at) == "2024-02-01 00:00:00"


def incoming(spark, rows):
    return spark.createDataFrame(
        [Row(base="USD", date=d, rates={k: str(v) for k, v in r.items()}, fetched_at=f, source="t") for d, r, f in rows],
        landing.LANDING_SCHEMA,
    )


def stored(spark, path):
    df = landing.read_landing(spark, path, glob=None)
    return sorted((r.date, dict(r.rates)) for r in df.collect())


def test_upsert_creates_appends_and_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    landing.save_records(spark, incoming(spark, [("2024-01-15", {"EUR": 0.92}, "t1")]), path)
    landing.save_records(spark, incoming(spark, [("2024-01-13", {"EUR": 0.90}, "t1")]), path)
    landing.save_records(spark, incoming(spark, [("2024-01-14", {"EUR": 0.91}, "t1")]), path)
    assert [d for d, _ in stored(spark, path)] == ["2024-01-13", "2024-01-14", "2024-01-15"]
    landing.save_records(spark, incoming(spark, [("2024-01-14", {"EUR": 0.91}, "t1")]), path)
    assert len(stored(spark, path)) == 3
    files = [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".json")]
    assert files, "records are stored as JSON lines"


def test_upsert_keeps_existing_without_force_and_replaces_with_force(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    landing.save_records(spark, incoming(spark, [("2024-01-15", {"EUR": 0.92}, "t1")]), path)
    landing.save_records(spark, incoming(spark, [("2024-01-15", {"EUR": 0.99}, "t2")]), path)
    assert stored(spark, path) == [("2024-01-15", {"EUR": "0.92"})]
    landing.save_records(spark, incoming(spark, [("2024-01-15", {"EUR": 0.99}, "t2")]), path, force=True)
    assert stored(spark, path) == [("2024-01-15", {"EUR": "0.99"})]


def test_upsert_within_batch_latest_fetch_wins(spark):
    empty = spark.createDataFrame([], landing.LANDING_SCHEMA)
    batch = incoming(spark, [("2024-01-15", {"EUR": 0.92}, "2024-01-15T10:00:00"), ("2024-01-15", {"EUR": 0.93}, "2024-01-15T11:00:00")])
    out = landing.upsert_records(empty, batch).collect()
    assert len(out) == 1 and out[0].rates["EUR"] == "0.93"


def test_missing_targets_warn_only(spark):
    recs = incoming(spark, [("2024-01-15", {"EUR": 0.92}, "t")])
    got = missing_targets(recs, ["EUR", "XYZ"]).first().missing_targets
    assert got == ["XYZ"]


def test_normalise_responses(spark):
    resp = spark.createDataFrame(
        [Row(requested_base="USD", requested_date="2024-01-15", amount=1.0, base="USD", date=None, rates={"EUR": 0.9201})],
        "requested_base string, requested_date string, amount double, base string, date string, rates map<string,double>",
    )
    out = landing.normalise_responses(resp, "api", run_ts="2024-01-15 10:00:00").first()
    assert out.date == "2024-01-15" and out.rates == {"EUR": "0.9201"} and out.source == "api"
    assert "amount" not in landing.normalise_responses(resp, "api").columns


def test_fetch_label_and_dates_to_load(spark):
    df = spark.createDataFrame([("2024-01-14",), ("2024-01-15",), ("2024-01-16",)], "d string").select(
        F.to_date("d").alias("date")
    )
    labels = [r.l for r in df.select(planning.fetch_label("date", "2024-01-15").alias("l")).orderBy("date").collect()]
    assert labels == ["2024-01-14", "latest", "latest"]
    present = spark.createDataFrame([("USD", "2024-01-02"), ("USD", "2024-01-08")], "base string, d string").select(
        "base", F.to_date("d").alias("date")
    )
    req = planning.spine_per_key(present, "base", weekdays=True)
    todo = sorted(str(r.date) for r in planning.dates_to_load(req, present, ["base", "date"]).collect())
    assert todo == ["2024-01-03", "2024-01-04", "2024-01-05"]
    assert planning.dates_to_load(req, present, ["base", "date"], force=True).count() == 5
    summary = planning.spine_summary(planning.global_spine(present)).first()
    assert (summary.n_days, summary.n_weekdays, summary.n_skipped) == (7, 5, 2)


def test_staged_landing_is_scanned_once(spark, tmp_dir):
    import json
    import os

    from ratelake.sources import landing

    os.makedirs(f"{tmp_dir}/raw")
    lines = [json.dumps({"base": "USD", "date": f"2024-01-{d:02d}", "rates": {"EUR": 0.9, "GBP": "n/a"}, "fetched_at": "2024-02-01T00:00:00"}) for d in range(1, 6)]
    with open(f"{tmp_dir}/raw/rates_1.jsonl", "w") as f:
        f.write("\n".join([*lines, "broken", json.dumps({"date": "2024-01-01", "rates": {"EUR": 1}})]) + "\n")
    lazy = landing.load_raw_rates(spark, f"{tmp_dir}/raw", run_ts="2024-03-01 00:00:00")
    staged = landing.load_raw_rates(spark, f"{tmp_dir}/raw", run_ts="2024-03-01 00:00:00", staged_path=f"{tmp_dir}/staged")
    for a, b in zip(lazy, staged, strict=True):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "FileScan json" not in plan and "PartitionFilters: [isnotnull(outcome" in plan
    assert staged[0].count() == 5 and {r.reason for r in staged[1].collect()} == {"bad_rate", "malformed_json", "missing_base"}
    # the next run replaces the folder
    with open(f"{tmp_dir}/raw/rates_1.jsonl", "w") as f:
        f.write(lines[0].replace('"n/a"', "0.8") + "\n")
    good, quarantine = landing.load_raw_rates(spark, f"{tmp_dir}/raw", staged_path=f"{tmp_dir}/staged")
    assert good.count() == 2 and quarantine.count() == 0
