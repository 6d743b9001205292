"""Landing zone: JSON-lines records, one per (base, date).

* scan: Spark's JSON reader with an explicit schema, distributed over files;
* quarantine: malformed lines and records / rates that cannot be typed are
  split off with a reason instead of failing the stage;
* keyed upsert: records keyed by (base, date); insert-only keeps what has
  landed, ``force`` lets the new record win. Written back with dynamic
  partition overwrite on ``base``, so bases not in the batch are untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ratelake.operators.frames import deduplicate, run_timestamp
from ratelake.schemas import LANDING_SCHEMA

CORRUPT = "_corrupt_record"
RECORD_KEY = ["base", "date"]
#: Fetched files and the files `write_records` writes: one convention for readers and writers.
DEFAULT_GLOB = "{rates_*.jsonl,part-*.json}"
GLOB_TEXT = "rates_*.jsonl or part-*.json"

#: What a usable rate gives to bronze.
GOOD_COLUMNS = ["ingestion_date", "base_currency", "target_currency", "rate", "source", "ingested_at"]

LANDING_READ_SCHEMA = StructType([*LANDING_SCHEMA.fields, StructField(CORRUPT, StringType())])


def read_landing(spark: SparkSession, path: str, glob: str | None = DEFAULT_GLOB) -> DataFrame:
    """Scan landing files under ``path`` (PERMISSIVE: bad lines land in ``_corrupt_record``).

    Raises ``FileNotFoundError`` when no file matches; blank lines are skipped by the reader.
    """
    reader = (
        spark.read.schema(LANDING_READ_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("allowNonNumericNumbers", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.json(path)
    except Exception as exc:  # noqa: BLE001 - missing path is reported as missing files
        if "PATH_NOT_FOUND" in str(exc):
            msg = f"No {GLOB_TEXT if glob == DEFAULT_GLOB else glob or 'landing'} files found in: {path}"
            raise FileNotFoundError(msg) from exc
        raise
    if not df.inputFiles():
        msg = f"No {GLOB_TEXT if glob == DEFAULT_GLOB else glob or 'landing'} files found in: {path}"
        raise FileNotFoundError(msg)
    return df


def record_problem() -> F.Column:
    """Why a whole record cannot be used, or NULL."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json"))
        .when(F.col("base").isNull() | (F.trim("base") == ""), F.lit("missing_base"))
        .when(F.col("date").isNull() | (F.trim("date") == ""), F.lit("missing_date"))
        .when(F.try_to_date(F.trim("date")).isNull(), F.lit("bad_date"))
        .when((F.trim("fetched_at") != "") & F.try_to_timestamp(F.col("fetched_at")).isNull(), F.lit("bad_timestamp"))
    )


def _rate_columns(target: Column, raw: Column, run_ts=None) -> list[Column]:
    return [
        F.try_to_date(F.trim("date")).alias("ingestion_date"),
        F.trim("base").alias("base_currency"),
        target.alias("target_currency"),
        raw.try_cast("double").alias("rate"),
        raw.alias("rate_raw"),
        F.coalesce(F.col("source"), F.lit("unknown")).alias("source"),
        F.coalesce(F.try_to_timestamp(F.col("fetched_at")), run_timestamp(run_ts)).alias("ingested_at"),
    ]


def explode_rates(records: DataFrame, run_ts=None) -> DataFrame:
    """One row per (record, currency) with typed date, timestamp and rate.

    Empty or missing ``rates`` give no rows. Defaults: an absent ``fetched_at`` = run
    time, ``source`` = ``unknown``. The rate is ``try_cast`` to double, so "0.93"
    and NaN survive; a NULL or non-numeric rate becomes NULL and is
    quarantined by :func:`split_landing`.
    """
    exploded = records.select("base", "date", "fetched_at", "source", F.explode("rates").alias("_target", "_raw"))
    return exploded.select(*_rate_columns(F.col("_target"), F.col("_raw"), run_ts))


def tag_landing(records: DataFrame, run_ts=None) -> DataFrame:
    """Every item of the landing records in one pass: bronze-input columns, ``reason`` and ``payload`` of what cannot be used, and
    ``outcome`` (``good`` or ``quarantine``).

    A record that cannot be used (malformed line, missing base, missing / bad date, unparsable ``fetched_at``) is one item
    with its whole text, else each of its rates is one; rates that are not numbers are quarantined singly.
    """
    problem = record_problem()
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
    items = F.when(problem.isNull(), F.map_entries("rates")).otherwise(nothing)
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*LANDING_SCHEMA.fieldNames())))
    exploded = records.select(*LANDING_SCHEMA.fieldNames(), problem.alias("_problem"), F.when(problem.isNotNull(), record).alias("_record"), F.explode(items).alias("_item"))
    rows = exploded.select(*_rate_columns(F.col("_item.key"), F.col("_item.value"), run_ts), "_problem", "_record")
    reason = F.coalesce("_problem", F.when(F.col("rate").isNull(), F.lit("bad_rate")))
    rate = F.to_json(F.struct("base_currency", F.col("ingestion_date").cast("string").alias("date"), "target_currency", "rate_raw"))
    rows = rows.withColumn("reason", reason)
    payload = F.when(F.col("reason").isNotNull(), F.coalesce("_record", rate))
    outcome = F.when(F.col("reason").isNull(), F.lit("good")).otherwise(F.lit("quarantine"))
    return rows.select(*GOOD_COLUMNS, "reason", payload.alias("payload"), outcome.alias("outcome"))


def _by_outcome(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = tagged.where("outcome = 'good'").select(*GOOD_COLUMNS)
    return good, tagged.where("outcome = 'quarantine'").select("reason", "payload")


def split_landing(records: DataFrame, run_ts=None) -> tuple[DataFrame, DataFrame]:
    """(good rows in bronze-input shape, quarantined items with a reason and their text), see :func:`tag_landing`."""
    return _by_outcome(tag_landing(records, run_ts))


def stage_landing(spark: SparkSession, tagged: DataFrame, staged_path: str) -> tuple[DataFrame, DataFrame]:
    """Write the tagged items once, partitioned by outcome, and return (good, quarantine) as reads of one partition each.

    So the text files are scanned and parsed once, whatever reads the outputs afterwards; the folder is replaced by the next run.
    """
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("outcome").parquet(staged_path)
    return _by_outcome(spark.read.schema(tagged.schema).parquet(staged_path))


def load_raw_rates(
    spark: SparkSession, path: str, glob: str | None = DEFAULT_GLOB, run_ts=None, staged_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Scan + split. Raises ``ValueError`` when the files hold no usable row.

    With ``staged_path`` the files are scanned once (:func:`stage_landing`); without it every output scans them itself.
    """
    tagged = tag_landing(read_landing(spark, path, glob), run_ts)
    good, quarantine = stage_landing(spark, tagged, staged_path) if staged_path else _by_outcome(tagged)
    if good.isEmpty():
        msg = f"No rows parsed from landing files in {path}"
        raise ValueError(msg)
    return good, quarantine


# --------------------------------------------------------------------------
# Records: build, normalise, upsert, write.
# --------------------------------------------------------------------------


def records_from_rows(rows: DataFrame) -> DataFrame:
    """Bronze-shaped rows (unique per date/base/target) back to landing records.

    One map per (base, date): its size is bounded by the number of target
    currencies because the input is unique per target.
    """
    return rows.groupBy(
        F.col("base_currency").alias("base"), F.date_format("ingestion_date", "yyyy-MM-dd").alias("date")
    ).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.col("target_currency"), F.col("rate").cast("string")))
        ).alias("rates"),
        F.date_format(F.max("ingested_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"),
        F.max("source").alias("source"),
    )


def normalise_responses(responses: DataFrame, source: str, run_ts=None) -> DataFrame:
    """API responses (requested_base, requested_date, amount, base, date, rates) to landing records.

    Base comes from the request, the date from the response (else the
    requested date); ``amount`` is dropped.
    """
    return responses.select(
        F.col("requested_base").alias("base"),
        F.coalesce(F.col("date"), F.col("requested_date").cast("string")).alias("date"),
        F.transform_values("rates", lambda _k, v: v.cast("string")).alias("rates"),
        F.date_format(run_timestamp(run_ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"),
        F.lit(source).alias("source"),
    )


def upsert_records(existing: DataFrame, incoming: DataFrame, force: bool = False, keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    """Keyed upsert of landing records.

    One record per key: insert-only (default) prefers the present record,
    ``force`` the incoming one; within a side the latest ``fetched_at`` wins,
    then source and rates, so the order is total. Each side is read once and
    one aggregate decides.
    """
    cols = LANDING_SCHEMA.fieldNames()
    old = existing.select(*cols, F.lit(0 if force else 1).alias("_side"))
    new = incoming.select(*cols, F.lit(1 if force else 0).alias("_side"))
    both = old.unionByName(new).withColumn("_rates", F.to_json("rates"))
    return deduplicate(both, list(keys), ["_side", "fetched_at", "source", "_rates"]).select(*cols)


def write_records(records: DataFrame, path: str) -> None:
    """Write records as JSON lines under ``path/base=<BASE>/``, sorted by date.

    Dynamic partition overwrite replaces only the bases present. Range
    partitioning on (base, date) splits a large base over many tasks and
    keeps every file in date order.
    """
    (
        records.repartitionByRange("base", "date")
        .sortWithinPartitions("base", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("base")
        .json(path)
    )


def save_records(spark: SparkSession, incoming: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Upsert a batch of records into the landing directory ``path``.

    Only the partitions of the batch's bases are read back (a literal filter;
    their number is bounded by the bases of one batch). Unreadable present
    lines are left out. The merged result is checkpointed to the
    cluster's checkpoint folder before the write, so a retried task never
    re-reads the files being replaced.
    """
    try:
        bases = [r["base"] for r in incoming.select("base").distinct().collect()]
        present = read_landing(spark, path, glob=None).where(F.col("base").isin(bases))
        present = present.where(F.coalesce(record_problem(), F.lit("bad_timestamp")) == "bad_timestamp").drop(CORRUPT)
    except FileNotFoundError:
        present = spark.createDataFrame([], LANDING_SCHEMA)
    merged = upsert_records(present, incoming, force).checkpoint()
    write_records(merged, path)
    return read_landing(spark, path, glob=None).drop(CORRUPT)
