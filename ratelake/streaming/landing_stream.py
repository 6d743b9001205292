"""Incremental landing -> bronze with Structured Streaming.

New landing files are picked up by a file-source stream; every micro-batch
is merged into a bronze table partitioned by year of the rate date:

1. quarantine: unusable records / rates are appended to the quarantine folder;
2. the batch is reduced to the latest row per bronze key (a ``max_by``
   aggregate, combined map-side);
3. only the years the batch touches are read back from bronze (a literal
   filter on the partition column, so the others are pruned), unioned with the
   batch, deduplicated again and written with dynamic partition overwrite.

No watermark is used: a backfill of an old date is normal here and must not
be dropped as late data. The stream keeps no state of its own; its
checkpoint only records which files were consumed, so a restarted query
continues where it stopped, and replaying a batch gives the same table
(the merge is idempotent).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from ratelake.operators.frames import deduplicate
from ratelake.plans.layers import BRONZE_KEY
from ratelake.schemas import BRONZE_SCHEMA
from ratelake.sources import landing

YEAR = "year"
ORDER = ["ingested_at", "source", "rate"]  #: a total order of the rows of one key


def landing_stream(spark: SparkSession, source_dir: str, glob: str | None = landing.DEFAULT_GLOB, max_files: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(landing.LANDING_READ_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", landing.CORRUPT)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(source_dir)


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Bronze rows from the year-partitioned table (the partition column is dropped)."""
    return spark.read.parquet(bronze_path).select(*BRONZE_SCHEMA.fieldNames())


def touched_years(present: DataFrame, batch: DataFrame) -> DataFrame:
    """The present rows of the batch's years; their list is bounded by the calendar, so it can be a literal filter."""
    years = [r[YEAR] for r in batch.select(YEAR).distinct().collect()]
    return present.where(F.col(YEAR).isin(years)).select(*BRONZE_SCHEMA.fieldNames(), YEAR)


def merge_into_bronze(spark: SparkSession, rows: DataFrame, bronze_path: str) -> None:
    """Upsert bronze-shaped rows: the latest ``ingested_at`` per key wins, years not touched stay as they are."""
    cols = BRONZE_SCHEMA.fieldNames()
    batch = deduplicate(rows.select(*cols), BRONZE_KEY, ORDER).withColumn(
        YEAR, F.year("ingestion_date")
    ).checkpoint()
    try:
        present = spark.read.parquet(bronze_path)
    except AnalysisException as exc:  # first batch: nothing to merge with
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
    else:
        batch = deduplicate(touched_years(present, batch).unionByName(batch), BRONZE_KEY, ORDER)
        # Cut lineage before replacing the partitions this plan reads from.
        batch = batch.checkpoint()
    (
        batch.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR)
        .parquet(bronze_path)
    )


def start_landing_to_bronze(
    spark: SparkSession,
    source_dir: str,
    bronze_path: str,
    quarantine_path: str,
    checkpoint_location: str,
    glob: str | None = landing.DEFAULT_GLOB,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the incremental bronze stream. ``available_now`` drains what has landed and stops.

    ``checkpoint_location`` is a shared folder of this stream alone.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.checkpoint()  # one read of the new files for both outputs
        good, quarantine = landing.split_landing(batch)
        # One folder per batch, overwritten: a replayed batch does not duplicate its quarantine.
        quarantine.write.mode("overwrite").json(os.path.join(quarantine_path, f"batch_id={batch_id}"))
        merge_into_bronze(spark, good, bronze_path)

    writer = landing_stream(spark, source_dir, glob).writeStream.foreachBatch(per_batch)
    writer = writer.option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
