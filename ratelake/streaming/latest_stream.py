"""The latest rate of every pair, kept up to date by a stateful stream over the landing zone.

The state is one row per (base, target): the greatest (date, ingested_at, source, rate) seen so far, so it grows with the
pairs and never with the rows, and needs no watermark: a late or repeated record changes nothing, a correction of the
latest day wins. RocksDB keeps the state, so it need not fit an executor's heap. The query runs in update mode: a
micro-batch gives only the pairs that changed, which are merged into a table cut into ``buckets`` by the pair's hash;
only touched buckets are read and replaced. Both steps keep the greatest row, so a batch that is replayed after
a failure gives the same table.

The result is the latest row per pair of the batch bronze over the same files (``rate`` as landed; ``valid`` says whether
it passes the validity bounds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from ratelake.operators.frames import deduplicate
from ratelake.operators.quality import valid_rate
from ratelake.operators.series import currency_pair
from ratelake.schemas import MAX_VALID_RATE, MIN_VALID_RATE
from ratelake.sources import landing
from ratelake.streaming.landing_stream import landing_stream

KEY = ["base_currency", "target_currency"]
ORDER = ["date", "ingested_at", "source", "rate"]  #: a total order: bronze's order within the greatest date
COLUMNS = ["currency_pair", *KEY, "date", "rate", "source", "ingested_at", "valid"]
TABLE_SCHEMA = (
    "currency_pair string, base_currency string, target_currency string, date date, rate double, source string, ingested_at timestamp, valid boolean, bucket int"
)
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_rows(rates: DataFrame) -> DataFrame:
    """The greatest row of every (base, target); ``rates`` may be a stream or a table."""
    return deduplicate(rates.withColumnRenamed("ingestion_date", "date").select(*KEY, *ORDER), KEY, ORDER)


def read_latest(spark: SparkSession, table_path: str) -> DataFrame:
    """The table that the stream keeps; empty before its first batch."""
    try:
        return spark.read.schema(TABLE_SCHEMA).parquet(table_path).select(*COLUMNS)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], TABLE_SCHEMA).select(*COLUMNS)


def merge_latest(spark: SparkSession, changed: DataFrame, table_path: str, buckets: int = 64) -> None:
    """Replace the rows of changed pairs (columns of the table) by the greater ones; other buckets are not read or written."""
    changed = changed.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")).checkpoint()
    touched = [r.bucket for r in changed.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    try:
        present = spark.read.schema(TABLE_SCHEMA).parquet(table_path).where(F.col("bucket").isin(touched))
    except AnalysisException as exc:  # the first batch
        if "PATH_NOT_FOUND" not in str(exc):
            raise
    else:
        # written out before the buckets that it was read from are replaced
        changed = deduplicate(present.unionByName(changed), [*KEY, "bucket"], ORDER).checkpoint()
    rows = changed.select(*COLUMNS, "bucket").repartition("bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table_path)


def start_landing_to_latest(
    spark: SparkSession,
    source_dir: str,
    table_path: str,
    checkpoint_location: str,
    glob: str | None = landing.DEFAULT_GLOB,
    max_files: int | None = None,
    run_ts=None,
    min_rate: float = MIN_VALID_RATE,
    max_rate: float = MAX_VALID_RATE,
    buckets: int = 64,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream; without ``processing_time`` it drains what has landed and stops. ``checkpoint_location`` is a shared
    folder of this stream alone; ``buckets`` must stay the same for a table."""
    good, _ = landing.split_landing(landing_stream(spark, source_dir, glob, max_files), run_ts)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("currency_pair", currency_pair()).withColumn("valid", F.coalesce(valid_rate("rate", min_rate, max_rate), F.lit(False)))
        merge_latest(spark, named.select(*COLUMNS), table_path, buckets)

    writer = latest_rows(good).writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query takes its own copy of the session's settings when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(STATE_STORE, before)
