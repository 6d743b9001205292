"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(spark: SparkSession, df: DataFrame, name: str, rows: int | None = None, per_task: int = 50_000, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage like ``checkpoint()``, but computes the rows once and
    gives the planner the written size. ``rows`` says about how many there will be: then the last stage has one task (and
    file) per ``per_task`` of them, 16 at least, and never more than the shuffle before it made.
    ``codec`` is the files' compression, if not the session's.
    """
    if rows is not None:
        df = df.coalesce(max(16, -(-rows // per_task)))
    path = os.path.join(ensure_checkpoint_dir(spark), f"llm-{uuid.uuid4().hex}", name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for the jobs started inside; the session's own one is set again after them."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def short_batches(spark: SparkSession):
    """For jobs started inside whose rows hold whole sets: a task has few of them as Arrow and Python objects at once."""
    return session_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "500")


_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """In a task: what ``make`` gives, kept by the Python worker for the next tasks that ask for ``key``; of others it goes."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def drop_kept() -> None:
    """In a task that keeps nothing: what the worker kept for other operators goes."""
    _KEPT.clear()


def shuffles_dropped(spark: SparkSession):
    """The shuffle files of a write inside go when it ends, not only when the driver collects its garbage."""
    return session_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def bounded(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A written table of short rows, marked for broadcast if it has at most ``rows`` of them (counted from the files' footers);
    else as it is, and a join with it shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, the key of every train / held-out split."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], out: str, salts: int) -> DataFrame:
    """Add ``out``: a gapless 0-based long rank within ``keys``, without one task per key.

    Rows of a key are dealt over ``salts`` hash buckets of the ``order``
    columns. The bucket sizes (a small aggregate) give each bucket its first
    rank, and ``row_number`` counts on from it inside the bucket. ``df`` is
    read twice, so it must be a written table or otherwise deterministic.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = salted.groupBy(*keys, "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*keys, "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    own = Window.partitionBy(*keys, "__salt").orderBy(*order)
    ranked = salted.withColumn("__row", F.row_number().over(own))
    return (
        ranked.join(firsts, [*keys, "__salt"])
        .withColumn(out, (F.col("__first") + F.col("__row") - 1).cast("long"))
        .drop("__salt", "__first", "__row")
    )


def key_per_partition(spark: SparkSession, partitions: int) -> list[int]:
    """For every partition number an int key that ``repartition(partitions, key)`` sends there: one key, one task."""
    ids = spark.range(40 * partitions + 200).select(F.col("id").cast("int").alias("key"))
    rows = ids.groupBy(F.pmod(F.hash("key"), F.lit(partitions)).alias("at")).agg(F.min("key").alias("key")).collect()
    found = {r["at"]: r["key"] for r in rows}
    return [found.get(k, 0) for k in range(partitions)]


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group. Groups of over a thousandth of ``total`` rows (under 1,000 of them) are
    broadcast, so that no task gets the rows of a hot group; the others are joined by shuffle. Both inputs are read twice."""
    hot = groups.where(F.col(size) * 1000 > total)
    cold = groups.where(F.col(size) * 1000 <= total)
    in_hot = rows.join(F.broadcast(hot), keys)
    in_cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return in_hot.unionByName(in_cold)
