"""Session helpers.

Library functions never create a session; they take the caller's. These
helpers are for tests, the bench and the command line only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours runs with.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "ratelake",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset in a local session (tests) is a private scratch folder set; elsewhere that is an error, as
    executors do not see each other's folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not fallback and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        msg = "spark.checkpoint.dir is not set: name a folder that the driver and all executors share"
        raise RuntimeError(msg)
    path = fallback or os.path.join(tempfile.mkdtemp(prefix="ratelake-ckpt-"), "ckpt")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
