"""Generic frame helpers: schema enforcement, run timestamps, deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Raise ``ValueError`` naming every column of ``names`` missing from ``df``."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        msg = f"columns not found: {', '.join(missing)} (there are: {', '.join(df.columns)})"
        raise ValueError(msg)


def enforce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in schema order, cast to its types, drop the rest."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def run_timestamp(run_ts: datetime | str | None = None) -> Column:
    """A fixed timestamp literal when given, else ``current_timestamp()``."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp")


def deduplicate(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_by`` tuple.

    ``order_by`` should be a total order inside a key (add a tie-breaker column).
    Written as a ``max_by`` aggregate rather than ``row_number``: the partial
    aggregate runs before the shuffle, so a key holding millions of copies
    sends one row per map task across the network, never all of them.
    """
    keys = _as_list(keys)
    order_by = _as_list(order_by)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    best = F.max_by(F.struct(*payload), F.struct(*order_by))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)


def first_per_sub_key(df: DataFrame, key: Sequence[str], sub_key: str, priority: Sequence[Column]) -> DataFrame:
    """Keep the first row of every (key, sub_key) by ``priority`` using a window on ``key`` only.

    The window is partitioned by the series key alone and ordered by
    (sub_key, *priority), so it shares the series exchange and sort with the
    LAG and rolling windows that follow; no (key, sub_key) shuffle is added.
    """
    w = Window.partitionBy(*key).orderBy(F.col(sub_key).asc(), *priority)
    first = (F.row_number().over(w) == 1) | ~F.lag(sub_key).over(w).eqNullSafe(F.col(sub_key))
    return df.withColumn("_keep", first).filter(F.col("_keep")).drop("_keep")
