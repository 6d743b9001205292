"""Sharding by vector bin packing over (bytes, tokens, rows).

Groups of equal texts are the items. A group larger than 1/16 of a shard in
any dimension is cut into parts, so a hot group spreads over the shards.
Items fall into cells by the logarithms of their three sizes; the number of
cells has a fixed bound, whatever the input. The driver places cells, not
items, largest first: a chunk of a cell goes to the shard where the dot
product of its vector with the residual capacity is highest. Items take their
shard by their rank in the cell. The large items are placed first; the
small ones (the last fifth of the bytes) then settle against the measured
residuals of each shard.

The law that holds is ``bytes``: shard sizes are near equal (tokens and rows
are balanced jointly as far as the items allow).

Defined results: NULL text has size 8 and the crc32 of the empty text; NULL
ids are ordinary rows; repeated rows each get a slot; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import gapless_rank, materialise

DIMS = ["bytes", "tokens", "rows"]


def place_cells(cells: list[tuple], used: np.ndarray, capacity: np.ndarray, chunks: int = 8) -> dict[int, np.ndarray]:
    """Per cell the number of its items that go to each shard. cells: (cell, items, bytes, tokens, rows)."""
    shards = len(used)
    used, placed = used.astype(float).copy(), {}
    for cell, items, *total in sorted(cells, key=lambda c: (-c[2] / c[1], c[0])):
        mean = np.array(total, dtype=float) / items / capacity
        counts, rest = np.zeros(shards, dtype=np.int64), int(items)
        size = max(1, rest // (shards * chunks))
        while rest:
            take = min(size, rest)
            residual = 1 - used / capacity
            counts[best := int(np.argmax(residual @ mean))] += take
            used[best] += take * mean * capacity
            rest -= take
        placed[cell] = counts
    return placed


def shard_items(spark: SparkSession, items: DataFrame, placed: dict[int, np.ndarray]) -> DataFrame:
    """Add ``shard`` to items (item, cell, ...) by rank in the cell."""
    rows = []
    for cell, counts in placed.items():
        ends = np.cumsum(counts)
        rows += [(int(cell), int(e - c), int(e), s) for s, (c, e) in enumerate(zip(counts, ends, strict=True)) if c]
    ranges = spark.createDataFrame(rows, "cell long, first long, past long, shard int")  # at most cells x shards rows
    ranked = gapless_rank(items, ["cell"], ["item"], "rank", 16)
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))
    return ranked.join(ranges, "cell").where(inside).drop("rank", "first", "past")


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard, slot for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        (F.length(text) - F.length(F.translate(text, " \n\t", "")) + 1).cast("long").alias("tokens"),
        F.monotonically_increasing_id().alias("uid"),
    )
    slim = materialise(spark, slim, "sizes")
    group = ["h", "text_crc32", "size", "tokens"]
    groups = slim.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    total = slim.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    if not total[2]:
        return slim.select("doc_id", "size", "text_crc32", "tokens", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    capacity = np.array([float(x) for x in total]) / shards
    share = F.greatest(
        F.col("n") * F.col("size") / F.lit(capacity[0]), F.col("n") * F.col("tokens") / F.lit(capacity[1]), F.col("n") / F.lit(capacity[2])
    )
    hot = materialise(spark, groups.withColumn("parts", F.least(F.col("n"), F.ceil(share * 16))).where("parts > 1"), "hot")
    hot = hot.select(*group, "parts")  # groups of over 1/16 of a shard: at most 3 * 16 * shards
    rows = slim.join(F.broadcast(hot), group, "left")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("uid"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    rows = rows.withColumn("item", F.xxhash64(*group, "part"))
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    items = rows.groupBy("item").agg(*sums)
    steps = [F.floor(F.log2(F.col(d) + 1) * s).cast("long") for d, s in zip(DIMS, (8, 2, 2), strict=True)]
    items = materialise(spark, items.withColumn("cell", steps[0] * 40_000 + steps[1] * 200 + steps[2]), "items")
    cells = items.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[F.sum(d) for d in DIMS]).collect()
    cells = sorted((tuple(c) for c in cells), key=lambda c: (-c[2] / c[1], c[0]))
    seen, large = 0.0, []
    for c in cells:
        if seen >= 0.8 * float(total[0]):
            break
        large.append(c)
        seen += c[2]
    small = cells[len(large) :]
    used = np.zeros((shards, 3))
    first = shard_items(spark, items, place_cells(large, used, capacity))
    if small:
        first = materialise(spark, first, "large")
        for s, *sums_ in first.groupBy("shard").agg(*[F.sum(d) for d in DIMS]).collect():
            used[s] = [float(x) for x in sums_]
        first = first.unionByName(shard_items(spark, items, place_cells(small, used, capacity)))
    where = first.select("item", "shard")
    placed = materialise(spark, rows.join(where, "item").select("doc_id", "uid", "size", "text_crc32", "tokens", "shard"), "placed")
    salts = int(max(64, total[2] // 200_000))
    return gapless_rank(placed, ["shard"], ["doc_id", "uid"], "slot", salts).drop("uid")
