"""Document fingerprints: similarity digests of improbable features (after Roussev, 2010).

Every window of 16 bytes of the text's UTF-8 form gets a rank: how far the
Shannon entropy of its bytes lies from that of common prose (rarer is lower;
very repetitive windows come last). A window is a feature if it is the
lowest-ranked one in at least 4 of the 16 neighbourhoods of 16 windows that
hold it. Features are hashed into a chain of Bloom filters of 2048 bits, a
new one after 160 features. Two digests are compared filter by filter: the
bits in common, less what chance explains, over what they could have in
common; the mean is weighed by the filters' bits.

Defined results: equal texts have equal fingerprints; a text under 16 bytes
is one feature; the empty text (and NULL) has the fingerprint "", which is
alike only to itself; likeness is in 0..1 and 1 for equal fingerprints. NULL
ids come last in the descending order; rows with equal ids follow each other
by their texts; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import shuffle_partitions

WIDTH, REACH, POPULARITY, BITS, PER_FILTER = 16, 16, 4, 2048, 160
_C = np.arange(WIDTH + 1, dtype=float)
#: c log2 c, scaled to integers so that sliding sums stay exact.
_CLOGC = np.rint(np.where(_C > 0, _C * np.log2(np.maximum(_C, 1)), 0) * (1 << 20)).astype(np.int64)


def window_ranks(x: np.ndarray) -> np.ndarray:
    """Rank of every window of WIDTH bytes of ``x`` (lower: rarer), by the entropy of its bytes in thousandths."""
    n = len(x)
    seen, ahead = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)  # equal bytes among the WIDTH - 1 before / after
    for d in range(1, min(WIDTH, n)):
        same = (x[d:] == x[:-d]).view(np.uint8)
        seen[d:] += same
        ahead[:-d] += same
    # The first window byte by byte, then each step takes one byte out and one in.
    come = _CLOGC[seen.astype(np.int64) + 1] - _CLOGC[seen]
    gone = _CLOGC[ahead.astype(np.int64) + 1] - _CLOGC[ahead]
    total = np.cumsum(come)
    total[WIDTH:] -= np.cumsum(gone[: n - WIDTH])
    entropy = np.log2(WIDTH) - total[WIDTH - 1 :] / (WIDTH * float(1 << 20))
    level = np.rint(entropy * 1000 / np.log2(WIDTH)).astype(np.int64)
    # Prose has most windows near 0.8 of the largest entropy; rare levels come first, repetitive windows (padding) last.
    rank = 1000 - np.abs(level - 800)
    rank[level < 400] = 1001
    return rank


def features(buffer: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, start of window) of the features of texts that lie end to end in ``buffer``, in text order."""
    n = len(buffer)
    if n < WIDTH:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(first)), size)
    starts = np.arange(n - WIDTH + 1)
    inside = owner[: n - WIDTH + 1] == owner[WIDTH - 1 :]
    none = np.int64(1) << 62
    key = np.where(inside, window_ranks(buffer) << 40 | starts, none)
    low = np.concatenate((key, np.full(REACH - 1, none)))  # least (rank, start) of the neighbourhood from here on
    reach = 1
    while reach < REACH:  # doubling: 2, 4, ... windows
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    chosen = low[inside] & ((1 << 40) - 1)
    count = np.bincount(chosen, minlength=n)
    at = np.flatnonzero(count)
    most = np.zeros(len(first), dtype=np.int64)
    np.maximum.at(most, owner[at], count[at])
    need = np.minimum(POPULARITY, most)  # the best window of a short text counts anyway
    at = at[count[at] >= need[owner[at]]]
    return owner[at], at


def window_hashes(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows of ``x`` that start at ``at``."""
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(WIDTH):
        h = (h ^ x[at + j]) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def digests(texts: list[str]) -> list[bytes]:
    """The digest of every text (its filters end to end); texts are processed together in buffers of about a million bytes."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    out: list[bytes] = []
    lo = 0
    while lo < len(data):
        hi, room = lo, 0
        while hi < len(data) and (hi == lo or room + len(data[hi]) <= 1 << 20):
            room += len(data[hi])
            hi += 1
        size = np.array([len(d) for d in data[lo:hi]], dtype=np.int64)
        first = np.cumsum(size) - size
        x = np.frombuffer(b"".join(data[lo:hi]), dtype=np.uint8)
        owner, at = features(x, first, size)
        hashes = window_hashes(x, at)
        tiny = np.array([xxhash.xxh3_64_intdigest(d) for d in data[lo:hi] if 0 < len(d) < WIDTH], dtype=np.uint64)
        owner = np.concatenate((owner, np.flatnonzero((size > 0) & (size < WIDTH))))
        hashes = np.concatenate((hashes, tiny))
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
        count = np.bincount(owner, minlength=hi - lo)
        begin = np.cumsum(count) - count
        filters = -(-count // PER_FILTER)
        start = np.cumsum(filters) - filters
        bits = np.zeros(int(filters.sum()) * BITS, dtype=bool)
        base = (start[owner] + (np.arange(len(owner)) - begin[owner]) // PER_FILTER) * BITS
        for k in range(5):
            bits[base + (hashes >> np.uint64(11 * k) & np.uint64(BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits).tobytes()
        out += [packed[b * BITS // 8 : (b + n) * BITS // 8] for b, n in zip(start.tolist(), filters.tolist(), strict=True)]
        lo = hi
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Mean, over the filters of the shorter digest and by their bits, of the best normalised overlap with a filter of the other."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.unpackbits(np.frombuffer(d, dtype=np.uint8)).reshape(-1, BITS).astype(np.float32) for d in (a, b))
    if len(x) > len(y) or (len(x) == len(y) and x.sum() > y.sum()):
        x, y = y, x
    common, nx, ny = x @ y.T, x.sum(1)[:, None], y.sum(1)[None, :]
    chance, most = nx * ny / BITS, np.minimum(nx, ny)
    score = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1)
    return float((score.max(1) * nx[:, 0]).sum() / nx.sum())


def edited(text: str, following: str) -> str:
    """The last third of ``text`` (rounded down) replaced by the first as many code points of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def neighbours(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(bucket, guest, doc_id, text): buckets of consecutive ids; each also holds, as guest, the row that follows its last one.

    Rows follow each other by descending doc_id; after the last comes the
    first. Buckets are ranges of ids, so no task sees more than its share.
    """
    count = 4 * shuffle_partitions(spark)
    cuts = docs.agg(F.percentile_approx("doc_id", [k / count for k in range(1, count)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    # bucket 0 holds the largest ids; NULL ids come last, as in a descending sort
    bucket = F.lit(len(cuts) + 1) if not cuts else F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(
        F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c > F.col("doc_id")))
    )
    rows = docs.select(bucket.cast("int").alias("bucket"), F.lit(0).alias("guest"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    first = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()  # at most one row per bucket
    order = sorted(r["bucket"] for r in tops)
    before = {b: order[k - 1] for k, b in enumerate(order)}
    top = spark.createDataFrame([(r["bucket"], r["top"], before[r["bucket"]]) for r in tops], "bucket int, top long, host int")
    heads = rows.join(F.broadcast(top), "bucket").where(F.col("doc_id").eqNullSafe(F.col("top")))
    heads = heads.withColumn("n", F.row_number().over(first)).where("n = 1")
    guests = heads.select(F.col("host").alias("bucket"), F.lit(1).alias("guest"), "doc_id", "text")
    return rows.unionByName(guests)


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, near_edited, near_next for every row.

    Fingerprints are hex text. The rows are range-dealt once, so that a task
    reads each text next to the one that follows it.
    """
    rows = neighbours(spark, docs.select("doc_id", "text"))
    dealt = rows.repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "text")
    schema = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for whole in batches:
            for lo in range(0, whole.num_rows, 400):
                part = whole.slice(lo, 400)
                rows_ = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
                own = digests([r[3] for r in rows_])
                chain = ([held] if held else []) + [(*r, d) for r, d in zip(rows_, own, strict=True)]
                held = chain[-1]
                pairs = [(a, b) for a, b in zip(chain, chain[1:], strict=False) if not a[1] and a[0] == b[0]]
                texts = [edited(a[3], b[3]) for a, b in pairs]
                after = digests(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[2] for a, _ in pairs], pa.int64()),
                        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                        pa.array(texts, pa.string()),
                        pa.array([a[4].hex() for a, _ in pairs], pa.string()),
                        pa.array([d.hex() for d in after], pa.string()),
                        pa.array([likeness(a[4], d) for (a, _), d in zip(pairs, after, strict=True)], pa.float64()),
                        pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
                    ],
                    names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return dealt.mapInArrow(run, schema)
