"""N-gram Jaccard join by chosen paths (Christiani, Pagh and Sivertsen, 2018).

A text's set holds the hashes of its runs of ``n`` words (lower case, split at
white space; a text of fewer words is one run). Two sets are linked if their
Jaccard similarity is ``threshold`` or more.

Equal sets are first folded into one, which has a number of its own: ids play no part in the join. Each of several runs
sends a set to one bucket per token that the run's hash samples with
probability 1 / (threshold * size); similar sets meet in a bucket with
probability 1 - 1/e at least, and runs are repeated until the target recall.

**Classes.** Buckets of at most ``limit`` sets are compared by brute force on registers (a pair at the threshold is lost
with probability under 1e-6) and give their candidates between different classes, or a spanning forest of them, for the
exact check on whole sets, in rounds until none is open. A larger bucket is compared with a pivot first, which makes one
class of near copies; what then is still open is cut by the sets' sizes, which parts no linked pair, and where that is
not enough split again on two further sampled tokens of its sets at once (the registers), 17 times, so that a pair at the
threshold meets again but with probability 3e-8. So a group of near copies
gives edges in proportion to its sets.

**Links.** All links of a set are in its class, so they are counted there, each pair once at most. Of a class, every set is
kept as its difference D to the class's first set. With p percent, sets are linked if and only if
g(A) + g(B) <= 2 (100 + p) |D(A) & D(B)|, where g = (100 + p) |D| - (100 - p) size. Sorted by g, a class is cut into
blocks of bounded bytes; most pairs of blocks are decided by their least and greatest g alone, the others are compared as
whole blocks (one row per block, not per set). Counting the links of one class of m sets that are all near the threshold
remains m * m / 2 comparisons, spread over the cluster by block.

Defined results: texts without a word have the empty set, which is linked to
nothing but is one class with the other empty sets (they are copies); NULL
text counts as empty; rows with NULL ids take part with their text, and a class of such rows only has the class_id NULL;
rows that repeat an id with different texts each have the links of their own text; repeated rows are
copies of each other; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import join_groups, materialise, shuffle_partitions
from ratelake.llm.hyperminhash import band_rows, common_counts, components, fold_sets, per_text, registers, texts_of, whole_sets

_M = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(seed & 0xFFFFFFFFFFFFFFFF)) * _M
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, n: int, memo: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's runs of n words."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, len(words) if len(words) < n else 0, dtype=np.uint64)
    for j in range(k):
        out = mix(out * _M + h[j : j + len(out)], j + 1)
    return np.unique(out)


def sampled(tokens: np.ndarray, key: int, rate: float) -> np.ndarray:
    """Bucket keys of the tokens that the hash of ``key`` samples at ``rate``."""
    drawn = tokens[mix(tokens, key) < np.uint64(min(1.0, rate) * (2.0**64 - 2048))]
    return mix(drawn, key ^ 0x5BD1E995).view(np.int64)


def runs_for(recall: float) -> int:
    """Runs until a pair at the threshold meets with this probability (each run: 1 - 1/e)."""
    return math.ceil(-math.log(1 - recall))


def resample(rows: DataFrame, sets: DataFrame, threshold: float, limit: int) -> DataFrame:
    """Large buckets (key, node, ...) that are still open, as (key, node, band, level) of smaller ones.

    Linked sets differ in size by the factor 1 / threshold at most, so a bucket is first cut into classes of sizes, each
    held together with the next one; no pair is lost. Sets of what is still larger than ``limit`` are split on two sampled
    tokens at once: a set's 128 registers are its least hashed tokens, and sets that share the two registers of a band meet
    again. (Longer paths do not help there: sets with a long passage in common choose the same tokens of it, so every longer
    path keeps them together.) A set has 17 rows then, whatever the number and size of its buckets. Both splits are written,
    as they are counted first and then dealt.
    """
    spark, level = rows.sparkSession, F.lit(1).alias("level")
    width = math.log((1 + 1e-6) / threshold)  # a little more, so that rounding parts no pair
    sizes = rows.select("key", "node").join(sets.select("node", F.floor(F.log(F.col("size").cast("double")) / width).alias("class")), "node")
    sizes = materialise(spark, sizes, "sizes")
    near = Window.partitionBy("key").orderBy("class")  # over the few classes of a bucket, not over its sets
    counts = sizes.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("key", "class", F.sum("n").over(near.rangeBetween(0, 1)).alias("up"), F.sum("n").over(near.rangeBetween(-1, 0)).alias("down"))
    counted = materialise(spark, sizes.join(counts, ["key", "class"]), "classes")
    fits = F.array(*(F.when((F.col(n) > 1) & (F.col(n) <= limit), F.xxhash64("key", at)) for n, at in (("up", F.col("class")), ("down", F.col("class") - 1))))
    fitting = counted.select(F.explode(F.array_compact(fits)).alias("key"), "node", F.lit(0).alias("band"), level)
    nodes = counted.where(F.greatest("up", "down") > limit).select("node").distinct()
    split = band_rows(sets.join(nodes, "node"), 2, 17)
    return fitting.unionByName(materialise(spark, split.select("key", "node", "band", level), "split"))


def link_counts(spark: SparkSession, comps: DataFrame, whole: DataFrame, percent: int, weight: int = 100_000) -> DataFrame:
    """(node, n_links) of every set of ``comps`` (node, comp); ``whole`` has their (node, tokens). A block holds about
    ``weight`` tokens of differences (a set counts as 50 more)."""
    parts = shuffle_partitions(spark)
    up, down = 100 + percent, 100 - percent
    own = materialise(spark, comps.join(whole.hint("merge"), "node"), "classes")
    firsts = materialise(spark, own.where("node = comp").select("comp", F.col("tokens").alias("first")), "firsts")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            diff, g = [], []
            for tokens, first in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a = np.frombuffer(tokens, dtype=np.uint64)
                d = np.setxor1d(a, np.frombuffer(first, dtype=np.uint64), assume_unique=True)
                diff.append(d.tobytes())
                g.append(up * len(d) - down * len(a))
            d_size = [len(d) // 8 for d in diff]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(diff, pa.binary()), pa.array(g, pa.int64()), pa.array(d_size, pa.int64())], names=["comp", "node", "diff", "g", "d"])

    diffs = own.join(firsts.hint("merge"), "comp").select("comp", "node", "tokens", "first").mapInArrow(differ, "comp long, node long, diff binary, g long, d long")
    diffs = materialise(spark, diffs, "differences")
    # blocks in the order of g: the weights of a class before each value of g, from a small aggregate
    values = diffs.groupBy("comp", "g").agg(F.sum(F.col("d") + 50).alias("own"))
    before = Window.partitionBy("comp").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    values = materialise(spark, values.withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0))), "values")
    block = F.floor((F.col("before") + F.pmod(F.xxhash64("node"), F.col("own"))) / weight).alias("block")
    placed = diffs.join(values, ["comp", "g"]).select("comp", block, "g", "d", F.struct("node", "g", "diff").alias("member"))
    packed = placed.groupBy("comp", "block").agg(
        F.collect_list("member").alias("members"), F.min("g").alias("g_min"), F.max("g").alias("g_max"), F.max("d").alias("d_max"), F.count(F.lit(1)).alias("n")
    )
    packed = materialise(spark, packed, "blocks")
    heads = packed.select("comp", "block", "g_min", "g_max", "d_max", "n")
    other = heads.select("comp", *(F.col(c).alias(f"o_{c}") for c in ("block", "g_min", "g_max", "d_max", "n")))
    pairs = heads.join(other, "comp")
    same = F.col("block") == F.col("o_block")
    all_linked = F.col("g_max") + F.col("o_g_max") <= 0
    none_linked = F.col("g_min") + F.col("o_g_min") > 2 * up * F.least("d_max", "o_d_max")
    sure = F.sum(F.when(all_linked & ~same, F.col("o_n")).otherwise(0))
    known = pairs.groupBy("comp", "block").agg(sure.alias("sure"))
    todo = pairs.where(same | ~(all_linked | none_linked)).select("comp", F.col("block").alias("own"), F.col("o_block").alias("block"))
    known = todo.join(known.withColumnRenamed("block", "own"), ["comp", "own"])
    rows = materialise(spark, known, "pairs").join(packed.select("comp", "block", "members"), ["comp", "block"])
    rows = rows.select("comp", "own", "block", "sure", "members").repartition(parts, "comp", "own")
    rows = rows.sortWithinPartitions("comp", "own", F.col("own") != F.col("block"))  # a block's own row comes first

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sets, g, links = None, [], [], np.zeros(0), np.zeros(0)
        for batch in batches:
            for k in range(batch.num_rows):
                comp, own, block, sure, members = (c[k].as_py() for c in batch.columns)
                theirs = [np.frombuffer(m["diff"], dtype=np.uint64) for m in members]
                their_g = np.array([m["g"] for m in members], dtype=np.int64)
                if own == block:
                    if at is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links)], names=["node", "n_links"])
                    at, nodes, sets, g = (comp, own), [m["node"] for m in members], theirs, their_g
                    links = np.full(len(nodes), sure, dtype=np.int64) - 1  # a set is found linked to itself
                assert at == (comp, own)
                links += (g[:, None] + their_g[None, :] <= 2 * up * common_counts(sets, theirs)).sum(axis=1)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links)], names=["node", "n_links"])

    return rows.mapInArrow(count, "node long, n_links long")


def _classes(spark: SparkSession, docs: DataFrame, n: int, threshold: float, recall: float, limit: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Signatures per row, sets, (node, comp) of linked sets and (node, tokens) of at least these."""
    runs = runs_for(recall)
    texts = texts_of(docs)

    def own_text(make, schema: str):
        def tokens(value: bytes, memo: dict) -> np.ndarray:
            return shingle_set(value.decode(), n, memo)

        return per_text(make, schema, tokens)

    def sign(row: tuple, tokens: np.ndarray) -> tuple:
        regs = registers(tokens).tobytes() if len(tokens) else b""
        return row[1], row[2], xxhash.xxh3_128_digest(tokens.tobytes()), len(tokens), regs, paths(tokens)

    def paths(tokens: np.ndarray) -> list[dict]:
        rate = 1 / (threshold * max(len(tokens), 1))
        return [{"band": r, "key": k} for r in range(runs) for k in sampled(tokens, 1000 + r, rate).tolist()]

    schema = "id long, digest binary, print binary, size long, regs binary, paths array<struct<band int, key long>>"
    signed = materialise(spark, texts.mapInArrow(own_text(sign, schema), schema), "signatures")
    sets = fold_sets(spark, signed)
    buckets = sets.where("size > 0").select("node", F.explode("paths").alias("path")).select("path.key", "node", "path.band").distinct()
    fetch = lambda wanted: whole_sets(texts, wanted, own_text)
    further = lambda rows, sets, whole: resample(rows, sets, threshold, limit)
    comps, whole = components(spark, sets, buckets, further, fetch, threshold, limit, 1, first=2)
    return signed, sets, comps, whole


def jaccard_join(spark: SparkSession, docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, limit: int = 1000, weight: int = 100_000) -> DataFrame:
    """One row per input row: doc_id, rep_id (its copies' least id), class_id, n_links (of its set, to different sets), n_copies."""
    signed, sets, comps, whole = _classes(spark, docs, n, threshold, recall, limit)
    links = link_counts(spark, comps, whole, round(100 * threshold), weight)
    own = sets.select("print", "node", F.col("id").alias("rep"), "copies").join(comps, "node", "left").join(links, "node", "left")
    n_sets = sets.count()
    own = materialise(spark, own.withColumn("comp", F.coalesce("comp", "node")), "own", n_sets)
    least = materialise(spark, own.groupBy("comp").agg(F.min("rep").alias("class_id")), "least", n_sets)
    classes = own.join(least, "comp").select("print", "rep", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), "class_id")
    classes = materialise(spark, classes, "found", n_sets)
    rows = join_groups(signed.select(F.col("id").alias("doc_id"), "print"), classes, ["print"], "copies", signed.count())
    return rows.select("doc_id", F.col("rep").alias("rep_id"), "class_id", "n_links", F.col("copies").alias("n_copies"))


def keep_one_per_class(spark: SparkSession, docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, limit: int = 1000) -> DataFrame:
    """One row of ``docs`` per class, with all columns: the one with the least id (NULL ids last; of one id the least
    text digest). Repeated rows are one."""
    signed, sets, comps, _ = _classes(spark, docs, n, threshold, recall, limit)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("first")
    of_set = signed.groupBy("print").agg(first).join(sets.select("print", "node"), "print").join(comps, "node", "left")
    kept = of_set.groupBy(F.coalesce("comp", "node")).agg(F.min("first").alias("first"))
    kept = materialise(spark, kept.select(F.col("first.id").alias("__kept_id"), F.col("first.digest").alias("__kept_digest")), "kept")
    marked = docs.withColumn("__text_digest", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    stay = (F.col("__text_digest") == F.col("__kept_digest")) & F.col("doc_id").eqNullSafe(F.col("__kept_id"))
    return marked.join(kept, stay, "left_semi").dropDuplicates(["doc_id", "__text_digest"]).drop("__text_digest")
