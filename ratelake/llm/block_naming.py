"""Exact dedup by deterministic block naming (Karp, Miller and Rosenberg, 1972).

Every normalised text is cut into blocks of ``block_chars`` code points. Equal
blocks get one integer name and different blocks different names; adjacent
names are then paired and named again, level by level, until each document
has a single name.

A name is the pair (h, r): the content's 64-bit hash, and the content's place
in the sorted order of all different contents with that hash. ``r`` is 1
unless two different contents share a hash, so names never collide, and the
sort needs no global order. Sorting decides the name only inside a hash
class, so one exchange of the (map-side deduplicated) blocks is enough.

Defined results: a NULL text counts as empty; an empty text is one empty
block; a NULL ``doc_id`` is an ordinary row that loses against any other id;
of repeated rows with the same id exactly one is kept; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import join_groups, materialise

#: Every run of the six ASCII white-space characters that is not already one plain space.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """White-space runs become one space; NULL becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def name_contents(spark: SparkSession, rows: DataFrame, contents: list[str], level: str) -> DataFrame:
    """Add (h, r) to ``rows`` so that it is equal exactly where ``contents`` are equal.

    Hash classes with more than one content are looked up first (normally
    none); only their contents are sorted, and only they are joined back.
    """
    hashed = rows.withColumn("h", F.xxhash64(*contents))
    distinct = hashed.select("h", *contents).groupBy("h", *contents).agg(F.count(F.lit(1)).alias("n"))
    shared = distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    shared = materialise(spark, shared, f"{level}-shared")
    sort = Window.partitionBy("h").orderBy(*contents)
    clashes = (
        hashed.select("h", *contents)
        .join(shared, "h", "left_semi")
        .dropDuplicates(["h", *contents])
        .withColumn("r", F.row_number().over(sort))
        .where("r > 1")
    )
    clashes = materialise(spark, clashes, f"{level}-clashes")
    return hashed.join(clashes, ["h", *contents], "left").withColumn("r", F.coalesce("r", F.lit(1)))


def name_documents(spark: SparkSession, docs: DataFrame, block_chars: int = 4096) -> DataFrame:
    """One row per input row: doc_id, text_sha256, the name (n_blocks, h, r), and ``uid`` (a row id)."""
    norm = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    cut = F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    blocks = norm.select(
        "doc_id",
        F.monotonically_increasing_id().alias("uid"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(cut).alias("blocks"),
    )
    blocks = blocks.select("doc_id", "uid", "text_sha256", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("pos", "block"))
    named = name_contents(spark, blocks, ["block"], "level0").select(
        "uid", "n_blocks", F.col("n_blocks").alias("left"), "pos", "h", "r",
        F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"),
        F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256"),
    )
    current = materialise(spark, named, "level0")
    done, level = None, 0
    while True:
        single = current.where("left = 1")
        done = single if done is None else done.unionByName(single)
        more = current.where("left > 1")
        if more.isEmpty():
            return done.select("uid", "doc_id", "text_sha256", "n_blocks", "h", "r")
        level += 1
        first, second = F.col("pos") % 2 == 0, F.col("pos") % 2 == 1
        pairs = more.groupBy("uid", "n_blocks", "left", F.floor(F.col("pos") / 2).cast("int").alias("pos2")).agg(
            F.max(F.when(first, F.col("h"))).alias("h1"),
            F.max(F.when(first, F.col("r"))).alias("r1"),
            F.coalesce(F.max(F.when(second, F.col("h"))), F.lit(0)).alias("h2"),
            F.coalesce(F.max(F.when(second, F.col("r"))), F.lit(0)).alias("r2"),
            F.max("doc_id").alias("doc_id"),
            F.max("text_sha256").alias("text_sha256"),
        )
        pairs = materialise(spark, pairs.withColumnRenamed("pos2", "pos"), f"pairs{level}")
        named = name_contents(spark, pairs, ["h1", "r1", "h2", "r2"], f"level{level}").select(
            "uid", "n_blocks", F.ceil(F.col("left") / 2).cast("int").alias("left"), "pos", "h", "r", "doc_id", "text_sha256"
        )
        current = materialise(spark, named, f"level{level}")


def exact_duplicates(spark: SparkSession, docs: DataFrame, block_chars: int = 4096) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    named = materialise(spark, name_documents(spark, docs, block_chars), "named")
    name = ["n_blocks", "h", "r"]
    # A struct orders by doc_id first; a NULL id sorts first in a struct, so it is put last explicitly.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("uid").alias("uid"))
    groups = named.groupBy(*name).agg(F.min(order).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    groups = materialise(spark, groups, "groups")
    return join_groups(named, groups, name, "group_size", named.count()).select(
        "doc_id",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("keep.uid")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(spark: SparkSession, docs: DataFrame, block_chars: int = 4096) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_duplicates(spark, docs, block_chars).where("kept")
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    own = docs.withColumn("__sha_own", F.sha2(normalised(F.col("text")).cast("binary"), 256))
    same = own["doc_id"].eqNullSafe(kept["__id"]) & (own["__sha_own"] == kept["__sha"])
    stay = own.join(kept, same, "left_semi")
    return stay.dropDuplicates(["doc_id", "__sha_own"]).select(*docs.columns)
