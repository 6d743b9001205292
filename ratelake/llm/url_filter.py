"""URL filter: rules first, then the ratio of two character language models.

Urls that a rule allows train one model, urls that a rule blocks the other:
variable-order Markov models of characters up to ``order`` characters of
context, each order smoothed into the next shorter one by Witten and Bell's
method. A url no rule fits is judged by its log-likelihood difference per
character against a threshold calibrated on a fifth of the ruled urls, which
the models never see (the histogram cell that separates the two kinds best).
DataFrame functions only.

All counts of all orders come from one table of distinct (order + 1)-grams,
which partial aggregation makes small before it is shuffled. Frequent grams
are spread over ``salts`` copies of the model when urls look them up.

Defined results: NULL urls and urls without "://" have empty host and path
and are judged like any other unruled url; with no training url of a kind, that
kind's model is uniform over the characters seen; a score equal to the
threshold allows; NULL ids and repeated rows are ordinary rows; extra columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
KINDS = ("allow", "block")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for NULL or without "://"."""
    given = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(given, PARTS, 1), UPPER, LOWER), F.regexp_extract(given, PARTS, 2)


def longest_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or NULLs. rules: (verdict, "host/path")."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams_of(text: Column, order: int) -> Column:
    """All (order + 1)-grams of the text with ``order`` start marks before it and an end mark after it."""
    marked = F.concat(F.lit("\x02" * order), text, F.lit("\x03"))
    return F.regexp_extract_all(marked, F.lit("(?s)(?=(.{%d}))" % (order + 1)), F.lit(1))


def gram_model(spark: SparkSession, urls: DataFrame, order: int) -> DataFrame:
    """(gram, ratio): log-likelihood difference of a gram's last character after the ones before it."""
    grams = urls.select(F.when(~F.col("check"), F.col("ruled")).alias("ruled"), F.explode(grams_of(F.col("string"), order)).alias("gram"))
    counts = grams.groupBy("gram").agg(*[F.sum(F.when(F.col("ruled") == k, 1).otherwise(0)).cast("double").alias(k) for k in KINDS])
    counts = materialise(spark, counts, "grams")
    alphabet = counts.agg(F.count_distinct(F.substring("gram", order + 1, 1))).first()[0] or 1
    model = counts.select("gram", *[F.lit(1.0 / alphabet).alias(f"p_{k}") for k in KINDS])
    for length in range(order + 1):  # contexts of 0, 1, ..., order characters
        tail = F.substring("gram", order + 1 - length, length + 1)
        context = F.substring("gram", order + 1 - length, length)
        events = counts.groupBy(tail.alias("tail"), context.alias("context")).agg(*[F.sum(k).alias(f"n_{k}") for k in KINDS])
        totals = events.groupBy(F.col("context").alias("context_")).agg(
            *[F.sum(f"n_{k}").alias(f"all_{k}") for k in KINDS],
            *[F.sum((F.col(f"n_{k}") > 0).cast("double")).alias(f"kinds_{k}") for k in KINDS],
        )
        model = model.withColumn("tail", tail).withColumn("context_", context)
        model = model.join(events.drop("context"), "tail").join(totals, "context_")
        mixed = [
            F.when(F.col(f"all_{k}") == 0, F.col(f"p_{k}"))
            .otherwise((F.col(f"n_{k}") + F.col(f"kinds_{k}") * F.col(f"p_{k}")) / (F.col(f"all_{k}") + F.col(f"kinds_{k}")))
            .alias(f"p_{k}")
            for k in KINDS
        ]
        model = model.select("gram", *mixed)
    return materialise(spark, model.select("gram", F.log(F.col("p_allow") / F.col("p_block")).alias("ratio")), "model")


def calibrated_threshold(scored: DataFrame, cells: int = 4000, reach: float = 4.0) -> float:
    """The cell border with the largest difference of the two kinds' shares above it; 0 if one kind is missing."""
    cell = F.floor((F.least(F.greatest("score", F.lit(-reach)), F.lit(reach)) + reach) / (2 * reach) * cells)
    rows = scored.where("ruled IS NOT NULL AND check").groupBy(cell.alias("cell"), "ruled").agg(F.count(F.lit(1)).alias("n")).collect()
    total = {k: sum(r["n"] for r in rows if r["ruled"] == k) for k in KINDS}  # at most 2 * cells rows
    if not all(total.values()):
        return 0.0
    best, at, above = 0.0, None, dict.fromkeys(KINDS, 0)
    for c in sorted({r["cell"] for r in rows}, reverse=True):
        for r in rows:
            if r["cell"] == c:
                above[r["ruled"]] += r["n"]
        gain = above["allow"] / total["allow"] - above["block"] / total["block"]
        if gain > best:
            best, at = gain, c
    return 0.0 if at is None else at / cells * 2 * reach - reach


def judge(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]], order: int = 4, salts: int = 16) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log-likelihood difference per character) for every row."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("uid"))
    rule, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    urls = rows.select("*", rule.alias("rule"), verdict.alias("ruled"), F.concat("host", "path").alias("string"))
    urls = urls.withColumn("check", F.pmod(F.xxhash64("string"), F.lit(5)) == 0)
    urls = materialise(spark, urls, "urls")
    model = gram_model(spark, urls, order)
    copies = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    looked = urls.select("uid", F.explode(grams_of(F.col("string"), order)).alias("gram"))
    looked = looked.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int"))
    sums = looked.join(copies, ["gram", "salt"]).groupBy("uid").agg(F.avg("ratio").alias("score"))
    scored = materialise(spark, urls.join(sums, "uid").drop("string"), "scored")
    least = calibrated_threshold(scored)
    own = F.when(F.col("score") >= least, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
