"""The corpus pipeline: four stages over ``documents``, each written as Parquet and read again by the next.

toxicity -> exact dedup -> n-gram Jaccard join -> best-fit packing.
Every stage works on all rows its predecessor kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratelake.llm import block_naming, chosen_path, packing, tokenised, toxicity
from ratelake.llm.common import materialise, table
from ratelake.llm.queries import tokenizer_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels outside the held-out quarter."""
    scored = toxicity.score_documents(spark, docs, table(spark, sf_dir, "labels"))
    return scored.where("__predicted = 0").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return block_naming.drop_duplicates(spark, docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays: the one with the smallest doc_id."""
    return chosen_path.keep_one_per_class(spark, docs, n=5, threshold=0.8)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document as pieces placed in sequences of 2048 tokens."""
    return packing.pack(spark, tokenised.token_pieces(docs, tokenizer_path("word_bpe_49k.json"), 2048, 0), 2048)


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier, the recall-driven join and the packing are not expressible in SQL; a test holds the stages after the
#: classifier against brute force (the classifier's own scores have no brute-force version).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(spark, docs, name)
    return docs
