"""The registered queries of the training-data operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import block_naming, byte_bpe, chosen_path, fingerprints, html_text, hyperminhash, katz, lexical, packing, sharding, tokenised, toxicity, url_filter, whitening
from ratelake.llm.common import crc_of_id, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenised.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 2048, 0)
    return packing.pack(spark, pieces, 2048)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_join(spark, table(spark, sf_dir, "documents"), n=5, threshold=0.8)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(spark, docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("__score").alias("score"), F.col("__predicted").alias("predicted"))


# The rules of the query.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark, table(spark, sf_dir, "pages"), URL_RULES)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.train_and_score(spark, table(spark, sf_dir, "documents"), crc_of_id() % 10 == 0)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints.fingerprint_documents(spark, table(spark, sf_dir, "documents"))
    return prints.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_duplicates(spark, table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(spark, table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(spark, table(spark, sf_dir, "documents"), n=2, threshold=0.8)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"), components=32, scale=64.0, shift=1_000_000)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_lm_score": op6_lm_score,
    "op7_html": op7_html,
    "op8_fingerprints": op8_fingerprints,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_minhash": op11_minhash,
    "op12_whitening": op12_whitening,
    "op13_search": op13_search,
}

SQL = {
    "op9_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        ), g AS (
          SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
        )
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
        FROM t JOIN g ON t.norm = g.norm
    """,
    "op11_minhash": r"""
        WITH RECURSIVE t AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents
        ), s AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [[x] for x in w] ELSE [[w[k], w[k + 1]] for k in range(1, len(w))] END) AS g FROM t
        ), n AS (
          SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), common AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
        ), link AS (
          SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
        ), reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM t UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a
        ), least AS (
          SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN n USING (doc_id)
    """,
    "op13_search": r"""
        WITH terms AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM documents
        ), asked AS (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark
        ), lengths AS (
          SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
        ), corpus AS (
          SELECT count(*)::BIGINT AS d, sum(n)::BIGINT AS l FROM lengths
        ), factors AS (
          SELECT doc_id, 75 + (25 * n * d) // l AS m FROM lengths, corpus
        ), tfs AS (
          SELECT term, doc_id, count(*) AS tf FROM terms GROUP BY term, doc_id
        ), weights AS (
          SELECT term, floor(1000 * ln((2 * d + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, corpus GROUP BY term, d
        ), scores AS (
          SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
          FROM (SELECT item_id, term, count(*) AS repeats FROM asked GROUP BY ALL)
          JOIN tfs USING (term) JOIN weights USING (term) JOIN factors USING (doc_id) GROUP BY item_id, doc_id
        ), ranked AS (
          SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 20
    """,
}
