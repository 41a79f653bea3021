"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.llm import (bpe, centroids, embedding, langid, oracle, packing, pii, quality, simhash, substring, token_counts, toxicity, url_filter,
                     whitening)

DIGEST6 = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The rules that the url query applies.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url judged by the rules and by its redirect and canonical-link class."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(packing.pieces_of(table(spark, sf_dir, "documents"), vocabulary(), 2048), 2048)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs.select("doc_id", "text"), docs.where(~held & F.col("doc_id").isNotNull()))
    return found.select("doc_id", held.alias("held_out"), "langid.lang_pred", "langid.score")


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of the text decoded from them."""
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary())
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    score = toxicity.scorer(spark, model)(F.col("text"))
    return (docs.select("doc_id", held.alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over every whole text."""
    return quality.with_quality(table(spark, sf_dir, "documents")).select(*DIGEST6)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows that an earlier one holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring.remove_repeats(docs, window=50)
    kept = F.array_join(quality.words_of(F.col("text")), " ")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return token_counts.with_token_counts(table(spark, sf_dir, "documents"), vocabulary(), limit=512)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


CENTROIDS = centroids.Settings(k=8, dim=64, rounds=10, scale=1024, seed="3:")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 8 clusters after 10 rounds, in exact integers."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"), settings=CENTROIDS)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on 32 principal axes. ``deviation`` is null where it would not
    fit a long; ``deviation_exact`` always holds it."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
    return found.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text; the model learns from what the patterns find."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    return found.select("doc_id", *(pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(pii.merged(F.col("base"), F.col("added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_best_fit_packing, op3_language_id, op4_bpe_round_trip, op5_toxicity, op6_quality_rules,
    op7_simhash_dedup, op8_substring_dedup, op9_token_counts, op10_embedding_dedup,
    op11_centroid_clustering, op12_embedding_whitening, op13_pii)}
ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": oracle.url_sql(URL_RULES),
    "op6_quality_rules": oracle.quality_sql(),
    "op8_substring_dedup": oracle.substring_sql(50),
    "op10_embedding_dedup": oracle.embedding_sql(0.95),
    "op11_centroid_clustering": oracle.centroids_sql(CENTROIDS.k, CENTROIDS.dim, CENTROIDS.rounds, CENTROIDS.scale, CENTROIDS.seed),
}
