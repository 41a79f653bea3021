"""The corpus pipeline: language ID, toxicity, SimHash near-dedup, substring dedup, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` applies them to ``documents``; between stages the rows
are written as Parquet in the shared folder and read again. All but the last
stage return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.llm import langid, packing, simhash, substring, toxicity
from abx.llm.runtime import free_name, written

MIN_LANGUAGE_SCORE = 0.5
VOCABULARY = "byte_bpe_50k.json"
SEQUENCE = 2048


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: no letters, or a posterior below
    ``MIN_LANGUAGE_SCORE``. The model learns from the labelled documents at hand.
    Where none has a label nothing is learned, and only letterless texts go."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    if not model.langs:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    found = free_name(docs, "found")
    return (docs.withColumn(found, langid.predictor(spark, model)(F.col("text")))
            .where((F.col(f"{found}.lang_pred") != "und") & (F.col(f"{found}.score") >= MIN_LANGUAGE_SCORE))
            .drop(found))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents scored 0.5 or more. Labels come from ``labels``, outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    held = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    return docs.where(toxicity.scorer(spark, model)(F.col("text")) < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each SimHash group (3 words, 3 bits)."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 words and more that a document with a smaller id holds.
    ``n_chars`` follows the text where it changes; documents stay, if with less text."""
    cut = substring.remove_repeats(docs)
    removed = cut.columns[-1]
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.drop(*cut.columns[-2:])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of ``SEQUENCE`` tokens."""
    return packing.pack(packing.pieces_of(docs, public_tokenizers.path(VOCABULARY), SEQUENCE), SEQUENCE)


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

#: Trained models, fingerprint components and subword tokens are beyond SQL; the
#: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
