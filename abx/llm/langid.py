"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is one matrix of log probabilities, ``buckets`` rows by one column per
language. It is fitted on a bounded sample of labelled documents (whole texts)
and broadcast; a batch of texts is scored by gathering the rows of the n-grams it
holds and summing them per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.runtime import free_name, slices, small_batches

ORDERS = (1, 2, 3)
BLOCK = 1 << 19           # characters scored at once
LETTER = regex.compile(r"\p{L}")
RESULT = "struct<lang_pred:string,score:double>"


@dataclass(frozen=True)
class Settings:
    """``buckets`` bounds the matrix; ``docs_per_lang`` bounds the sample that it is fitted on."""

    buckets: int = 1 << 15
    docs_per_lang: int = 4000
    smoothing: float = 0.1
    max_langs: int = 500    # more distinct labels than this are refused: labels are languages, not data


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    prior: np.ndarray       # log share of each language in the labelled documents
    weights: np.ndarray     # (buckets + 1, languages); the last row is zero


def ngram_rows(codes: np.ndarray, ends: np.ndarray, carry: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """For each order, the bucket of the n-gram that starts at each character; n-grams that would run
    over the end of their piece, or start in what it shows of the next one, get the row ``buckets``."""
    c = codes.astype(np.uint64)
    for n in ORDERS:
        h = np.full(len(c), 0x9E3779B97F4A7C15 * n & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for k in range(n):
            part = np.zeros(len(c), np.uint64)
            part[:len(c) - k] = c[k:]
            h = (h ^ part) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        rows = (h % np.uint64(buckets)).astype(np.int32)
        for k in range(1, max(ORDERS)):
            at = ends[(carry >= k) | (k < n)] - k
            rows[at[at >= 0]] = buckets
        yield rows


def _codes(pieces: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the pieces, where each ends, and what each shows of the next one."""
    return (np.frombuffer("".join(p for p, _ in pieces).encode("utf-32-le", "surrogatepass"), np.uint32),
            np.cumsum([len(p) for p, _ in pieces]), np.array([c for _, c in pieces], np.int64))


def _pieces(text: str) -> list[tuple[str, int]]:
    """A text, lower-cased and with a space at both ends, in pieces of BLOCK characters, so that memory stays
    bounded. Each shows the characters of the next one that its last n-grams reach (their number beside
    it), so every n-gram of the text counts once wherever the cuts fall."""
    padded = f" {text.lower()} "
    reach = max(ORDERS) - 1
    return [(padded[i:i + BLOCK + reach], max(0, min(reach, len(padded) - i - BLOCK))) for i in range(0, len(padded), BLOCK)]


def log_scores(texts: list[str], model: Model) -> np.ndarray:
    """Log joint score of each text and language."""
    pieces = [(i, p) for i, t in enumerate(texts) for p in _pieces(t)]
    out = np.tile(model.prior, (len(texts), 1))
    buckets = len(model.weights) - 1
    for a, b in slices([p for _, (p, _) in pieces], BLOCK):
        codes, ends, carry = _codes([p for _, p in pieces[a:b]])
        total = np.zeros((b - a, len(model.langs)))
        starts = np.concatenate(([0], ends[:-1]))
        for rows in ngram_rows(codes, ends, carry, buckets):
            total += np.add.reduceat(model.weights[rows], starts, axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _ in pieces[a:b]], total)
    return out


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text; ``und`` with score 0 for null, for texts
    without a letter, and where nothing was learned."""
    known = [i for i, t in enumerate(texts) if t and model.langs and LETTER.search(t)]
    langs, score = ["und"] * len(texts), np.zeros(len(texts))
    if known:
        s = log_scores([texts[i] for i in known], model)
        best = s.argmax(axis=1)     # ties go to the language that sorts first
        p = 1.0 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
        for i, k, x in zip(known, best, p):
            langs[i], score[i] = model.langs[k], min(1.0, float(x))
    return langs, score


def fit(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, settings: Settings = Settings()) -> Model:
    """Fit on the rows of ``labelled`` whose text and language are not null.

    Each language gives its ``docs_per_lang`` documents in expectation, chosen by a
    hash of the id, whole; priors come from the counts of all labelled rows. Gram
    counts are summed per task and language before they are shuffled.
    """
    rows = labelled.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(
        "t is not null and l is not null")
    # The labels' names come to the driver, never more than max_langs + 1 of them.
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count("*").alias("n")).limit(settings.max_langs + 1).collect()}
    if len(sizes) > settings.max_langs:
        raise ValueError(f"more than {settings.max_langs} languages")
    langs = tuple(sorted(sizes))
    if not langs:
        return Model((), np.zeros(0), np.zeros((settings.buckets + 1, 0), np.float32))
    share = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, settings.docs_per_lang / sizes[k]))))
    unit = F.pmod(F.xxhash64("i", F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(unit < share[F.col("l")]).select("t", "l")
    buckets = settings.buckets
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(langs), buckets + 1), np.int64)
        at = {x: i for i, x in enumerate(langs)}
        for batch in batches:
            texts = [(p, at[x]) for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     for p in _pieces(t)]
            for a, b in slices([t for (t, _), _ in texts], BLOCK):
                codes, ends, carry = _codes([t for t, _ in texts[a:b]])
                lang = np.repeat(np.array([k for _, k in texts[a:b]], np.int64), np.diff(ends, prepend=0))
                for grams in ngram_rows(codes, ends, carry, buckets):
                    sums += np.bincount(lang * (buckets + 1) + grams, minlength=sums.size).reshape(sums.shape)
        k, g = np.nonzero(sums[:, :buckets])
        for a in range(0, len(k), 1 << 16):
            yield pa.record_batch([pa.array(k[a:a + (1 << 16)], pa.int32()), pa.array(g[a:a + (1 << 16)], pa.int32()),
                                   pa.array(sums[k[a:a + (1 << 16)], g[a:a + (1 << 16)]], pa.int64())],
                                  names=["l", "g", "n"])

    # One task per few thousand sampled documents: each sends one row per language and gram at most.
    tasks = max(1, min(64, len(langs) * settings.docs_per_lang // 1000))
    counts = (sample.repartition(tasks).mapInArrow(count, "l int, g int, n long")
              .groupBy("l", "g").agg(F.sum("n").alias("n")).toArrow())    # at most languages x buckets rows
    dense = np.zeros((buckets + 1, len(langs)))
    dense[counts["g"].to_numpy(), counts["l"].to_numpy()] = counts["n"].to_numpy()
    smooth = dense[:buckets] + settings.smoothing
    weights = np.zeros((buckets + 1, len(langs)), np.float32)
    weights[:buckets] = np.log(smooth / smooth.sum(axis=0))
    prior = np.log(np.array([sizes[x] for x in langs], float) / sum(sizes.values()))
    return Model(langs, prior, weights)


def predictor(spark, model: Model):
    """A column function: text -> ``struct<lang_pred, score>``. The matrix (buckets x
    languages floats, a bound that does not depend on the data) is broadcast once."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.prior, model.weights))

    @F.arrow_udf(RESULT)
    def scored(texts: pa.Array) -> pa.Array:
        langs, score = predict(texts.to_pylist(), Model(*shared.value))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                          names=["lang_pred", "score"])

    return scored


def identify(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with a struct column ``langid`` (renamed when taken) from a model fitted on ``labelled``.

    Every row is kept, repeated ones too; null, empty and letterless texts are
    ``und``. Empty tables and tables without labels are allowed.
    """
    model = fit(labelled, text_col, lang_col, id_col, settings)
    return docs.withColumn(free_name(docs, "langid"), predictor(docs.sparkSession, model)(F.col(text_col)))


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1 (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
