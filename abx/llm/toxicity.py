"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

A linear classifier over the words and word beginnings that a text holds is
trained from confirmed toxic documents and a sample of unlabelled text, which
itself holds toxic documents at the class prior. The risk on negatives is
estimated as the risk of the unlabelled minus the prior's share of positives and
is kept from going below zero. Texts are scored in batches by the trained weights.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.quality import words_of
from abx.llm.runtime import small_batches, worker_cache, written

LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
SKETCH = 16
CACHE_ENTRIES = 100_000     # per worker; a full cache is emptied, results do not depend on it


@dataclass(frozen=True)
class Settings:
    """The fit's bounds: at most ``max_positives`` confirmed texts (those with the lowest hash
    of their unit) and about ``max_unlabelled`` others, whole texts both. Copies are one."""

    max_positives: int = 4000
    max_unlabelled: int = 12000
    buckets: int = 1 << 22
    max_features: int = 4096
    min_z: float = 4.0
    min_count: int = 3
    min_posterior: float = 0.5      # of a positive, given the feature: prior x share in positives / in unlabelled
    steps: int = 400
    rate: float = 0.1
    decay: float = 1e-3


@dataclass(frozen=True)
class Model:
    features: np.ndarray    # sorted buckets that carry a weight
    weights: np.ndarray
    bias: float


def token_features(token: str, buckets: int) -> tuple[int, ...]:
    """Buckets (of four tiers each) of the words within a token between white space,
    and of their beginnings."""
    out = set()
    for word in LETTERS.findall(token.lower()):
        out.add(zlib.crc32(b"=" + word.encode("utf-8", "surrogatepass")) % (buckets // 4))
        for n in PREFIXES:
            if len(word) >= n:
                out.add(zlib.crc32(b"^" + word[:n].encode("utf-8", "surrogatepass")) % (buckets // 4))
    return tuple(out)


def text_features(text: str | None, cache: dict, buckets: int, wanted: set | None = None) -> list[int]:
    """Sorted features of a whole text: for each bucket that it holds, a tier for being
    there, one for twice and one in 200 words, one for three times and one in 100 (a
    word may be ordinary once and telling when it recurs). ``wanted`` limits the buckets."""
    tokens = (text or "").split()
    counts: dict[int, int] = {}
    for token, k in Counter(tokens).items():
        ids = cache.get(token)
        if ids is None:
            ids = token_features(token, buckets)
            if wanted is not None:
                ids = tuple(i for i in ids if i in wanted)
            if len(cache) >= CACHE_ENTRIES:
                cache.clear()
            cache[token] = ids
        for i in ids:
            counts[i] = counts.get(i, 0) + k
    n = max(50, len(tokens))
    out = []
    for i, k in counts.items():
        out.append(4 * i)
        if k >= 2 and 200 * k >= n:
            out.append(4 * i + 1)
            if k >= 3 and 100 * k >= n:
                out.append(4 * i + 2)
    return sorted(out)


def _gather(rows: np.ndarray, cols: np.ndarray, n: int, w: np.ndarray, b: float) -> np.ndarray:
    return b + np.bincount(rows, weights=w[cols], minlength=n)


def unit_of(text: Column) -> Column:
    """A key that copies and most near copies of a text share: of its distinct lower-case
    words the ``SKETCH`` lowest hashes, as one number. Single common words cannot make two
    texts one; texts of the very same words are one, as they are to the model but for
    how often the words recur."""
    words = F.transform(words_of(F.lower(text)), lambda w: F.xxhash64(w))
    return F.xxhash64(F.slice(F.sort_array(F.array_distinct(words)), 1, SKETCH))


def fit_nnpu(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, s: Settings) -> Model:
    """Train on feature sets. A feature needs a prior-corrected posterior (common words of
    long texts have none) and a z score of its share in positives over that in
    unlabelled texts; the best by z bound the model. Copies are to be folded before, and
    the prior is to count what the sets stand for."""
    if not pos or not unl or prior <= 0:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    held, in_p = np.unique(np.concatenate(pos), return_counts=True)
    in_p = in_p / len(pos)
    in_u = np.zeros(len(held))

    def found(sets: list[np.ndarray], among: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, place in ``among``) of the features of some texts at a time."""
        for a in range(0, len(sets), 500):
            part = sets[a:a + 500]
            flat = np.concatenate(part)
            at = np.minimum(np.searchsorted(among, flat), max(0, len(among) - 1)).astype(np.int32)
            hit = np.flatnonzero(among[at] == flat) if len(among) else np.zeros(0, np.int64)
            yield np.repeat(np.arange(a, a + len(part), dtype=np.int32), [len(x) for x in part])[hit], at[hit]

    for _, at in found(unl, held):
        in_u += np.bincount(at, minlength=len(held))
    in_u /= len(unl)
    base = np.maximum(in_u, 1.0 / len(unl))
    z = (in_p - in_u) / np.sqrt(base * (1 / len(pos) + 1 / len(unl)))
    good = np.flatnonzero((z >= s.min_z) & (in_p * len(pos) >= s.min_count - 1e-9)
                          & (prior * in_p >= s.min_posterior * in_u))
    good = held[np.sort(good[np.argsort(-z[good], kind="stable")[:s.max_features]])]

    def sparse(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = zip(*found(sets, good))
        return np.concatenate(rows), np.concatenate(cols)

    (pr, pc), (ur, uc) = sparse(pos), sparse(unl)
    w, b = np.zeros(len(good)), -1.0
    m, v = np.zeros(len(good) + 1), np.zeros(len(good) + 1)

    def grad(rows: np.ndarray, cols: np.ndarray, per_row: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(cols, weights=per_row[rows], minlength=len(good)), per_row.sum())

    for step in range(1, s.steps + 1):
        gp, gu = _gather(pr, pc, len(pos), w, b), _gather(ur, uc, len(unl), w, b)
        # Sigmoid loss, bounded as the estimator wants it: 1 - s for positives, s for negatives.
        sp, su = 0.5 * (1 + np.tanh(gp / 2)), 0.5 * (1 + np.tanh(gu / 2))
        neg_risk = su.mean() - prior * sp.mean()
        slope_p = prior * grad(pr, pc, sp * (1 - sp) / len(pos))
        d_neg = grad(ur, uc, su * (1 - su) / len(unl)) - slope_p
        # Below zero the estimate overfits the unlabelled texts: that part is undone.
        d = d_neg - slope_p if neg_risk >= 0 else -d_neg
        d[:-1] += s.decay * w
        m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
        move = s.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    # The threshold with the least risk by the same estimator, midway to the next lower value.
    gp, gu = (np.sort(_gather(r, c, n, w, b).round(9)) for r, c, n in ((pr, pc, len(pos)), (ur, uc, len(unl))))
    cuts = np.unique(np.concatenate((gp, gu, [max(gp[-1], gu[-1]) + 2])))
    hit_p = 1 - np.searchsorted(gp, cuts) / len(pos)
    hit_u = 1 - np.searchsorted(gu, cuts) / len(unl)
    k = int(np.argmin(prior * (1 - hit_p) + np.maximum(0, hit_u - prior * hit_p)))
    return Model(good, w, float(b - (cuts[k] + cuts[max(0, k - 1)]) / 2))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", settings: Settings = Settings()) -> Model:
    """Fit from the rows of ``labels`` given here (a fold, say) and text of ``docs``.

    Copies make one unit (see ``unit_of``), or their chance words would look telling; both
    samples and the class prior are over units. The prior is the share of positive units,
    each weighted by the labelled share of its rows, so that units are not counted the more
    for having more rows to label. Null ids and labels, and labels without a document, are
    ignored; an id or unit labelled both ways counts as positive. What is shuffled of all
    documents is ids and hashes, and the chosen units, which are broadcast, are bounded.
    """
    rows = (labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y"))
            .where("i is not null and y is not null").groupBy("i").agg(F.max("y").alias("y")))
    base = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    # h names the one text that stands for the unit.
    units = written(base.select("i", "h", unit_of(F.col("t")).alias("k")).join(rows, "i", "left").groupBy("k").agg(
        F.min("h").alias("h"), F.max("y").alias("y"), (F.count("y") / F.count("*")).alias("w")), "units")
    known = units.agg(F.count("*").alias("units"), F.sum("w").alias("n"), F.sum(F.when(F.col("y") == 1, F.col("w"))).alias("p")).first()
    if not known.n or not known.p:
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    confirmed = units.where("y = 1").orderBy(F.xxhash64("k"), "k").limit(settings.max_positives)
    unit = F.pmod(F.xxhash64("k", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    others = units.where(unit < min(1.0, settings.max_unlabelled / known.units))
    buckets = settings.buckets
    small_batches(docs.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        seen: set[int] = set()      # a task sends each unit once
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            first = [at for at, k in enumerate(keys) if not (k in seen or seen.add(k))]
            sets = [text_features(texts[at].as_py(), cache, buckets) for at in first]
            yield pa.record_batch([pa.array([keys[at] for at in first], pa.int64()), pa.array(sets, pa.list_(pa.int32()))],
                                  names=["k", "f"])

    def sampled(chosen: DataFrame) -> list[np.ndarray]:
        # Bounded by the settings: this is the sample, not the corpus.
        got = (base.join(F.broadcast(chosen.select("h", "k")), "h").select("k", "t")
               .mapInArrow(features, "k long, f array<int>").dropDuplicates(["k"]).toArrow())
        # Views into the Arrow buffers: the features stand in memory once, as 32-bit numbers.
        sets = [part[a:b] for c in got["f"].chunks for part, ends in ((c.values.to_numpy(), c.offsets.to_numpy()),)
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [sets[at] for at in np.argsort(got["k"].to_numpy())]     # in an order that no task decides

    return fit_nnpu(sampled(confirmed), sampled(others), known.p / known.n, settings)


def scorer(spark, model: Model, buckets: int = Settings.buckets):
    """A column function: text -> score in 0..1. The broadcast weights number at most
    ``max_features``. Null and empty texts get the score of the bias alone."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast((dict(zip(model.features.tolist(), model.weights.tolist())), model.bias))
    name = shared._jbroadcast.id()

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        weights, bias = shared.value
        mine, wanted = worker_cache("toxicity"), {f // 4 for f in weights}
        if mine.get("model") != name:       # another model's tokens
            mine.clear()
            mine.update(model=name, tokens={})
        cache = mine["tokens"]
        g = np.array([bias + sum(weights.get(f, 0.0) for f in text_features(t, cache, buckets, wanted))
                      for t in texts.to_pylist()], float)
        return pa.array(0.5 * (1 + np.tanh(g / 2)), pa.float64())

    return scored


def held_out(id_col: Column) -> Column:
    """Rows whose labels are kept from training: crc32 of the id as text, modulo 5, is 0
    (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
