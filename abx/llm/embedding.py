"""Embedding near duplicates by cross-polytope hashing (Andoni et al., 2015).

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; a hash is the signed axis nearest to the result, and a table's key
joins several hashes, the last over fewer axes so that keys have as many bits as
the number of vectors calls for. A vector lies in the bucket of its key and
visits those of its next best keys (multiprobe). Pairs that meet are verified by
their cosine in double precision.

Only ids and keys are shuffled to find buckets in which vectors meet; vectors
travel to those alone. A pair is counted in the first table and bucket in which
it meets, which each task tells from the two vectors, so links are counted
without being listed; for components a task sends a forest of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.llm.components import connected_components, merge_labels
from abx.llm.runtime import worker_cache, written

SLOTS = 1024        # members and visitors of a bucket that one task compares; larger buckets are split in blocks
CHUNK_ROWS = 4096
PAIRS = 1 << 18     # pairs judged at once
LEAST_CHANCE = 0.01 # that a pair at the threshold meets in a table; keys are shortened to reach it


@dataclass(frozen=True)
class Hashing:
    """``bits`` of a key, ``tables``, and ``probes`` beside the key itself. The index needs
    no fitting; ``tables`` is chosen so that a pair at the threshold meets with
    probability ``recall`` by a simulation over random pairs."""

    bits: int
    tables: int
    probes: int = 6
    seed: int = 20


def _shape(dim: int, bits: int) -> tuple[int, list[int]]:
    """Padded length, and over how many axes each hash of a key goes."""
    pad = max(8, 1 << (dim - 1).bit_length())
    full = pad.bit_length()     # bits of a hash over all axes: axis and sign
    axes = [pad] * (bits // full)
    if bits % full or not axes:
        axes.append(1 << max(1, bits % full - 1))
    return pad, axes


def _hadamard(x: np.ndarray) -> np.ndarray:
    h, n = 1, x.shape[1]
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(len(x), n)
        h *= 2
    return x


def keys_of(vectors: np.ndarray, how: Hashing) -> tuple[np.ndarray, np.ndarray]:
    """Key (rows x tables) and probes (rows x tables x probes) of each vector."""
    n, dim = vectors.shape
    pad, axes = _shape(dim, how.bits)
    flips = worker_cache("flips").setdefault((how, dim), np.random.default_rng((how.seed, dim)).choice(
        [-1.0, 1.0], (how.tables, len(axes), 3, pad)))
    x = np.zeros((n, pad))
    x[:, :dim] = vectors
    # Which hashes take their second choice, for all subsets but the empty one.
    subsets = np.array([[s >> k & 1 for k in range(len(axes))] for s in range(1, 1 << min(len(axes), 10))], bool)
    subsets = np.pad(subsets, ((0, 0), (0, len(axes) - subsets.shape[1])))
    probes = min(how.probes, len(subsets))
    key = np.empty((n, how.tables), np.int64)
    probe = np.empty((n, how.tables, probes), np.int64)
    rows = np.arange(n)
    for t in range(how.tables):
        code, gain, gap = np.zeros((n, len(axes)), np.int64), np.zeros((n, len(axes)), np.int64), np.zeros((n, len(axes)))
        unit = 1
        for k, width in enumerate(axes):
            y = x
            for f in flips[t, k]:
                y = _hadamard(y * f)
            y = y[:, :width]
            a = np.abs(y)
            first = a.argmax(axis=1)
            top = a[rows, first]
            a[rows, first] = -1.0
            second = a.argmax(axis=1)
            gap[:, k] = (top - a[rows, second]) ** 2
            one, two = (2 * i + (y[rows, i] < 0) for i in (first, second))
            code[:, k], gain[:, k] = one * unit, (two - one) * unit
            unit *= 2 * width
        key[:, t] = code.sum(axis=1)
        order = np.argsort(gap @ subsets.T.astype(float), axis=1, kind="stable")[:, :probes]
        probe[:, t] = key[:, t, None] + np.take_along_axis(gain @ subsets.T.astype(np.int64), order, axis=1)
    return key, probe


def meet(key_a, probe_a, key_b, probe_b) -> np.ndarray:
    """Whether the pairs meet, per table."""
    return ((key_a == key_b) | (probe_a == key_b[..., None]).any(-1) | (probe_b == key_a[..., None]).any(-1))


def chance(dim: int, bits: int, threshold: float) -> float:
    """Probability that a random pair with this cosine meets in a table, by simulation."""
    rng = np.random.default_rng((5, dim))
    a = rng.standard_normal((2000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = threshold * a + math.sqrt(1 - threshold ** 2) * b / np.where(norm > 1e-9, norm, 1.0)
    trial = Hashing(bits, 4)
    return float(meet(*keys_of(a, trial), *keys_of(b, trial)).mean())


def plan(total: int, dims: list[int], threshold: float, recall: float = 0.995) -> Hashing:
    """Bits by the number of vectors (about 16 buckets each), tables by simulation at the
    threshold. Where pairs would meet too seldom to be simulated, or to be found in a
    sensible number of tables, keys are shortened: buckets grow, recall stays."""
    bits = min(60, math.ceil(math.log2(max(2, total))) + 4)
    for dim in dims:
        while chance(dim, bits, threshold) < LEAST_CHANCE:
            if bits <= 2:
                raise ValueError(f"pairs of cosine {threshold} meet too seldom in {dim} dimensions")
            bits -= 1
    tables = 1
    for dim in dims:
        p = chance(dim, bits, threshold)
        tables = max(tables, math.ceil(math.log(1 - recall) / math.log(1 - min(p, 0.999))))
    return Hashing(bits, tables)


def _rows(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a list column, as double."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1])


def close_pairs(x: np.ndarray, main: np.ndarray, side: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one bucket block with a cosine of ``threshold`` or more, in tiles. ``side``
    is 0 for all in an undivided block; else pairs go across sides 1 and 2. One of
    a pair is a member of the bucket."""
    step = 512
    for a in range(0, len(x), step):
        for b in range(a, len(x), step):
            near = x[a:a + step] @ x[b:b + step].T >= threshold
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            good = (i < j) & (main[i] | main[j]) & ((side[i] == 0) | (side[i] != side[j]))
            if good.any():
                yield i[good], j[good]


def judge(x, rep, size, main, side, group, table, key, how: Hashing, threshold: float):
    """Links counted and forest edges of some bucket blocks of one dimension, whose rows
    are sorted by ``group``. Returns ids with their counts, and pairs of ids."""
    links = np.zeros(len(rep), np.int64)
    label = np.arange(len(rep))
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(group)))
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        nonlocal label, pairs, held
        if not pairs:
            return
        i, j = (np.concatenate(c) for c in zip(*pairs))
        pairs, held = [], 0
        other = rep[i] != rep[j]
        i, j = i[other], j[other]
        if not len(i):
            return
        swap = rep[i] > rep[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        rows, at = np.unique(np.concatenate((i, j)), return_inverse=True)
        k, p = keys_of(x[rows], how)
        low, high = at[:len(i)], at[len(i):]
        for a in range(0, len(i), 1 << 14):
            u, w = low[a:a + (1 << 14)], high[a:a + (1 << 14)]
            lo, hi = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
            first = meet(k[u], p[u], k[w], p[w]).argmax(axis=1)
            n = np.arange(len(u))
            ku, kw = k[u, first], k[w, first]
            at_low = (ku == kw) | (p[w, first] == ku[:, None]).any(axis=1)
            own = (first == table[lo]) & (np.where(at_low, ku, kw) == key[lo])
            np.add.at(links, lo[own], size[hi[own]])
            np.add.at(links, hi[own], size[lo[own]])
            label = merge_labels(label, lo, hi)

    for m in np.unique(sizes):
        own = starts[sizes == m]
        if m == 1:
            continue
        if m > 64:
            for a in own:
                for i, j in close_pairs(x[a:a + m], main[a:a + m], side[a:a + m], threshold):
                    pairs.append((i + a, j + a))
                    held += len(i)
                    if held > PAIRS:
                        settle()
            continue
        for a in range(0, len(own), max(1, PAIRS // (m * m))):     # many small groups at once
            at = own[a:a + max(1, PAIRS // (m * m)), None] + np.arange(m)
            near = np.matmul(x[at], x[at].transpose(0, 2, 1)) >= threshold
            g, i, j = np.nonzero(near)
            i, j = at[g, i], at[g, j]
            good = (i < j) & (main[i] | main[j]) & ((side[i] == 0) | (side[i] != side[j]))
            pairs.append((i[good], j[good]))
            held += int(good.sum())
            if held > PAIRS:
                settle()
    settle()
    moved = np.flatnonzero(label != np.arange(len(rep)))
    counted = np.flatnonzero(links)
    return rep[counted], links[counted], rep[moved], rep[label[moved]]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, how: Hashing | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows
    without an id, link with nothing; so do vectors of different lengths. Equal
    vectors are one node: each links with all its equals. Rows that repeat an id are
    rows of their own among equals, and one vertex otherwise. An empty table gives an
    empty result; other columns are not read. Ids are longs.
    """
    v = F.col("v")
    fit = (v.isNotNull() & F.col("id").isNotNull()
           & F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
           & F.coalesce(F.exists(v, lambda c: c != 0), F.lit(False)))
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).withColumn("fit", fit)
            .withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v")))
    classes = written(rows.where("fit").groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.count("*").alias("size"), F.first("v").cast("array<double>").alias("v")), "classes")
    dims = [r.d for r in classes.select(F.size("v").alias("d")).distinct().collect()]    # one number per vector length
    how = how or plan(classes.count(), dims, threshold)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, vec = batch.column(0).to_numpy(), _rows(batch.column(1))
            length = np.array([len(x) for x in vec], np.int64)
            for d in np.unique(length):
                at = np.flatnonzero(length == d)
                for a in range(0, len(at), 1024):
                    part = at[a:a + 1024]
                    x = np.stack([vec[i] for i in part])
                    key, probe = keys_of(x / np.linalg.norm(x, axis=1, keepdims=True), how)
                    both = np.concatenate((key[:, :, None], probe), axis=2)
                    n, t, p = both.shape
                    yield pa.record_batch(
                        [pa.array(np.repeat(rep[part], t * p)), pa.array(np.full(n * t * p, d, np.int32)),
                         pa.array(np.tile(np.repeat(np.arange(t, dtype=np.int32), p), n)), pa.array(both.ravel()),
                         pa.array(np.tile(np.arange(p) == 0, n * t))], names=["rep", "d", "t", "key", "main"])

    keys = written(classes.select("rep", "v").mapInArrow(hashed, "rep long, d int, t int, key long, main boolean"), "keys")
    met = (keys.groupBy("d", "t", "key").agg(F.count("*").alias("c"), F.max("main").alias("any"))
           .where("c > 1 and any").select("d", "t", "key", F.ceil(F.col("c") / SLOTS).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    visits = (keys.join(met, ["d", "t", "key"]).withColumn("own", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("rep", "d", "t", "key", "main", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
                      .cast("int").alias("side")))
    place = ["d", "t", "key", "i", "j"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(table: pa.Table) -> Iterator[pa.RecordBatch]:
            col = {c: table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in [*place, "rep", "size", "main", "side"]}
            vec = _rows(table["v"].combine_chunks())
            change = np.zeros(len(vec), bool)
            for c in place:
                change[1:] |= col[c][1:] != col[c][:-1]
            group = np.cumsum(change)
            for d in np.unique(col["d"]):
                at = np.flatnonzero(col["d"] == d)
                x = np.stack([vec[k] for k in at])
                a = [col[c][at] for c in ("rep", "size", "main", "side")]
                rep, links, p, q = judge(x / np.linalg.norm(x, axis=1, keepdims=True), *a, group[at], col["t"][at],
                                         col["key"][at], how, threshold)
                n, m = len(rep), len(p)
                yield pa.record_batch(
                    [pa.array(np.concatenate((rep, p))), pa.array(np.concatenate((links, np.zeros(m, np.int64)))),
                     pa.array(np.concatenate((np.zeros(n, np.int64), q)), mask=np.arange(n + m) < n)],
                    names=["rep", "links", "to"])

        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            a = 0
            if count >= CHUNK_ROWS or count + batch.num_rows >= CHUNK_ROWS:
                # Up to the last group that surely ends in this batch.
                ids = [batch.column(c).to_numpy() for c in place]
                new = np.zeros(batch.num_rows, bool)
                for c in ids:
                    new[1:] |= c[1:] != c[:-1]
                if held:
                    last = held[-1]
                    new[:1] = any(last.column(c)[last.num_rows - 1].as_py() != int(v[0]) for c, v in zip(place, ids))
                for b in np.flatnonzero(new):
                    if count + b - a >= CHUNK_ROWS and (held or b > a):
                        yield from result(pa.Table.from_batches([*held, batch.slice(a, b - a)]))
                        held, count, a = [], 0, int(b)
            held.append(batch.slice(a))
            count += batch.num_rows - a
        if count:
            yield from result(pa.Table.from_batches(held))

    found = written(visits.join(classes.select("rep", "size", "v"), "rep")
                    .select(*place, "rep", "size", "main", "side", "v")
                    .repartition(*place).sortWithinPartitions(*place)
                    .mapInArrow(compared, "rep long, links long, to long"), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("to is not null"), "rep", "to")
    labels = written(
        classes.select("h1", "h2", "rep", "size").join(links, "rep", "left")
        .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("h1", "h2", F.lit(True).alias("fit"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "labels")
    return (rows.select("id", "fit", "h1", "h2").join(labels, ["h1", "h2", "fit"], "left")
            .select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
