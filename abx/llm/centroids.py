"""Centroid clustering in exact integers, with a PCA-rotated filter.

Vectors become integers once and are rotated about their mean onto the principal
axes of all of them; a row keeps its leading rotated coordinates p and the norm
rho of the rest. For a centroid rotated likewise, |p - p_c|^2 + (rho - rho_c)^2 is
at most the squared distance, so a row settles the centroid of the least bound
in integers and then only those whose bound does not exceed that distance.
The rotation decides what is skipped, never a result.

A round is one pass over the written rows: tasks add up counts and component sums per
centroid, and only those k sums reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.llm.moments import finite_vector, matrix, packed_matrix, packed_rows, summed
from abx.llm.runtime import written


@dataclass(frozen=True)
class Settings:
    """``k`` centroids over vectors of ``dim`` components, each floor(``scale`` * x);
    ``rounds`` of moving them; ``leading`` rotated coordinates are stored."""

    k: int = 8
    dim: int = 64
    rounds: int = 10
    scale: int = 1024
    leading: int = 8
    seed: str = "3:"

    @property
    def largest(self) -> int:
        """Components up to this size keep every squared distance within 62 bits."""
        return int((2.0 ** 62 / self.dim) ** 0.5 / 2)


@dataclass(frozen=True)
class Rotation:
    mean: np.ndarray
    axes: np.ndarray        # columns by falling variance

    def split(self, x: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
        """Leading rotated coordinates, and the norm of the other ones."""
        y = (x - self.mean) @ self.axes
        return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


def nearest(x: np.ndarray, p: np.ndarray, rho: np.ndarray, centres: np.ndarray, rotation: Rotation
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: the smaller number), its squared distance, and
    how many distances were settled in integers."""
    pc, rc = rotation.split(centres.astype(float), p.shape[1])
    bound = (rho[:, None] - rc) ** 2
    for j in range(p.shape[1]):
        bound += (p[:, j, None] - pc[:, j]) ** 2
    # Rounding moves a bound by less than this share of the squares that enter it.
    bound -= 1e-9 * (((p ** 2).sum(axis=1) + rho ** 2)[:, None] + (pc ** 2).sum(axis=1) + rc ** 2) + 1.0
    label = bound.argmin(axis=1)
    best = ((x - centres[label]) ** 2).sum(axis=1)
    settled = len(x)
    bound[np.arange(len(x)), label] = np.inf
    for c, own in enumerate(centres):
        r = np.flatnonzero(bound[:, c] <= best)
        d = ((x[r] - own) ** 2).sum(axis=1)
        settled += len(r)
        nearer = (d < best[r]) | ((d == best[r]) & (c < label[r]))
        best[r[nearer]], label[r[nearer]] = d[nearer], c
    return label, best, settled


def _stored(kept: DataFrame, s: Settings) -> tuple[DataFrame, Rotation]:
    """Rows with integers, leading coordinates and residual norm, written once."""
    dim = s.dim

    def spread(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("v"), dim)
        if np.abs(x).max() * s.scale > s.largest:
            raise ValueError(f"a component times {s.scale} exceeds {s.largest}: squared distances would not fit a long")
        return np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).ravel()))

    total = summed(kept.select("v"), spread, 1 + dim + dim * dim)
    n = max(total[0], 1.0)
    mean = total[1:dim + 1] / n
    axes = np.linalg.eigh(total[dim + 1:].reshape(dim, dim) / n - np.outer(mean, mean))[1][:, ::-1]
    rotation = Rotation(np.floor(mean * s.scale), np.ascontiguousarray(axes))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scaled = np.floor(matrix(b.column("v"), dim) * s.scale)
            p, rho = rotation.split(scaled, s.leading)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), packed_rows(scaled.astype(np.int32)), packed_rows(p), pa.array(rho)], ["id", "x", "p", "rho"])

    schema = T.StructType([kept.schema["id"], T.StructField("x", T.BinaryType()), T.StructField("p", T.BinaryType()),
                           T.StructField("rho", T.DoubleType())])
    return written(kept.mapInArrow(store, schema), "centroids"), rotation


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """Clusters of all vectors of ``settings.dim`` components without null, NaN or infinity
    (all other rows, null vectors among them, are left out).

    Centroids start as the ``k`` vectors of the least sha256 of ``seed`` and the id (equal
    hashes, that is repeated ids: by their integers); a row whose id is null never starts
    one, though it is clustered. Fewer vectors give fewer centroids, an empty table an
    empty result; repeated rows count each. Other columns are not read. A component whose
    integer exceeds ``settings.largest`` (131,072 before scaling, by default) is an error.

    Returns ``id_col``, cluster, distance (squared, in integers), cluster_inertia,
    inertia, centroid_sha256.
    """
    s = settings
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        finite_vector(F.col("v")) & (F.size("v") == s.dim))
    rows, rotation = _stored(kept, s)
    digest = F.sha2(F.concat(F.lit(s.seed), F.col("id").cast("string")), 256)
    first = rows.where(F.col("id").isNotNull()).orderBy(digest, "x").limit(s.k).select("x").collect()
    out = (F.col("id").alias(id_col), "cluster", "distance")
    if not first:       # no vector, or no id at all to start from
        nothing = rows.where("false").select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return nothing.withColumns({"cluster_inertia": F.lit(0).cast("long"), "inertia": F.lit(0).cast("long"),
                                    "centroid_sha256": F.lit("")})
    centres = np.array([np.frombuffer(r.x, np.int32) for r in first], np.int64)

    def unpack(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (packed_matrix(b.column("x"), np.int32, s.dim).astype(np.int64), packed_matrix(b.column("p"), np.float64, min(s.leading, s.dim)),
                b.column("rho").to_numpy())

    for _ in range(s.rounds):
        def moved(b: pa.RecordBatch, centres=centres) -> np.ndarray:
            x, p, rho = unpack(b)
            label = nearest(x, p, rho, centres, rotation)[0]
            sums = np.zeros((len(centres), s.dim + 1), np.int64)
            for c in range(len(centres)):
                mine = x[label == c]
                sums[c, 0], sums[c, 1:] = len(mine), mine.sum(axis=0)
            return sums.ravel()

        sums = summed(rows.select("x", "p", "rho"), moved, len(centres) * (s.dim + 1), np.int64).reshape(len(centres), -1)
        count = sums[:, :1]
        step = np.where(count > 0, sums[:, 1:] // np.maximum(count, 1), centres)
        if (step == centres).all():     # further rounds would change nothing
            break
        centres = step

    def label_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, distance, _ = nearest(*unpack(b), centres, rotation)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(label.astype(np.int32)), pa.array(distance)],
                                             ["id", "cluster", "distance"])

    schema = T.StructType([rows.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    found = written(rows.mapInArrow(label_rows, schema), "clusters")
    inertia = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}   # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    return found.select(
        *out,
        F.element_at(F.array(*(F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centres)))), F.col("cluster") + 1).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1).alias("centroid_sha256"))
