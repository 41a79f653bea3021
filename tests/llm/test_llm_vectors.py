"""Centroid clustering and whitening against single-process versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.llm import centroids, queries, whitening
from conftest import SF001

NAN = float("nan")


def frame(spark, rows, kind="long"):
    """Vectors, with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, "c", "x") for i, v in rows], f"vec_id {kind}, embedding array<double>, cluster string, id string")


# --- 11 centroids -------------------------------------------------------------

def brute_clusters(rows, s):
    kept = [(i, [math.floor(s.scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == s.dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(((hashlib.sha256(f"{s.seed}{i}".encode()).hexdigest(), np.array(x, np.int32).tobytes(), x) for i, x in kept if i is not None))
    centres = [x for _, _, x in order[:s.k]]
    square = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))

    def assigned():
        return [min((square(x, c), k) for k, c in enumerate(centres)) for _, x in kept] if centres else []

    for _ in range(s.rounds):
        label = assigned()
        for k in range(len(centres)):
            mine = [x for (_, x), (_, c) in zip(kept, label, strict=False) if c == k]
            if mine:
                centres[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    label = assigned()
    total = [sum(d for d, c in label if c == k) for k in range(len(centres))]
    return sorted(((i, c, d, total[c], sum(total), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, label, strict=False)), key=str)


def got_clusters(df, s):
    return sorted((tuple(r) for r in centroids.cluster(df, settings=s).collect()), key=str)


@pytest.mark.parametrize("case", ["spread", "ties", "negative", "repeated", "few"])
def test_clusters_equal_brute_force(spark, case):
    rng = random.Random(case)
    s = centroids.Settings(k=5, dim=6, rounds=4, scale=16, leading=2)
    draw = {"spread": lambda: rng.gauss(0, 3), "ties": lambda: rng.choice([0.0, 1.0]), "negative": lambda: -rng.random() * 1000,
            "repeated": lambda: float(rng.randrange(3)), "few": lambda: rng.random()}[case]
    rows = [(i, [draw() for _ in range(6)]) for i in range(4 if case == "few" else 300)]
    if case == "repeated":
        rows += [rows[7]] * 100 + [(7, rows[9][1])] * 30
    rows += [(1000, None), (1001, []), (1002, [1.0] * 5), (1003, [NAN] * 6), (1004, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (1005, [float("inf")] * 6), (None, [0.25] * 6)]
    assert got_clusters(frame(spark, rows).repartition(3), s) == brute_clusters(rows, s)


def test_clusters_of_nothing(spark):
    s = centroids.Settings(dim=2)
    assert got_clusters(frame(spark, []), s) == [] == got_clusters(frame(spark, [(None, [1.0, 2.0])]), s)
    assert centroids.cluster(frame(spark, []), settings=s).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert len(got_clusters(frame(spark, [("a", [1.0, 2.0])], "string"), s)) == 1
    with pytest.raises(Exception, match="would not fit"):
        got_clusters(frame(spark, [(1, [1e9, 2.0])]), s)


def test_filter_spares_distances_and_keeps_results():
    rng = np.random.default_rng(3)
    x = (np.repeat(rng.normal(0, 400, (8, 64)), 500, axis=0) + rng.normal(0, 60, (4000, 64))).astype(np.int64)
    centres = x[::500].copy()
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    rotation = centroids.Rotation(np.floor(x.mean(axis=0)), np.ascontiguousarray(axes))
    label, best, settled = centroids.nearest(x, *rotation.split(x.astype(float), 8), centres, rotation)
    every = ((x[:, None] - centres) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all() and (label == every.argmin(axis=1)).all()
    assert settled < 1.5 * len(x)


# --- 12 whitening -------------------------------------------------------------

def brute_whitening(vectors, scale=64, shift=1_000_000):
    x = np.floor(scale * np.array(vectors)).astype(np.int64) + shift
    n, sums = len(x), x.sum(axis=0)
    d = n * x - sums
    v = (d / n).T @ (d / n) / n
    values, axes = (a[..., ::-1] for a in np.linalg.eigh(v))
    return (d.astype(object) ** 2).sum(axis=1), (d / n) @ axes / np.sqrt(values), values / np.trace(v)


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.normal(0, 1, (400, 20)) * np.geomspace(3, 0.2, 20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    extra = [(900, None), (901, []), (902, [NAN] * 20), (903, [None] * 20), (904, [1.0] * 7), (905, [float("-inf")] * 20)]
    got = whitening.whiten(frame(spark, rows + extra).repartition(5), components=12).toPandas()
    deviation, whitened, explained = brute_whitening(vectors)
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    assert wide.shape == (400, 12) and list(wide.columns) == list(range(1, 13))
    assert np.abs(np.abs(wide.values) - np.abs(whitened[:, :12])).max() < 1e-9
    assert [int(x) for x in got[got.component == 1].sort_values("vec_id").deviation] == list(deviation)
    assert np.allclose(got[got.vec_id == 0].sort_values("component").explained, explained[:12], rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9 and (got.n == 400).all()


def test_registered_whitening_equals_eigh(spark):
    got = queries.op12_embedding_whitening(spark, SF001).toPandas()
    source = spark.read.parquet(f"{SF001}/embeddings.parquet").toPandas().sort_values("vec_id")
    deviation, whitened, _ = brute_whitening(source.embedding.tolist())
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    assert np.abs(np.abs(wide.values) - np.abs(whitened[:, :32])).max() < 1e-8
    assert (got[got.component == 32].sort_values("vec_id").deviation.to_numpy() == deviation.astype(np.int64)).all()


@pytest.mark.parametrize("values", [
    [5.0] * 30 + [1.0] * 10, np.geomspace(1, 1e-9, 40), [1.0] + [1e-3] * 39, [2.0 + 1e-13 * i for i in range(40)],
    [3.0, 2.0] + [0.0] * 38, np.linspace(1, 2, 40)])
def test_contour_integration_misses_none(values):
    values = np.array(values, float)
    axes = np.linalg.qr(np.random.default_rng(4).normal(size=(40, 40)))[0]
    v = (axes * values) @ axes.T
    v = (v + v.T) / 2
    found, vectors = whitening.principal(v, 32)
    wanted = np.sort(values[values > 1e-11 * values.sum()])[::-1][:32]
    assert len(found) == len(wanted) and np.allclose(found, wanted, rtol=1e-9, atol=1e-14 * values.sum())
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12 * values.sum()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12


def test_inertia_counts():
    v = np.random.default_rng(5).normal(size=(30, 30))
    v = v + v.T
    tri, values = whitening.tridiagonal(v), np.linalg.eigvalsh(v)
    for shift in np.linspace(-12, 12, 101):
        assert whitening.above(tri, shift) == (values > shift).sum()


def test_whitening_edges(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]):
        got = whitening.whiten(frame(spark, rows))
        assert got.columns == columns and got.count() == 0
    # Repeated rows and null ids count; a dimension that does not vary yields no axis.
    got = whitening.whiten(frame(spark, [(1, [0.0, 7.0]), (1, [0.0, 7.0]), (None, [1.0, 7.0]), (4, [1.0, 7.0, 2.0])]))
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert [(r[0], r[1], r[2], int(r[3])) for r in rows] == [(1, 1, 3, 64 ** 2), (1, 1, 3, 64 ** 2), (None, 1, 3, 128 ** 2)]
    assert [abs(r[4]) for r in rows] == pytest.approx([0.5 ** 0.5, 0.5 ** 0.5, 2 ** 0.5])
    # Squares beyond a long stay exact.
    big = whitening.whiten(frame(spark, [(1, [2.0 ** 40]), (2, [-(2.0 ** 40)])])).select("vec_id", F.col("deviation").cast("string")).collect()
    assert {r[1] for r in big} == {str((2 ** 47) ** 2)}
    with pytest.raises(Exception, match="2\\^52"):
        whitening.whiten(frame(spark, [(1, [1e300]), (2, [1.0])])).collect()
