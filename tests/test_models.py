import numpy as np
import pytest
from pyspark.sql import functions as F

from abx.operators import gram as G
from abx.operators import models as MD


def _coordinate_descent(X, y, a, r, iters=20000):
    """Reference solver for 1/(2n)|y - b - Xw|^2 + a r |w|_1 + a (1 - r)/2 |w|^2."""
    n, p = X.shape
    xm, ym = X.mean(0), y.mean()
    Xc, res = X - xm, y - ym
    w = np.zeros(p)
    sq = (Xc ** 2).sum(0)
    for _ in range(iters):
        step = 0.0
        for j in range(p):
            rho = Xc[:, j] @ res + sq[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - n * a * r, 0) / (sq[j] + n * a * (1 - r))
            res -= Xc[:, j] * (new - w[j])
            step = max(step, abs(new - w[j]))
            w[j] = new
        if step < 1e-13:
            break
    return ym - xm @ w, w


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(0, 1, (400, 4)) * [1, 3, 0.5, 2]
    y = 3 + X @ [1.5, -2, 0.3, 0] + rng.normal(0, 5, 400)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)],
                               ["x0", "x1", "x2", "x3", "label"])
    return X, y, df


@pytest.mark.parametrize("a,r", [(0.05, 0.05), (0.5, 0.5), (1.0, 0.9)])
def test_elastic_net_matches_coordinate_descent(data, a, r):
    X, y, df = data
    feats = ["x0", "x1", "x2", "x3"]
    m = MD.fit_linear(df, feats, params=MD.ElasticNet(a, r, max_iter=2000, tol=1e-12))
    b0, w = _coordinate_descent(X, y, a, r)
    got = np.r_[m.intercept, m.coefficients.toArray()]
    assert np.max(np.abs(got - np.r_[b0, w])) < 1e-5


def test_score_by_group_routes_and_rejects(spark):
    df = spark.createDataFrame([(1, "control", 2.0), (2, "treatment", 2.0), (3, "holdout", 2.0), (4, None, 1.0)],
                               "user_id long, group string, x double")
    models = {"control": [("intercept", 1.0), ("x", 10.0)], "treatment": [("intercept", -1.0), ("x", 0.5)]}
    scored, rejected = MD.score_by_group(df, models)
    got = {r.user_id: r.prediction for r in scored.collect()}
    assert got == {1: 21.0, 2: 0.0}
    assert sorted(r.user_id for r in rejected.collect()) == [3, 4]


def test_fit_metrics(spark):
    rows = [(1.0, 1.5), (2.0, 1.0), (3.0, 3.5), (4.0, 4.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    r = MD.fit_metrics(df).first()
    y, p = np.array(rows).T
    assert r.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert r.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_model_table_keys_and_onehot(spark):
    from conftest import SF001
    from abx.sources import fixtures as FX
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    t = MD.model_table(ev, FX.users(spark, SF001))
    assert t.groupBy("user_id", "date").count().filter("count > 1").count() == 0
    seg = [c for c in t.columns if c.startswith("segment_")]
    assert seg and t.select(sum(F.col(c) for c in seg).alias("s")).distinct().collect()[0].s == 1.0


# --- models from sums of feature pairs, kept as tables -----------------------

SPARSE = "id long, label double, features array<struct<feature:string,value:double>>"


@pytest.mark.parametrize("a,r", [(0.05, 0.05), (0.5, 0.5), (1.0, 0.9), (0.0, 0.0)])
def test_net_from_sums_matches_coordinate_descent(spark, data, a, r):
    X, y, df = data
    names = ["x0", "x1", "x2", "x3"]
    rows = df.select("label", G.sparse_features(names).alias("features")).repartition(3)
    got = {x.feature: x.coefficient for x in G.fit(rows, {"m": MD.ElasticNet(a, r, 20_000, 1e-13)}).collect()}
    b0, w = _coordinate_descent(X, y, a, r)
    assert got.pop(G.INTERCEPT) == pytest.approx(b0, abs=1e-8)
    assert [got[n] for n in names] == pytest.approx(list(w), abs=1e-8)


def test_many_models_and_penalties_from_one_pass(spark):
    rng = np.random.default_rng(4)
    rows = []
    for m in range(30):
        x = rng.integers(0, 3, (40, 3))
        rows += [(f"m{m}", float(2 + m * r[0] - r[1] + rng.normal()), [(n, float(v)) for n, v in zip("abc", r) if v]) for r in x]
    rows += [("m0", None, [("a", 1.0)]), ("lone", 5.0, []), ("m1", 1.0, [])]
    df = spark.createDataFrame(rows, "model string, label double, features array<struct<feature:string,value:double>>")
    nets = {"p": MD.ElasticNet(0.01, 0.5, 20_000, 1e-13), "q": MD.ElasticNet(0.5, 0.1, 20_000, 1e-13)}
    got = {}
    for x in G.fit(df, nets, model="model").collect():
        got.setdefault(x.model, {})[x.feature] = x.coefficient
    assert len(got) == 2 * 31 and got["lone/p"] == {G.INTERCEPT: 5.0}
    for m in (0, 1, 17):
        mine = [(dict(f), y) for k, y, f in rows if k == f"m{m}" and y is not None]
        X = np.array([[f.get(n, 0.0) for n in "abc"] for f, _ in mine])
        for name, p in nets.items():
            b0, w = _coordinate_descent(X, np.array([y for _, y in mine]), p.alpha, p.l1_ratio)
            mine_got = got[f"m{m}/{name}"]
            assert [mine_got[G.INTERCEPT], *(mine_got[n] for n in "abc")] == pytest.approx([b0, *w], abs=1e-7)
    # One aggregation whatever the number of models and penalties; partial before the shuffle.
    plan = G.gram(df, model="model")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_too_many_features_is_an_error(spark):
    df = spark.createDataFrame([(1.0, [(f"f{i}", 1.0) for i in range(12)])], "label double, features array<struct<feature:string,value:double>>")
    with pytest.raises(Exception, match="12 features, more than 10"):
        G.solve(G.gram(df), {"p": MD.ElasticNet()}, max_features=10).collect()


def test_long_features_gather_to_rows(spark):
    from abx.operators.features import one_hot_long
    df = spark.createDataFrame([("a", "x y", "u"), ("b", None, "v (w)"), ("c", None, None)], "listing_id string, k string, l string")
    got = {r.listing_id: sorted(map(tuple, r.features)) for r in G.gather_features(one_hot_long(df, "listing_id", ["k", "l"]), ["listing_id"]).collect()}
    direct = {r.listing_id: sorted(map(tuple, r.f)) for r in df.select("listing_id", G.sparse_features([], ["k", "l"]).alias("f")).collect()}
    assert got == {"a": [("k_xy", 1.0), ("l_u", 1.0)], "b": [("l_v-w", 1.0)]}
    assert direct == {**got, "c": []}


def test_score_and_rejects_by_table(spark):
    rows = [(1, "m", [("x", 2.0)]), (2, "n", [("x", 2.0), ("new", 9.0)]), (3, "other", [("x", 1.0)]), (4, None, []), (5, "m", []), (6, "n", [])]
    df = spark.createDataFrame(rows, "id long, model string, features array<struct<feature:string,value:double>>")
    coefs = spark.createDataFrame([("m", G.INTERCEPT, 1.0), ("m", "x", 10.0), ("n", G.INTERCEPT, -1.0), ("n", "x", 0.5)], G.COEFFICIENTS)
    got = {r.id: r.prediction for r in G.score(df, coefs, ["id"], "model").collect()}
    assert got == {1: 21.0, 2: 0.0, 5: 1.0, 6: -1.0}
    assert sorted(r.id for r in G.rejects(df, coefs, "model").collect()) == [3, 4]


def test_optimality_finds_a_wrong_coefficient(spark, data):
    _, _, df = data
    features = df.select("label", G.sparse_features(["x0", "x1", "x2", "x3"])).collect()
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(features)], SPARSE)
    nets = {"a": MD.ElasticNet(0.5, 0.9, 20_000, 1e-13), "b": MD.ElasticNet(0.05, 0.05, 20_000, 1e-13)}
    models = G.fit(rows, nets)
    good = G.optimality(rows, models, nets, ["id"]).collect()
    assert len(good) == 10 and max(r.violation for r in good) < 1e-8
    bent = models.withColumn("coefficient", F.col("coefficient") + F.when(F.col("feature") == "x1", 0.01).otherwise(0.0))
    bad = {(r.model, r.feature): r.violation for r in G.optimality(rows, bent, nets, ["id"]).collect()}
    assert bad["a", "x1"] > 0.01 and bad["b", "x1"] > 0.01


def test_rows_are_dealt_by_count_before_they_are_sorted_by_key(spark):
    """However the files are split, a task sorts a bounded number of rows by key."""
    rows = spark.range(0, 100, 1, 1).select("id", F.lit(1.0).alias("label"), G.sparse_features(["id"]).alias("features"))
    found = G.dealt(rows, ["id"], 30)
    assert found.rdd.getNumPartitions() == 4 and max(map(len, found.rdd.glom().collect())) < 60
    assert G.dealt(rows.where("id < 0"), ["id"], 30).rdd.getNumPartitions() == 1
    assert sorted(r.id for r in found.collect()) == list(range(100))
    nets = {"a": MD.ElasticNet(), "b": MD.ElasticNet(0.5, 0.5)}
    coefs = spark.createDataFrame([(m, f, 0.5) for m in nets for f in (G.INTERCEPT, "id")], G.COEFFICIENTS)
    plan = G.optimality(rows, F.broadcast(coefs), nets, ["id"])._jdf.queryExecution().executedPlan().toString()
    scored, scan = plan.split("REPARTITION_BY_NUM")        # one pass over the rows, and they are dealt first
    assert "SortAggregate" in scored and "posexplode" in scored
    assert "Sort" not in scan.split("BroadcastExchange")[0] and "Aggregate" not in scan.split("BroadcastExchange")[0]
    assert "hashpartitioning(id" not in scored


def test_optimality_of_repeated_null_and_unlabelled_keys(spark):
    """Rows of one key count as one row that holds the first one's label and features and all their products."""
    rows = [(1, 5.0, [("x", 2.0)])] * 3 + [(None, 4.0, [("x", 1.0), ("new", 7.0)]), (2, None, [("x", 9.0)]), (3, 1.0, [])]
    coef = {G.INTERCEPT: 0.5, "x": 0.25}
    nets = {"a": MD.ElasticNet(0.4, 0.5)}
    models = spark.createDataFrame([("a", f, c) for f, c in coef.items()], G.COEFFICIENTS)
    got = {r.feature: (r.rows, r.violation) for r in G.optimality(spark.createDataFrame(rows, SPARSE), models, nets, ["id"]).collect()}
    residual = {1: 5.0 - 3 * (0.5 + 2 * 0.25), None: 4.0 - (0.5 + 0.25), 3: 1.0 - 0.5}     # of key 2 there is none
    ones, x = sum(residual.values()) / 4, (2.0 * residual[1] + residual[None]) / 4
    assert got == {G.INTERCEPT: (4, pytest.approx(abs(ones))), "x": (3, pytest.approx(abs(x - 0.2 * 0.25 - 0.2)))}


def test_score_carries_the_first_row_and_needs_no_constant(spark):
    """Carried columns come with the row, whether the model has a constant or not; rows without a known feature are left out."""
    rows = [(1, "m", 3.0, [("x", 2.0), ("y", 1.0)]), (2, "m", None, [("x", 1.0)]), (3, "m", 4.0, [("y", 1.0)]), (4, "m", 5.0, None),
            (None, "m", 6.0, [("x", 3.0)])]
    df = spark.createDataFrame(rows, "id long, model string, label double, features array<struct<feature:string,value:double>>")
    coefs = spark.createDataFrame([("m", "x", 10.0)], G.COEFFICIENTS)
    got = {r.id: (r.label, r.features and len(r.features), r.prediction) for r in G.score(df, coefs, ["id"], "model", carry=["label", "features"]).collect()}
    assert got == {1: (3.0, 2, 20.0), 2: (None, 1, 10.0), None: (6.0, 1, 30.0)}


def test_metrics_by_model(spark):
    df = spark.createDataFrame([("a", 1.0, 1.5), ("a", 2.0, 1.0), ("a", 3.0, 3.5), ("b", 4.0, 4.0)], "model string, label double, prediction double")
    got = {r.model: r for r in G.metrics_by_model(df).collect()}
    y, p = np.array([1.0, 2.0, 3.0]), np.array([1.5, 1.0, 3.5])
    assert got["a"].rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2))) and got["a"].n == 3
    assert got["a"].r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)) and got["b"].r2 is None
