"""Linear models from one aggregation, kept and applied as tables.

A training row holds its features in sparse form, ``array<struct<feature, value>>``. One
grouped sum over pairs of features, the constant and the label among them, gives X'X, X'y, the
sums and n of every model at once (partial sums before the shuffle, so what moves is
pairs of features, not rows). Elastic nets are then solved by coordinate descent on that matrix,
one task per model, for any number of penalties. Coefficients are rows
(model, feature, coefficient); scoring joins them to the features and sums, so
neither plan grows with features or models.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.functions.columns import clean_feature_column
from abx.operators.models import ElasticNet

# Names that stand for the constant and the label among the features.
INTERCEPT, LABEL = "(intercept)", "(label)"
COEFFICIENTS = "model string, feature string, coefficient double"
GRAM = "model string, i string, j string, s double"


def _pair(name: Column, value: Column) -> Column:
    return F.struct(name.alias("feature"), value.cast("double").alias("value"))


def sparse_features(numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> Column:
    """The non-zero features of a row: each numeric column by its name, and 1.0 for the level of each
    categorical one, named '<column>_<level>' as ``features.one_hot`` names it. Nulls have no feature."""
    parts = [F.when(F.col(c) != 0, _pair(F.lit(c), F.col(c))) for c in numeric]
    parts += [F.when(F.col(c).isNotNull(), _pair(clean_feature_column(F.concat(F.lit(f"{c}_"), F.col(c).cast("string"))), F.lit(1.0)))
              for c in categorical]
    return F.array_compact(F.array(*parts))


def gather_features(long: DataFrame, key: Sequence[str]) -> DataFrame:
    """Long features (key, feature, value) as one row per key with the array ``features``.
    A row's features are few by nature; one key is one training row."""
    return long.where(F.col("feature").isNotNull() & F.col("value").isNotNull()).groupBy(*key).agg(
        F.collect_list(F.struct("feature", F.col("value").cast("double").alias("value"))).alias("features"))


def gram(rows: DataFrame, label: str = "label", features: str = "features", model: str | None = None) -> DataFrame:
    """(model, i, j, s): sums of products of feature pairs i <= j over the rows of each model.
    Rows without a label are left out; a feature that a row names twice counts with its sum."""
    z = F.concat(F.array(_pair(F.lit(INTERCEPT), F.lit(1.0)), _pair(F.lit(LABEL), F.col(label))), F.col(features))
    x = rows.where(F.col(label).isNotNull()).select(
        (F.col(model).cast("string") if model else F.lit("all")).alias("model"), z.alias("z"))
    pairs = F.flatten(F.transform("z", lambda a: F.transform(
        F.filter("z", lambda b: b["feature"] >= a["feature"]),
        lambda b: F.struct(a["feature"].alias("i"), b["feature"].alias("j"), (a["value"] * b["value"]).alias("p")))))
    return (x.select("model", F.inline(pairs)).groupBy("model", "i", "j").agg(F.sum("p").alias("s")))


def coordinate_descent(c: np.ndarray, v: np.ndarray, p: ElasticNet) -> np.ndarray:
    """Minimum of w'Cw/2 - v'w + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2."""
    l1, l2 = p.alpha * p.l1_ratio, p.alpha * (1.0 - p.l1_ratio)
    w, g = np.zeros(len(v)), v.copy()
    size = np.sqrt(np.maximum(np.diag(c), 0.0))
    for _ in range(max(p.max_iter, 1)):
        moved = 0.0
        for j in range(len(v)):
            if c[j, j] + l2 <= 0.0:
                continue
            rho = g[j] + c[j, j] * w[j]
            step = np.sign(rho) * max(abs(rho) - l1, 0.0) / (c[j, j] + l2) - w[j]
            if step:
                w[j] += step
                g -= step * c[j]
                moved = max(moved, abs(step) * max(size[j], l2 ** 0.5))
        if moved <= p.tol:
            break
    return w


def solve(grams: DataFrame, penalties: Mapping[str, ElasticNet], max_features: int = 5000) -> DataFrame:
    """Coefficients (model, feature, coefficient) of each penalty from the same sums. With one model the
    penalty's name is the model's; with several it is '<model>/<penalty>' unless there is one
    penalty. A model's matrix is held by one task: more than ``max_features`` features are an error."""
    names = dict(penalties)

    def one(table: pa.Table) -> pa.Table:
        model = table["model"][0].as_py()
        at = {f: k for k, f in enumerate(sorted({*table["i"].to_pylist()} | {*table["j"].to_pylist()}))}
        if len(at) > max_features + 2:
            raise ValueError(f"model {model!r} has {len(at) - 2} features, more than {max_features}")
        s = np.zeros((len(at), len(at)))
        for i, j, x in zip(table["i"].to_pylist(), table["j"].to_pylist(), table["s"].to_pylist(), strict=True):
            s[at[i], at[j]] = s[at[j], at[i]] = x
        n = s[at[INTERCEPT], at[INTERCEPT]]
        mean = s[at[INTERCEPT]] / n
        c = s / n - np.outer(mean, mean)
        kept = [k for f, k in at.items() if f not in (INTERCEPT, LABEL)]
        feature_names = [f for f in at if f not in (INTERCEPT, LABEL)]
        out: list[tuple[str, str, float]] = []
        for name, p in names.items():
            w = coordinate_descent(c[np.ix_(kept, kept)], c[kept, at[LABEL]], p)
            called = name if model == "all" else model if len(names) == 1 else f"{model}/{name}"
            out.append((called, INTERCEPT, float(mean[at[LABEL]] - mean[kept] @ w)))
            out += [(called, f, float(x)) for f, x in zip(feature_names, w, strict=True)]
        return pa.table({"model": [o[0] for o in out], "feature": [o[1] for o in out], "coefficient": [o[2] for o in out]})

    return grams.groupBy("model").applyInArrow(one, COEFFICIENTS)


def fit(rows: DataFrame, penalties: Mapping[str, ElasticNet], label: str = "label", features: str = "features",
        model: str | None = None) -> DataFrame:
    """Coefficients of every penalty (and model) from one pass over ``rows``."""
    return solve(gram(rows, label, features, model), penalties)


def dealt(rows: DataFrame, key: Sequence[str], rows_a_task: int = 50_000) -> DataFrame:
    """``rows`` dealt by ``key`` over a number of tasks that grows with their count: what a task sorts or
    hashes by ``key`` has one size whatever the input and however its files are split."""
    return rows.repartition(max(1, -(-rows.count() // rows_a_task)), *key)


def score(rows: DataFrame, coefficients: DataFrame, key: Sequence[str], model: str, features: str = "features",
          carry: Sequence[str] = ()) -> DataFrame:
    """``key``, ``model``, ``carry`` and ``prediction`` of the rows whose model has coefficients.

    ``key`` names one row. Features without a coefficient add nothing. Spark broadcasts the
    coefficients where their measured size allows and shuffles by (model, feature) beyond;
    products are summed per row before they move. ``carry`` travels once a row, with its first
    pair, not with each. Rows that are ``dealt`` by ``key`` are summed where they lie.
    """
    pairs = F.concat(F.array(_pair(F.lit(INTERCEPT), F.lit(1.0))), F.col(features))
    x = rows.select(*key, model, *carry, F.posexplode(pairs).alias("_at", "_pair")).select(
        *key, model, *[F.when(F.col("_at") == 0, F.col(c)).alias(c) for c in carry], "_at", "_pair.feature", "_pair.value")
    known = coefficients.select(F.col("model").alias("_model"), F.col("feature").alias("_feature"), "coefficient")
    joined = x.join(known, (F.col(model) == F.col("_model")) & (F.col("feature") == F.col("_feature")), "left")
    found = joined.where((F.col("_at") == 0) | F.col("_feature").isNotNull())
    return (found.groupBy(*key, model)
            .agg(*[F.expr(f"first(`{c}`) FILTER (WHERE _at = 0)").alias(c) for c in carry],
                 F.sum(F.col("value") * F.col("coefficient")).alias("prediction"), F.count("_feature").alias("_known"))
            .where(F.col("_known") > 0).drop("_known"))


def rejects(rows: DataFrame, coefficients: DataFrame, model: str) -> DataFrame:
    """Rows whose model (null among them) has no coefficients."""
    models = coefficients.where(F.col("feature") == INTERCEPT).select(F.col("model").alias("_model"))
    return rows.join(models, F.col(model) == F.col("_model"), "left_anti")


def metrics_by_model(scored: DataFrame, model: str = "model", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rmse, mae, r2 and n of each model, in one aggregation."""
    err = F.col(label) - F.col(prediction)
    return scored.groupBy(model).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(label))).alias("r2"), F.count(F.lit(1)).alias("n"))


def optimality(rows: DataFrame, coefficients: DataFrame, penalties: Mapping[str, ElasticNet], key: Sequence[str],
               label: str = "label", features: str = "features") -> DataFrame:
    """How far each coefficient is from its optimality condition, judged on the rows, not on the matrix.

    With g the mean of x * residual, less alpha*(1-l1_ratio)*w: a coefficient that is not zero
    needs g = alpha*l1_ratio*sign(w), a zero one |g| <= alpha*l1_ratio, the intercept g = 0.
    Returns model, feature, rows (that hold the feature), coefficient, violation.
    """
    options = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(p.alpha * p.l1_ratio).alias("l1"),
                                 F.lit(p.alpha * (1.0 - p.l1_ratio)).alias("l2")) for m, p in penalties.items()])
    each = dealt(rows, key).select(*key, label, features, F.inline(options))
    scored = score(each, coefficients, [*key, "l1", "l2"], "model", features, carry=[label, features])
    pairs = F.concat(F.array(_pair(F.lit(INTERCEPT), F.lit(1.0))), F.col(features))
    x = scored.select("model", "l1", "l2", (F.col(label) - F.col("prediction")).alias("r"), F.inline(pairs))
    sums = x.groupBy("model", "feature").agg(F.sum(F.col("value") * F.col("r")).alias("xr"), F.count(F.lit(1)).alias("rows"),
                                             F.first("l1").alias("l1"), F.first("l2").alias("l2"))
    n = F.max(F.when(F.col("feature") == INTERCEPT, F.col("rows"))).over(Window.partitionBy("model"))  # sums: one row a feature
    w = F.col("coefficient")
    g = F.col("xr") / F.col("n")
    lone = g - F.col("l2") * w
    gap = (F.when(F.col("feature") == INTERCEPT, F.abs(g))
           .when(w == 0, F.greatest(F.abs(lone) - F.col("l1"), F.lit(0.0)))
           .otherwise(F.abs(lone - F.col("l1") * F.signum(w))))
    return (sums.withColumn("n", n).join(coefficients, ["model", "feature"])
            .select("model", "feature", "rows", "coefficient", gap.alias("violation")))


def user_day_rows(events: DataFrame, users: DataFrame, event_types: Sequence[str]) -> DataFrame:
    """Training rows (user_id, date, label, features): the sum of a user's event values on a day, against
    the events of each type and the user's segment."""
    day = events.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.sum("value").alias("label"), *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in event_types])
    x = day.join(users.select("user_id", "segment"), "user_id", "left")
    return x.select("user_id", "date", "label", sparse_features([f"n_{t}" for t in event_types], ["segment"]).alias("features"))
