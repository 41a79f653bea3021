"""Model table, elastic-net regression, fit quality and scoring by group.

Fitting uses Spark ML (with up to 4,096 features its solver
forms the normal equations in one distributed pass; the training set is not collected). Scoring a linear model is one native dot product over the
feature columns with the (small, fixed-size) coefficients inlined, so it
runs in whole-stage codegen, in batch or on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.operators.features import levels, one_hot

EVENT_TYPES = ("view", "click", "purchase", "signup", "error")


def model_table(events: DataFrame, users: DataFrame, event_types: Sequence[str] = EVENT_TYPES,
                segment_levels: Sequence[str] | None = None) -> DataFrame:
    """Key (user_id, date); label = sum of event values; features = events per
    type and a one-hot of the user's segment. Levels not given are read from ``users``,
    the dimension table, never from the events."""
    day = events.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.sum("value").alias("label"),
        *[F.count_if(F.col("event_type") == t).cast("double").alias(f"n_{t}") for t in event_types])
    x = day.join(users.select("user_id", "segment"), "user_id", "left")
    found = list(segment_levels) if segment_levels is not None else levels(users, "segment")
    return one_hot(x, {"segment": found})


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("user_id", "date", "label", "group",
                                                             "experiment_id")) -> list[str]:
    return [c for c in df.columns if c not in exclude]


@dataclass(frozen=True)
class ElasticNet:
    """Penalty as 1/(2n)|y - Xw|^2 + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2."""
    alpha: float = 0.05
    l1_ratio: float = 0.05
    max_iter: int = 500
    tol: float = 1e-10


def spark_params(p: ElasticNet, label_std: float) -> tuple[float, float]:
    """Spark scales the label by its standard deviation before penalising;
    these (regParam, elasticNetParam) give the same optimum as the penalty above."""
    l1 = p.alpha * p.l1_ratio
    l2 = p.alpha * (1.0 - p.l1_ratio) * label_std
    reg = l1 + l2
    return reg, (l1 / reg if reg > 0 else 0.0)


def fit_linear(df: DataFrame, features: Sequence[str], label: str = "label",
               params: ElasticNet = ElasticNet()):
    """Fit an elastic-net linear model; returns the Spark ML model."""
    # One summary value; Spark's internal label scaling matches the population deviation.
    label_std = df.agg(F.stddev_pop(label)).first()[0] or 0.0
    reg, enet = spark_params(params, label_std)
    va = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
    lr = LinearRegression(featuresCol="_features", labelCol=label, regParam=reg, elasticNetParam=enet,
                          standardization=False, maxIter=params.max_iter, tol=params.tol, fitIntercept=True)
    return lr.fit(va.transform(df))


def coefficients(model, features: Sequence[str]) -> list[tuple[str, float]]:
    return [("intercept", float(model.intercept))] + [
        (f, float(c)) for f, c in zip(features, model.coefficients.toArray())]


def linear_expr(coefs: Sequence[tuple[str, float]]) -> Column:
    """intercept + sum(coef * column), as one native expression."""
    expr = F.lit(0.0)
    for name, c in coefs:
        expr = expr + (F.lit(c) if name == "intercept" else F.lit(c) * F.col(f"`{name}`"))
    return expr


def fit_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rmse, mae, r2 and n in one aggregation."""
    err = F.col(label) - F.col(prediction)
    return scored.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(label))).alias("r2"),
        F.count(F.lit(1)).alias("n"))


def score_by_group(df: DataFrame, models: dict[str, Sequence[tuple[str, float]]],
                   group_col: str = "group") -> tuple[DataFrame, DataFrame]:
    """Each row scored by the model of its group (control -> one model,
    treatment -> the other). The group is not a feature. Rows with an unknown
    group are returned apart, not scored."""
    known = list(models)
    pred = None
    for g in known:
        e = linear_expr(models[g])
        pred = F.when(F.col(group_col) == g, e) if pred is None else pred.when(F.col(group_col) == g, e)
    ok = F.col(group_col).isin(known)
    scored = df.filter(ok).withColumn("prediction", pred)
    rejected = df.filter(~ok | F.col(group_col).isNull())
    return scored, rejected
