"""Metric tables: user-day activity, exposure join, group-day totals, moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.config import DEFAULT_ACTIVITIES

CONTROL, TREATMENT = "control", "treatment"


def activity_column(activity: str) -> str:
    return f"total_{activity}s"


def user_day_metrics(log: DataFrame, activities: Sequence[str] = DEFAULT_ACTIVITIES,
                     time_col: str = "event_time") -> DataFrame:
    """One row per (user_id, date) with activity: distinct listings, a count per
    activity, all events, and the purchase total (null amounts count as 0).

    The day is the UTC calendar day of the event (a one-day tumbling bucket).
    Aggregation is partial before the shuffle, so a hot user costs no more than
    its number of distinct (day, listing) keys per partition.
    """
    amount = F.coalesce(F.col("purchase_amount"), F.lit(0.0))
    aggs = [F.count_distinct("listing_id").alias("total_listings")]
    aggs += [F.count_if(F.col("activity") == a).alias(activity_column(a)) for a in activities]
    aggs += [
        F.count(F.lit(1)).alias("total_events"),
        F.sum(F.when(F.col("activity") == "purchase", amount).otherwise(F.lit(0.0))).alias("total_purchase_amount"),
    ]
    return log.groupBy("user_id", F.to_date(F.col(time_col)).alias("date")).agg(*aggs)


def exposed_user_days(user_days: DataFrame, assignments: DataFrame) -> DataFrame:
    """User-day rows of assigned users, one per experiment the user is in.

    The log is aggregated before this join, so a user in k experiments
    multiplies user-days, not events. AQE picks broadcast or sort-merge.
    """
    a = assignments.select("user_id", "experiment_id", "group")
    return user_days.join(a, "user_id", "inner")


def user_day_filled(user_days: DataFrame, assignments: DataFrame, experiments: DataFrame,
                    columns: Sequence[str] = ("total_events", "total_purchase_amount")) -> DataFrame:
    """Every assigned user on every day of its experiment, zeros where inactive.

    A user's active days are gathered into one array (as long as the calendar at most), which meets the user's
    assignments; the days without activity are made in place. So users and active
    days move, never users x days, and nothing moves where both sides are stored by user.
    """
    zero = {c: F.lit(0).cast(user_days.schema[c].dataType) for c in columns}
    active = user_days.groupBy("user_id").agg(
        F.collect_list(F.struct("date", *[F.coalesce(F.col(c), zero[c]).alias(c) for c in columns])).alias("_active"))
    x = (assignments.select("user_id", "experiment_id", "group")
         .join(F.broadcast(experiments.select("experiment_id", "start_date", "end_date")), "experiment_id")
         .join(active, "user_id", "left"))
    inside = F.coalesce(F.filter("_active", lambda a: a["date"].between(F.col("start_date"), F.col("end_date"))), F.array())
    idle = F.array_except(F.sequence("start_date", "end_date"), F.transform(inside, lambda a: a["date"]))
    days = F.concat(inside, F.transform(idle, lambda d: F.struct(d.alias("date"), *[zero[c].alias(c) for c in columns])))
    return x.select("experiment_id", "user_id", "group", F.inline(days))


def group_counts(assignments: DataFrame) -> DataFrame:
    """Assigned users per (experiment_id, group)."""
    return assignments.groupBy("experiment_id", "group").agg(F.count(F.lit(1)).alias("count"))


def group_day_totals(exposed: DataFrame, metric: str = "total_purchase_amount") -> DataFrame:
    """Sum of the metric per (date, group, experiment_id) over exposed user-days."""
    return exposed.groupBy("date", "group", "experiment_id").agg(
        F.sum(metric).alias("total_amount"), F.count(F.lit(1)).alias("user_days"))


def conditional_moments(df: DataFrame, keys: Sequence[str], metric: str,
                        group_col: str = "group") -> DataFrame:
    """n, sum and sample variance of ``metric`` for control and treatment side by
    side, in one aggregation (constant state per key; nothing collected).
    """
    aggs = []
    for g, tag in ((CONTROL, "control"), (TREATMENT, "treatment")):
        on = F.col(group_col) == g
        aggs += [
            F.count_if(on).alias(f"n_{tag}"),
            F.sum(F.when(on, F.col(metric))).alias(f"sum_{tag}"),
            F.var_samp(F.when(on, F.col(metric))).alias(f"var_{tag}"),
        ]
    out = df.groupBy(*keys).agg(*aggs)
    for tag in ("control", "treatment"):
        out = out.withColumn(f"mean_{tag}", F.try_divide(F.col(f"sum_{tag}"), F.col(f"n_{tag}")))
    return out


def group_day_moments(exposed: DataFrame, metric: str = "total_purchase_amount",
                      nonzero: bool = True) -> DataFrame:
    """Per (experiment_id, date): moments of the metric by group.

    ``nonzero`` keeps only user-days where the metric is non-zero (buyers of
    the day), as the daily test does.
    """
    x = exposed.filter(F.col(metric) != 0) if nonzero else exposed
    return conditional_moments(x, ["experiment_id", "date"], metric)


def merge_zeros(n_active, sum_active, var_active, n_total):
    """Mean and sample variance after adding (n_total - n_active) zeros.

    Chan's pairwise update with a zero-variance block at 0: exact and stable,
    so inactive users never need to be materialised.
    """
    n1 = F.coalesce(n_active, F.lit(0)).cast("double")
    s1 = F.coalesce(sum_active, F.lit(0.0))
    m1 = F.coalesce(F.try_divide(s1, n1), F.lit(0.0))
    m2_1 = F.coalesce(var_active, F.lit(0.0)) * F.greatest(n1 - F.lit(1.0), F.lit(0.0))
    n = n_total.cast("double")
    n0 = n - n1
    mean = F.try_divide(s1, n)
    m2 = m2_1 + F.try_divide(n1 * n0 * m1 * m1, n)
    var = F.try_divide(m2, n - F.lit(1.0))
    return mean, var
