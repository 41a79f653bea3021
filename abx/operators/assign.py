"""Group assignment (control / treatment) for many experiments in one pass.

``assign``        hash threshold: stateless, no shuffle, same on batch and stream.
``assign_quota``  exactly floor(n * ratio) treated: counts per hash bucket, a cut
                  bucket per experiment, and a ranking inside that bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abx.config import Experiment
from abx.functions.columns import TWO_POW_32, hash_unit

CONTROL, TREATMENT = "control", "treatment"
ASSIGNMENT_COLUMNS = ["user_id", "group", "experiment_id", "experiment_ratio"]


def eligible(users: DataFrame, experiments: Sequence[Experiment], user_col: str = "user_id",
             keep: Sequence[str] = ()) -> DataFrame:
    """One row per (user, experiment the user is eligible for).

    The experiments are parameters, so each becomes a literal struct guarded by
    its population predicate; ``explode`` fans out in place (no join, no shuffle).
    """
    if not experiments:
        raise ValueError("no experiments given")
    options = [
        F.when(F.expr(e.population),
               F.struct(F.lit(e.experiment_id).alias("experiment_id"),
                        F.lit(float(e.ratio)).alias("experiment_ratio")))
        for e in experiments
    ]
    # A null id is no user: hashed, all such rows would fall into one group.
    x = users.where(F.col(user_col).isNotNull()).select(F.col(user_col).alias("user_id"), *keep, F.explode(F.array(*options)).alias("_e"))
    return x.filter(F.col("_e").isNotNull()).select(
        "user_id", *keep, F.col("_e.experiment_id").alias("experiment_id"),
        F.col("_e.experiment_ratio").alias("experiment_ratio"))


def group_by_hash(unit: Column, ratio: Column) -> Column:
    """treatment when the 32-bit unit falls below ratio * 2^32."""
    return F.when(unit < ratio * F.lit(TWO_POW_32), F.lit(TREATMENT)).otherwise(F.lit(CONTROL))


def assign(users: DataFrame, experiments: Sequence[Experiment], user_col: str = "user_id",
           salt: str | None = None) -> DataFrame:
    """user_id, group, experiment_id, experiment_ratio for every eligible user.

    The group is a pure function of (experiment_id, user_id): md5 of 'exp|user',
    first 32 bits, compared with ratio * 2^32. ``salt`` re-draws (A/A checks).
    """
    x = eligible(users, experiments, user_col)
    parts = [F.col("experiment_id")] + ([F.lit(salt)] if salt else []) + [F.col("user_id")]
    return x.select("user_id", group_by_hash(hash_unit(*parts), F.col("experiment_ratio")).alias("group"),
                    "experiment_id", "experiment_ratio")


def assign_quota(users: DataFrame, experiments: Sequence[Experiment], user_col: str = "user_id",
                 bucket_bits: int = 16) -> DataFrame:
    """Exactly floor(n * ratio) treated users per experiment: those first in (hash, user_id).

    No global sort: users are counted per hash bucket (2^bucket_bits buckets, a
    bounded table per experiment), a running sum over that table finds the bucket
    where the quota is crossed, and only rows of that bucket (about n / 2^bits)
    are ranked. Users must be unique per experiment.
    """
    shift = 32 - bucket_bits
    base = eligible(users, experiments, user_col).withColumn(
        "_h", hash_unit(F.col("experiment_id"), F.col("user_id"))
    ).withColumn("_b", F.shiftright(F.col("_h"), shift))

    counts = base.groupBy("experiment_id", "experiment_ratio", "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    upto = Window.partitionBy("experiment_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("experiment_id")
    cuts = (counts
            .withColumn("_cum", F.sum("_cnt").over(upto))
            .withColumn("_quota", F.floor(F.sum("_cnt").over(whole) * F.col("experiment_ratio")))
            .filter((F.col("_cum") - F.col("_cnt") < F.col("_quota")) & (F.col("_cum") >= F.col("_quota")))
            .select("experiment_id", F.col("_b").alias("_cut"),
                    (F.col("_quota") - (F.col("_cum") - F.col("_cnt"))).alias("_left")))
    # One row per experiment at most: a bounded broadcast.
    joined = base.join(F.broadcast(cuts), "experiment_id", "left")

    outside = joined.filter(F.col("_cut").isNull() | (F.col("_b") != F.col("_cut"))).withColumn(
        "group", F.when(F.col("_b") < F.col("_cut"), F.lit(TREATMENT)).otherwise(F.lit(CONTROL)))
    rank_in_cut = Window.partitionBy("experiment_id").orderBy("_h", "user_id")
    inside = joined.filter(F.col("_b") == F.col("_cut")).withColumn(
        "group", F.when(F.row_number().over(rank_in_cut) <= F.col("_left"), F.lit(TREATMENT))
        .otherwise(F.lit(CONTROL)))
    return outside.select(*ASSIGNMENT_COLUMNS).unionByName(inside.select(*ASSIGNMENT_COLUMNS))
