"""Data checks and keys: assignment consistency, key checks, summaries, dense ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abx.functions.columns import to_cents
from abx.session import checkpoint_dir


def assignment_conflicts(assignments: DataFrame) -> DataFrame:
    """Per experiment: rows, users, users found in both groups, users listed
    more than once. A consistent assignment has zeros in the last two."""
    per_user = assignments.groupBy("experiment_id", "user_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        (F.min("group") != F.max("group")).alias("_both"))
    return per_user.groupBy("experiment_id").agg(
        F.sum("_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("_both")).alias("users_in_both_groups"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_users"))


def conflicting_users(assignments: DataFrame) -> DataFrame:
    """The offending (experiment_id, user_id) rows, with their group count."""
    return assignments.groupBy("experiment_id", "user_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("group").alias("groups")
    ).filter((F.col("rows") > 1) | (F.col("groups") > 1))


def key_check(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct non-null keys, null keys, keys held more than once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").alias("n_rows"),
        F.count_if(F.col(key).isNotNull()).alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("duplicate_keys"))


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Raise unless ``key`` is non-null and unique (one small summary row is read)."""
    r = key_check(df, key).first()
    if r["null_keys"] or r["duplicate_keys"]:
        raise ValueError(f"key {key!r}: {r['null_keys']} null rows, {r['duplicate_keys']} duplicated keys")


def column_summary(df: DataFrame, columns: Sequence[str], cents: Sequence[str] = ()) -> DataFrame:
    """describe() in long form: column_name, count, mean, stddev, min, max.

    One aggregation over all columns; money columns (``cents``) get their
    mean from the whole-cent sum.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        s = F.sum(x)
        aggs += [F.count(c).alias(f"c{i}"), (to_cents(s) if c in cents else s).alias(f"s{i}"),
                 F.stddev_samp(x).alias(f"d{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs)
    items = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("count"),
                 F.try_divide(F.col(f"s{i}"), F.col(f"c{i}").cast("double")).alias("mean"),
                 F.col(f"d{i}").alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(columns)])
    return row.select(F.explode(items).alias("r")).select("r.*")


def dense_key(df: DataFrame, order_by: Sequence[str], name: str = "key") -> DataFrame:
    """Dense 0..n-1 ids in ``order_by`` order (which must be a total order).

    Range-partitioned sort, then a reliable checkpoint (so the partitioning is
    fixed and survives lost executors), per-partition counts (one row per
    partition), their running offsets, and offset + position in partition.
    """
    checkpoint_dir(df.sparkSession)
    low_bits = (1 << 33) - 1
    ordered = df.orderBy(*order_by).withColumn("_mid", F.monotonically_increasing_id())
    fixed = ordered.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    sizes = fixed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded table, ordered in a single task.
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_p", "_off")
    out = fixed.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    key = F.col("_off") + F.col("_mid").bitwiseAND(F.lit(low_bits))
    return out.select(key.alias(name), *df.columns)


def stable_key(*cols) -> F.Column:
    """A stable (not dense) 64-bit key from natural columns."""
    return F.xxhash64(*cols)
