"""Active rate and engaged duration by day, week and month, per group.

A user's active days are bits: one row per user, made by one fold of the log, whatever
the number of periods or experiments. A period is a mask over the same bits, so a
user's activity in a day, week or month is a test, and users are counted, never
told apart by a distinct aggregation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.config import Experiment
from abx.operators.metrics import group_counts
from abx.sources.tables import rows_to_frame

PERIODS = ("day", "week", "month")
WORD = 62           # days a long holds: its sign stays free
PERIOD_BITS = T.StructType([
    T.StructField("experiment_id", T.StringType(), False), T.StructField("period", T.StringType(), False),
    T.StructField("period_start", T.DateType(), False), T.StructField("mask", T.ArrayType(T.LongType(), False), False)])


def words(first: dt.date, last: dt.date) -> int:
    """Longs that the days from ``first`` to ``last`` take."""
    return (last - first).days // WORD + 1


def activity_bits(rows: DataFrame, first: dt.date, last: dt.date, keys: Sequence[str] = ("user_id",), date_col: str = "date") -> DataFrame:
    """``keys`` and ``days``: the days from ``first`` to ``last`` that have a row, as bits in an array of
    longs. Partial results are merged before the shuffle; days outside are left out."""
    day = F.datediff(F.col(date_col), F.lit(first))
    inside = rows.where(F.col(date_col).between(F.lit(first), F.lit(last)))
    bits = [F.coalesce(F.bit_or(F.when((day >= k * WORD) & (day < (k + 1) * WORD), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(WORD))))),
                        F.lit(0).cast("long")) for k in range(words(first, last))]
    return inside.groupBy(*keys).agg(F.array(*bits).alias("days"))


def merge_bits(rows: DataFrame, n_words: int, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """Bits of the same first day, from separate parts of the log, as one row per key."""
    return rows.groupBy(*keys).agg(F.array(*[F.bit_or(F.col("days")[k]) for k in range(n_words)]).alias("days"))


def active_in(days: Column, mask: Column) -> Column:
    """Whether a day of ``mask`` is among ``days``."""
    return F.exists(F.zip_with(days, mask, lambda a, b: a.bitwiseAND(b)), lambda x: x != 0)


def _start(period: str, day: dt.date) -> dt.date:
    return {"day": day, "week": day - dt.timedelta(days=day.weekday()), "month": day.replace(day=1)}[period]


def period_bits(spark: SparkSession, experiments: Sequence[Experiment], first: dt.date, last: dt.date,
                periods: Sequence[str] = PERIODS) -> DataFrame:
    """(experiment_id, period, period_start, mask): each period that holds a day of an experiment, with
    those of its days that the experiment's pre-period and treatment days include."""
    masks: dict[tuple, list[int]] = {}
    for e in experiments:
        day = e.start_date - dt.timedelta(days=e.pre_days)
        while day <= e.end_date:
            at = (day - first).days
            for p in periods:
                masks.setdefault((e.experiment_id, p, _start(p, day)), [0] * words(first, last))[at // WORD] |= 1 << at % WORD
            day += dt.timedelta(days=1)
    return rows_to_frame(spark, [(*k, m) for k, m in masks.items()], PERIOD_BITS)


def active_rate(activity: DataFrame, assignments: DataFrame, periods: DataFrame) -> DataFrame:
    """Active users (at least one event in the period) over assigned users, per (experiment_id, group,
    period, period_start); 0 in periods without activity.

    ``activity`` holds each user's days (``activity_bits``), ``periods`` the masks (``period_bits``), in
    number experiments x days. Each assigned user meets its experiment's masks as one array;
    what is counted is the periods that pass, summed before the shuffle.
    """
    per = periods.groupBy("experiment_id").agg(F.collect_list(F.struct("period", "period_start", "mask")).alias("_periods"))
    users = activity.join(assignments.select("user_id", "experiment_id", "group"), "user_id")
    x = users.join(F.broadcast(per), "experiment_id")         # one row an experiment
    hits = x.select("experiment_id", "group", F.explode(F.transform(
        F.filter("_periods", lambda p: active_in(F.col("days"), p["mask"])),
        lambda p: F.struct(p["period"].alias("period"), p["period_start"].alias("period_start")))).alias("p"))
    counted = hits.groupBy("experiment_id", "group", "p").agg(F.count(F.lit(1)).alias("active_users"))
    out = _complete(counted.select("experiment_id", "group", "p.*", "active_users"), assignments, periods, ["active_users"])
    return out.withColumn("active_rate", F.col("active_users") / F.col("total_users"))


def _complete(rows: DataFrame, assignments: DataFrame, periods: DataFrame, zero: Sequence[str]) -> DataFrame:
    """A row for each period of each experiment and group that has users, with the group's assigned users."""
    n = group_counts(assignments).withColumnRenamed("count", "total_users")      # two rows an experiment
    frame = periods.select("experiment_id", "period", "period_start").join(F.broadcast(n), "experiment_id")
    keys = ["experiment_id", "group", "period", "period_start"]
    return (frame.join(F.broadcast(rows), keys, "left")                          # both: experiments x days x 2
            .select(*keys, *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in zero], "total_users"))


def average_duration(days: DataFrame, assignments: DataFrame, periods: DataFrame) -> DataFrame:
    """Engaged seconds per assigned user, per (experiment_id, group, period,
    period_start); 0 in periods without sessions. ``days`` holds sessions and
    duration_us per (experiment_id, group, user_id, date); a session counts in the
    period where it starts.

    Rows are folded by day; weeks and months add up days. A user counts once in each through its first day there.
    """
    before = F.lag("date").over(Window.partitionBy("user_id", "experiment_id").orderBy("date"))
    marked = days.withColumn("_before", before)
    by_day = marked.groupBy("experiment_id", "group", "date").agg(
        F.sum("sessions").alias("sessions"), F.sum("duration_us").alias("duration_us"), F.count(F.lit(1)).alias("day"),
        *[F.count_if(F.col("_before").isNull() | (F.date_trunc(p, F.col("_before")) != F.date_trunc(p, F.col("date")))).alias(p)
          for p in ("week", "month")])
    spans = F.array(*[F.struct(F.lit(p).alias("period"), (F.col("date") if p == "day" else F.date_trunc(p, F.col("date")).cast("date")).alias("period_start"),
                               F.col(p).alias("active")) for p in PERIODS])
    agg = (by_day.select("experiment_id", "group", "sessions", "duration_us", F.inline(spans))
           .groupBy("experiment_id", "group", "period", "period_start")
           .agg(F.sum("sessions").alias("sessions"), F.sum("duration_us").alias("total_duration_us"), F.sum("active").alias("active_users")))
    out = _complete(agg, assignments, periods, ["sessions", "total_duration_us", "active_users"])
    out = out.withColumn("total_duration_sec", F.col("total_duration_us") / F.lit(1e6))
    return out.withColumn("avg_duration_sec", F.col("total_duration_us") / F.col("total_users") / F.lit(1e6))
