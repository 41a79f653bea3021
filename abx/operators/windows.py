"""Windows over group-day rows (experiments x days x 2: never user rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_calendar(experiments: DataFrame, pre: bool = True) -> DataFrame:
    """Every (experiment_id, group, date) of the experiments' periods: the pre-period days
    (with ``pre``) and the treatment days, for both groups. Days x 2 rows per experiment."""
    first = F.date_sub("start_date", F.col("pre_days")) if pre else F.col("start_date")
    return (experiments.select("experiment_id", F.explode(F.sequence(first, F.col("end_date"))).alias("date"))
            .select("experiment_id", F.explode(F.array(F.lit("control"), F.lit("treatment"))).alias("group"), "date"))


def complete_days(rows: DataFrame, calendar: DataFrame, zero: Sequence[str]) -> DataFrame:
    """``rows`` with one row for each row of ``calendar`` (its columns are the key), the
    columns in ``zero`` being 0 where nothing happened."""
    keys = calendar.columns
    out = calendar.join(rows, keys, "left")
    return out.select(*[F.coalesce(F.col(c), F.lit(0).cast(rows.schema[c].dataType)).alias(c) if c in zero else F.col(c)
                        for c in rows.columns])


def cumulative_by_group(totals: DataFrame, value: str = "total_amount",
                        out: str = "daily_cumulative_sum") -> DataFrame:
    """Running sum per (experiment_id, group) in date order."""
    w = (Window.partitionBy("experiment_id", "group").orderBy("date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return totals.withColumn(out, F.sum(value).over(w))


def experiment_day(totals: DataFrame, experiments: DataFrame) -> DataFrame:
    """Two day indexes per row:

    experiment_duration = rank() by date within (experiment, group) - pre_days
    (0 on the last pre day; with a row for every day it equals the calendar form);
    experiment_day = datediff(date, start_date) + 1 (calendar form).
    """
    e = F.broadcast(experiments.select("experiment_id", "start_date", "pre_days"))
    w = Window.partitionBy("experiment_id", "group").orderBy("date")
    x = totals.join(e, "experiment_id")
    x = x.withColumn("experiment_duration", (F.rank().over(w) - F.col("pre_days")).cast("int"))
    x = x.withColumn("experiment_day", (F.datediff(F.col("date"), F.col("start_date")) + 1).cast("int"))
    return x.drop("start_date", "pre_days")


def date_spine(log: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Calendar over the log's days: date, week_start_date (Monday), week_end_date.

    The bounds come from one global min/max (partial aggregation); the days
    are generated in place by ``explode(sequence)``.
    """
    b = log.agg(F.min(F.to_date(F.col(time_col))).alias("lo"), F.max(F.to_date(F.col(time_col))).alias("hi"))
    d = b.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    ws = F.date_trunc("week", F.col("date")).cast("date")
    return d.select("date", ws.alias("week_start_date"), F.date_add(ws, 6).alias("week_end_date"))
