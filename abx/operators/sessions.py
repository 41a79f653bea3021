"""Engaged time: gap sessions without a per-user sort of raw events.

A session ends when the next event of the user is more than ``gap`` later
(the same rule as ``session_window``). Events are first folded into
(user, slot) summaries, slot = floor(t / gap): inside one slot consecutive
events are less than ``gap`` apart, so a session can only break between
occupied slots. The per-user ordering then runs over slot summaries,
whose number is bounded by time span / gap, not by event volume; a user
with a third of all events is folded by partial aggregation like any other.

``day_summaries`` keeps of each user's day only what later days can still change: its first and
its last session, and the sum of all. Summaries of separate stretches of the log
(days, or parts of them) are stored side by side; ``finish_days`` joins sessions across
their edges, so a new day of log is added without reading the old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessions(log: DataFrame, gap_seconds: int = 1800, time_col: str = "event_time",
             user_col: str = "user_id") -> DataFrame:
    """One row per session: user_id, session_start, session_end (timestamps of
    first and last event), duration_us (exact microseconds), events."""
    gap_us = int(gap_seconds) * 1_000_000
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    slots = (log.select(F.col(user_col).alias("user_id"), us.alias("_us"))
             .groupBy("user_id", F.floor(F.col("_us") / F.lit(gap_us)).alias("_slot"))
             .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy("user_id").orderBy("_slot")
    prev_last = F.lag("_last").over(w)
    slots = slots.withColumn("_new", F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap_us), 1)
                             .otherwise(0))
    slots = slots.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    s = slots.groupBy("user_id", "_sid").agg(
        F.min("_first").alias("_s"), F.max("_last").alias("_e"), F.sum("_n").alias("events"))
    return s.select(
        "user_id",
        F.timestamp_micros("_s").alias("session_start"),
        F.timestamp_micros("_e").alias("session_end"),
        (F.col("_e") - F.col("_s")).alias("duration_us"),
        "events")


def user_day_duration(log: DataFrame, gap_seconds: int = 1800, time_col: str = "event_time") -> DataFrame:
    """Per (user_id, date of session start): sessions and engaged microseconds."""
    s = sessions(log, gap_seconds, time_col)
    return s.groupBy("user_id", F.to_date("session_start").alias("date")).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("duration_us").alias("duration_us"))


def day_summaries(log: DataFrame, gap_seconds: int = 1800, time_col: str = "event_time", user_col: str = "user_id") -> DataFrame:
    """Per (user_id, date): start and end of the first and the last session of the day (microseconds), how
    many there are, and their total. Sessions are cut at midnight here; ``finish_days`` mends that.

    ``log`` may be any stretch of time: summaries of stretches that do not overlap in
    time are united by name.
    """
    gap_us = int(gap_seconds) * 1_000_000
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    slots = (log.where(F.col(user_col).isNotNull() & F.col(time_col).isNotNull())
             .select(F.col(user_col).alias("user_id"), us.alias("_us"))
             .groupBy("user_id", F.floor(F.col("_us") / F.lit(gap_us)).alias("_slot"), _day("_us").alias("date"))
             .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last")))
    day = Window.partitionBy("user_id", "date").orderBy("_first")
    prev = F.lag("_last").over(day)
    x = slots.withColumn("_prev", prev)
    new = F.col("_prev").isNull() | (F.col("_first") - F.col("_prev") > gap_us)
    # A slot that starts a session closes the one before it, whose end is the slot before.
    closing = F.when(F.col("_prev").isNotNull() & (F.col("_first") - F.col("_prev") > gap_us), F.col("_prev"))
    return x.groupBy("user_id", "date").agg(
        F.min("_first").alias("first_start"),
        F.coalesce(F.min(closing), F.max("_last")).alias("first_end"),
        F.max(F.when(new, F.col("_first"))).alias("last_start"),
        F.max("_last").alias("last_end"),
        F.count_if(new).alias("sessions"),
        F.sum((F.col("_last") - F.col("_first")) + F.when(new, F.lit(0)).otherwise(F.col("_first") - F.col("_prev"))).alias("duration_us"))


def _day(us: str):
    return F.to_date(F.timestamp_micros(us))


def finish_days(summaries: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Per (user_id, date of session start): sessions and engaged microseconds, from summaries of
    stretches that do not overlap in time. Only first and last sessions are put in
    order, two rows a stretch at most; one that starts within the gap of the one before goes on with it.
    """
    gap_us = int(gap_seconds) * 1_000_000
    f0, f1, l0, l1 = (F.col(c) for c in ("first_start", "first_end", "last_start", "last_end"))
    one = F.col("sessions") == 1
    edges = F.array_compact(F.array(F.struct(f0.alias("s"), F.when(one, l1).otherwise(f1).alias("e"), F.lit(True).alias("head")),
                                    F.when(~one, F.struct(l0.alias("s"), l1.alias("e"), F.lit(False).alias("head")))))
    inner = F.col("duration_us") - (f1 - f0) - (l1 - l0)
    x = summaries.select("user_id", "date", F.when(one, F.lit(0)).otherwise(F.col("sessions") - 2).alias("_n"),
                         F.when(one, F.lit(0)).otherwise(inner).alias("_us"), F.inline(edges))
    user = Window.partitionBy("user_id").orderBy("s")
    x = x.withColumn("_prev", F.lag("e").over(user))
    new = F.col("_prev").isNull() | (F.col("s") - F.col("_prev") > gap_us)
    x = x.withColumn("_new", new).withColumn(
        "_start", F.last(F.when(new, F.col("s")), ignorenulls=True).over(user.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.struct(_day("_start").alias("date"), F.col("_new").cast("long").alias("sessions"),
                   (F.col("e") - F.col("s") + F.when(F.col("_new"), F.lit(0)).otherwise(F.col("s") - F.col("_prev"))).alias("duration_us"))
    middle = F.when(F.col("head") & (F.col("_n") > 0), F.struct(F.col("date"), F.col("_n").cast("long").alias("sessions"), F.col("_us").alias("duration_us")))
    parts = x.select("user_id", F.inline(F.array_compact(F.array(own, middle))))
    return parts.groupBy("user_id", "date").agg(F.sum("sessions").alias("sessions"), F.sum("duration_us").alias("duration_us"))
