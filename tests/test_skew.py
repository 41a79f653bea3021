"""A user holding a third of all rows must not change results (and is folded by
partial aggregation, never sorted whole)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from abx.operators.metrics import user_day_metrics
from abx.operators.sessions import sessions


@pytest.fixture(scope="module")
def hot_log(spark):
    # 30,000 events: user 0 has 10,000 (a third), spread over two days with gaps;
    # 2,000 other users have 10 each.
    base = dt.datetime(2024, 1, 1)
    hot = spark.range(10000).select(
        F.lit(0).cast("long").alias("user_id"), (F.col("id") % 50).cast("string").alias("listing_id"),
        (F.lit(base) + F.make_dt_interval(secs=(F.col("id") * 17 % 172800).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("event_time"),
        F.when(F.col("id") % 10 == 0, "purchase").otherwise("view").alias("activity"),
        F.when(F.col("id") % 10 == 0, F.lit(1.5)).alias("purchase_amount"))
    cold = spark.range(20000).select(
        (F.col("id") % 2000 + 1).alias("user_id"), (F.col("id") % 7).cast("string").alias("listing_id"),
        (F.lit(base) + F.make_dt_interval(secs=(F.col("id") * 101 % 172800).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("event_time"),
        F.lit("view").alias("activity"), F.lit(None).cast("double").alias("purchase_amount"))
    return hot.unionByName(cold).repartition(6)


def test_hot_user_day_metrics(spark, hot_log):
    out = {(r.user_id, r.date): r for r in user_day_metrics(hot_log).filter("user_id = 0").collect()}
    want = (hot_log.filter("user_id = 0").groupBy(F.to_date("event_time").alias("d"))
            .agg(F.count("*").alias("n"), F.countDistinct("listing_id").alias("l")).collect())
    for w in want:
        r = out[(0, w.d)]
        assert r.total_events == w.n and r.total_listings == w.l


def test_hot_user_sessions_match_session_window(spark, hot_log):
    ours = sessions(hot_log).agg(F.count("*"), F.sum("events"), F.sum("duration_us")).first()
    b = hot_log.groupBy("user_id", F.session_window("event_time", "30 minutes")).agg(
        F.min("event_time").alias("a"), F.max("event_time").alias("z"), F.count("*").alias("n"))
    bb = b.agg(F.count("*"), F.sum("n"), F.sum(F.unix_micros(F.col("z").cast("timestamp"))
                                               - F.unix_micros(F.col("a").cast("timestamp")))).first()
    assert tuple(ours) == tuple(bb)


def test_session_slots_bounded_by_time_span(spark, hot_log):
    # The per-user window sees at most span / gap slot rows for the hot user (2 days / 30 min = 96).
    from abx.operators.sessions import sessions as s
    us = F.unix_micros(F.col("event_time").cast("timestamp"))
    slots = hot_log.filter("user_id = 0").select(F.floor(us / F.lit(1800 * 1_000_000)).alias("slot")).distinct()
    assert slots.count() <= 96
