import datetime as dt

import pytest
from pyspark.sql import functions as F

from abx.operators.sessions import sessions
from abx.sources import fixtures as FX

from conftest import SF01


def _brute(df, gap="30 minutes"):
    s = df.groupBy("user_id", F.session_window("event_time", gap)).agg(
        F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count("*").alias("n"))
    return sorted((r.user_id, r.a, r.b, r.n) for r in s.collect())


def test_gap_edges_match_session_window(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    rows = [(1, t0), (1, t0 + dt.timedelta(minutes=30)),                    # exactly the gap: same session
            (1, t0 + dt.timedelta(minutes=60, microseconds=1)),              # just over: new session
            (1, t0 + dt.timedelta(minutes=89)), (2, t0 + dt.timedelta(hours=5)),
            (2, t0 + dt.timedelta(hours=5, minutes=29, seconds=59))]
    df = spark.createDataFrame(rows, "user_id long, event_time timestamp_ntz")
    ours = sorted((r.user_id, r.session_start.replace(tzinfo=None), r.session_end.replace(tzinfo=None), r.events)
                  for r in sessions(df).collect())
    assert len(ours) == 3
    brute = [(u, a, b, n) for u, a, b, n in _brute(df)]
    assert ours == brute


def test_sessions_match_session_window_on_fixture(spark):
    log = FX.userlog(spark, SF01).select("user_id", "event_time")
    ours = sessions(log).agg(F.count("*"), F.sum("duration_us"), F.sum("events")).first()
    b = log.groupBy("user_id", F.session_window("event_time", "30 minutes")).agg(
        F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count("*").alias("n"))
    bb = b.agg(F.count("*"), F.sum(F.unix_micros(F.col("b").cast("timestamp")) -
                                   F.unix_micros(F.col("a").cast("timestamp"))), F.sum("n")).first()
    assert tuple(ours) == tuple(bb)


# --- summaries that later stretches of the log join ---------------------------

def _whole_run(log, gap):
    s = sessions(log, gap)
    return {(r.user_id, r.date): (r.n, r.us) for r in s.groupBy("user_id", F.to_date("session_start").alias("date")).agg(
        F.count("*").alias("n"), F.sum("duration_us").alias("us")).collect()}


@pytest.mark.parametrize("seed", range(6))
def test_increments_equal_the_full_run_on_any_cut(spark, seed):
    import random
    from functools import reduce

    from abx.operators.sessions import day_summaries, finish_days
    rng = random.Random(seed)
    gap = rng.choice([600, 1800, 7000])
    start = dt.datetime(2024, 1, 1, 20)
    rows = []
    for user in range(12):
        t = start + dt.timedelta(seconds=rng.randrange(40_000))
        for _ in range(rng.randrange(1, 40)):
            rows.append((user, t))
            # Steps at, just over and well under the gap; some sessions run over midnight or days.
            t += rng.choice([dt.timedelta(seconds=gap), dt.timedelta(seconds=gap, microseconds=1), dt.timedelta(seconds=rng.randrange(1, gap)),
                             dt.timedelta(0), dt.timedelta(seconds=rng.randrange(40_000))])
    rng.shuffle(rows)
    log = spark.createDataFrame([*rows, (None, start), (3, None)], "user_id long, event_time timestamp_ntz")
    cuts = sorted(rng.choice(rows)[1] + dt.timedelta(microseconds=rng.randrange(2)) for _ in range(rng.randrange(4)))
    edges = [dt.datetime(2000, 1, 1), *cuts, dt.datetime(2100, 1, 1)]
    parts = [day_summaries(log.where((F.col("event_time") >= F.lit(a).cast("timestamp_ntz")) & (F.col("event_time") < F.lit(b).cast("timestamp_ntz"))), gap)
             for a, b in zip(edges, edges[1:])]
    got = {(r.user_id, r.date): (r.sessions, r.duration_us) for r in finish_days(reduce(lambda a, b: a.unionByName(b), parts), gap).collect()}
    assert got == _whole_run(log.where("user_id is not null and event_time is not null"), gap)


def test_summaries_have_a_row_per_user_and_day(spark):
    from abx.operators.sessions import day_summaries, finish_days
    log = FX.userlog(spark, SF01)
    s = day_summaries(log)
    assert s.count() == log.select("user_id", F.to_date("event_time")).distinct().count()
    assert finish_days(s).agg(F.sum("sessions"), F.sum("duration_us")).first() == sessions(log).agg(F.count("*"), F.sum("duration_us")).first()
    assert finish_days(s.where("false")).count() == 0
