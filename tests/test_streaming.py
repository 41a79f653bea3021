import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from abx.config import FIXTURE_EXPERIMENTS
from abx.operators.assign import assign
from abx.operators.metrics import user_day_metrics
from abx.sources import fixtures as FX
from abx.streaming import stream as ST

from conftest import SF001


def test_stream_equals_batch_for_closed_days(spark):
    log = ST.stream_userlog(spark, SF001)
    s = ST.run_available(ST.stream_user_day_metrics(log, watermark="1 hour"), "t-udm")
    raw = FX.userlog(spark, SF001)
    b = user_day_metrics(raw)
    # A day is final once max event time - 1 hour has passed its end.
    wm = raw.agg(F.max("event_time")).first()[0] - dt.timedelta(hours=1)
    b = b.filter(F.col("date") + F.expr("INTERVAL 1 DAY") <= F.lit(wm))
    assert b.count() > 0
    from abx.functions.columns import round6
    cols = [round6(c).alias(c) if c == "total_purchase_amount" else F.col(c) for c in b.columns]
    assert s.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(s.select(*cols)).count() == 0


def test_stream_assignment_equals_batch(spark):
    log = ST.stream_userlog(spark, SF001)
    s = ST.run_available(ST.stream_exposures(log, FX.users(spark, SF001), FIXTURE_EXPERIMENTS), "t-as")
    b = assign(FX.users(spark, SF001), FIXTURE_EXPERIMENTS).join(
        FX.userlog(spark, SF001).select("user_id").distinct(), "user_id")
    assert s.exceptAll(b.select(*s.columns)).count() == 0 and b.select(*s.columns).exceptAll(s).count() == 0


def test_event_later_than_watermark_is_dropped(spark, scratch):
    src = os.path.join(scratch, "in")
    schema = ST.EVENTS
    t = dt.datetime
    first = [(1, t(2024, 1, 1, 10), 7, "purchase", 5.0, '{"k": 1}'),
             (2, t(2024, 1, 3, 12), 7, "view", 1.0, '{"k": 2}')]
    second = [(4, t(2024, 1, 5, 12), 7, "view", 1.0, '{"k": 4}')]
    late = [(3, t(2024, 1, 1, 11), 7, "purchase", 100.0, '{"k": 3}'),   # day 1, already emitted
            (5, t(2024, 1, 6, 12), 7, "view", 1.0, '{"k": 5}')]
    # One file per micro-batch. Rows are judged late against the watermark the
    # previous batch ended with, so the late row comes two batches after day 1.
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(os.path.join(src, "a"))
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(os.path.join(src, "b"))
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(os.path.join(src, "c"))
    log = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(src))
    log = log.select("user_id", F.lit("00000001").alias("listing_id"), F.col("ts").cast("timestamp").alias("event_time"),
                     F.col("event_type").alias("activity"),
                     F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_amount"))
    out = os.path.join(scratch, "out")
    q = (ST.stream_user_day_metrics(log, watermark="1 hour").writeStream.outputMode("append").format("parquet")
         .option("path", out).option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    days = {r.date: r.total_purchase_amount for r in spark.read.parquet(out).collect()}
    assert days[dt.date(2024, 1, 1)] == 5.0  # the late purchase of 100 did not reach the closed day


def test_stream_of_user_log_files(spark, scratch):
    import datetime as dt
    from abx.schemas import USERLOG_STREAM
    from abx.streaming.stream import run_available, stream_log
    rows = [(u, "1", dt.datetime(2024, 1, 1 + u % 2, 3), "view", None) for u in range(10)]
    spark.createDataFrame(rows, USERLOG_STREAM).write.parquet(f"{scratch}/log")
    assert run_available(stream_log(spark, f"{scratch}/log"), "plain").count() == 10


def test_exposure_sink_holds_a_user_and_experiment_once(spark):
    log = ST.stream_userlog(spark, SF001)
    sink = ST.run_available(ST.stream_exposures(log, FX.users(spark, SF001), FIXTURE_EXPERIMENTS), "t-once")
    assert sink.count() == sink.select("user_id", "experiment_id").distinct().count() > 0


def _state_rows(df, scratch, name):
    q = (df.writeStream.format("parquet").option("path", f"{scratch}/{name}").option("checkpointLocation", f"{scratch}/{name}-ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"])


def test_sketch_state_does_not_follow_listings(spark, scratch):
    from abx.schemas import USERLOG_STREAM
    rows_of = {}
    for listings in (3, 3000):
        rows = [(u, str(k), dt.datetime(2024, 1, 1 + d, 5), "view", None) for u in range(2) for d in range(2) for k in range(listings)]
        spark.createDataFrame(rows, USERLOG_STREAM).write.parquet(f"{scratch}/log{listings}")
        log = ST.stream_log(spark, f"{scratch}/log{listings}")
        rows_of[listings] = _state_rows(ST.stream_listing_sketches(log), scratch, f"s{listings}")
        exact = _state_rows(ST.stream_user_day_metrics(log), scratch, f"e{listings}")
        assert exact >= 2 * listings
    assert rows_of[3] == rows_of[3000] == 4


@pytest.mark.parametrize("lg_k", [8, 12])
def test_sketches_merge_within_their_error(spark, lg_k):
    # Days that share half of their listings, merged: the union is counted, not the sum.
    n = 20_000
    days = [spark.range(d * n // 2, d * n // 2 + n).select(F.lit(1).alias("user_id"), F.lit(d).alias("date"), F.col("id").cast("string").alias("listing_id"))
            for d in range(4)]
    rows = days[0].unionByName(days[1]).unionByName(days[2]).unionByName(days[3])
    stored = rows.groupBy("user_id", "date").agg(F.hll_sketch_agg("listing_id", F.lit(lg_k)).alias("listings"), F.count(F.lit(1)).alias("total_events"))
    got = ST.merge_sketches(stored, ["user_id"]).first()
    exact = n + 3 * n // 2
    assert abs(got.distinct_listings - exact) <= 3 * 1.04 / 2 ** (lg_k / 2) * exact and got.total_events == 4 * n
