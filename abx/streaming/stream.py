"""Structured Streaming forms of the activity log, daily metrics and exposure.

* ``stream_userlog``: incremental file source with a declared schema; event
  time becomes a zoned timestamp (watermarks refuse TIMESTAMP_NTZ; the
  session zone is UTC).
* ``stream_user_day_metrics``: one-day tumbling windows behind a watermark,
  append mode. Distinct listings stay exact: a first stateful aggregation per
  (window, user, listing) feeds a second per (window, user); a day is emitted
  once the watermark passes its end, and events later than that are dropped.
* ``stream_listing_sketches``: the same days with distinct listings as mergeable
  sketches, in one stateful aggregation.
* ``stream_exposures``: the hash assignment on the stream (a stream-static join with
  the user table for eligibility), so a user gets the same group as in batch, and once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abx.config import DEFAULT_ACTIVITIES, Experiment
from abx.functions.columns import pad_id
from abx.operators.assign import assign
from abx.operators.metrics import activity_column
from abx.schemas import USERLOG_STREAM
from abx.session import scratch_path

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def stream_userlog(spark: SparkSession, directory: str, file_glob: str = "events*.parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The activity log as a stream over parquet files arriving in ``directory``."""
    r = spark.readStream.schema(EVENTS).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    ev = r.parquet(directory)
    return ev.select(
        "user_id",
        pad_id(F.get_json_object("props", "$.k")).alias("listing_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("activity"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_amount"),
    )


def stream_log(spark: SparkSession, directory: str, schema: T.StructType = USERLOG_STREAM,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A user log (user_id, listing_id, event_time, activity, purchase_amount) as a stream over
    parquet files arriving in ``directory``, read with its declared schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def stream_user_day_metrics(log: DataFrame, activities: Sequence[str] = DEFAULT_ACTIVITIES,
                            watermark: str = "1 hour") -> DataFrame:
    """User-day metrics on a stream; a day is final once the watermark passes it."""
    amount = F.when(F.col("activity") == "purchase", F.coalesce(F.col("purchase_amount"), F.lit(0.0))) \
        .otherwise(F.lit(0.0))
    per_listing = (log.withWatermark("event_time", watermark)
                   .groupBy(F.window("event_time", "1 day").alias("window"), "user_id", "listing_id")
                   .agg(*[F.count_if(F.col("activity") == a).alias(activity_column(a)) for a in activities],
                        F.count(F.lit(1)).alias("total_events"),
                        F.sum(amount).alias("total_purchase_amount")))
    per_day = per_listing.groupBy("window", "user_id").agg(
        F.count("listing_id").alias("total_listings"),
        *[F.sum(activity_column(a)).alias(activity_column(a)) for a in activities],
        F.sum("total_events").alias("total_events"),
        F.sum("total_purchase_amount").alias("total_purchase_amount"))
    return per_day.select("user_id", F.to_date(F.col("window.start")).alias("date"), "total_listings",
                          *[activity_column(a) for a in activities], "total_events", "total_purchase_amount")


def stream_exposures(log: DataFrame, users: DataFrame, experiments: Sequence[Experiment]) -> DataFrame:
    """One row per user and experiment, at the user's first event: (user_id, group,
    experiment_id, experiment_ratio).

    Users are told apart in state, a row each, before the join and the fan-out over experiments; a row
    is kept for the experiments' whole span, so that a user who returns is not sent again.
    """
    first = min(e.start_date - dt.timedelta(days=e.pre_days) for e in experiments)
    days = (max(e.end_date for e in experiments) - first).days + 1
    seen = (log.where(F.col("user_id").isNotNull()).select("user_id", "event_time")
            .withWatermark("event_time", f"{days} days").dropDuplicatesWithinWatermark(["user_id"]))
    return assign(seen.select("user_id").join(users, "user_id"), experiments)


def stream_listing_sketches(log: DataFrame, watermark: str = "1 hour", lg_k: int = 12) -> DataFrame:
    """Per (user_id, date): events, and a sketch of the distinct listings (HyperLogLog, 2^lg_k
    registers: a relative error of about 1.04 / 2^(lg_k / 2), and none to speak of for a few hundred).

    One stateful aggregation with a row per day and user, whose size does not follow the number of
    listings. Stored sketches merge over days and users (``merge_sketches``).
    """
    return (log.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("window"), "user_id")
            .agg(F.hll_sketch_agg("listing_id", F.lit(lg_k)).alias("listings"), F.count(F.lit(1)).alias("total_events"))
            .select("user_id", F.to_date(F.col("window.start")).alias("date"), "listings", "total_events"))


def merge_sketches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored sketches united per ``keys``, with the estimate of their distinct listings."""
    return (rows.groupBy(*keys).agg(F.hll_union_agg("listings").alias("listings"), F.sum("total_events").alias("total_events"))
            .withColumn("distinct_listings", F.hll_sketch_estimate("listings")))


def run_available(df: DataFrame, name: str, output_mode: str = "append",
                  state_partitions: int | None = None) -> DataFrame:
    """Run a streaming frame over everything available now into a parquet sink
    under the checkpoint folder; return the sink as a batch frame.

    State partitions are fixed when a checkpoint is created; by default they
    follow the cluster's parallelism (its total cores), not the batch shuffle
    setting.
    """
    spark = df.sparkSession
    base = scratch_path(spark, f"stream-{name}")
    parts = state_partitions or spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        q = (df.writeStream.outputMode(output_mode).format("parquet")
             .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(f"{base}/out")
