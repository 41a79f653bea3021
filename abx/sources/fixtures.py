"""Adapters from the driver's test tables to the experiment data model (FIXTURES.md §3).

Each is a projection over one scan (plus nothing else), so column pruning and
filters still reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abx.functions.columns import pad_id


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def userlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log: user_id, listing_id, event_time, activity, purchase_amount."""
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id"),
        pad_id(F.get_json_object("props", "$.k")).alias("listing_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("activity"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_amount"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users: user_id, is_host (a fifth of users), email, segment."""
    c = _table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        ((F.col("c_custkey") % 5) == 0).alias("is_host"),
        F.col("c_name").alias("email"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings: listing_id (8 wide), price, neighbourhood_cleansed, room_type, accommodates."""
    p = _table(spark, sf_dir, "part")
    return p.select(
        pad_id(F.col("p_partkey")).alias("listing_id"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("neighbourhood_cleansed"),
        F.col("p_type").alias("room_type"),
        F.col("p_size").alias("accommodates"),
    )
