"""A log stored by day, read through the experiments' periods.

The days that a run needs come from the experiment table when the query runs, not from literals:
Spark turns the join with them into a filter on the partitions (dynamic partition pruning), so
files of other days are not opened, also in the gaps between experiments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_daily(log: DataFrame, path: str, time_col: str = "event_time", mode: str = "overwrite") -> None:
    """Write the log partitioned by the day of ``time_col``. Large days get many tasks, and no task writes a
    file for every day. Rows without a time are left out."""
    dated = log.where(F.col(time_col).isNotNull()).withColumn("date", F.to_date(time_col))
    dated.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(path)


def period_days(experiments: DataFrame, pre: bool = True) -> DataFrame:
    """The days of the experiments' periods, each once: pre-period (with ``pre``) and treatment days."""
    first = F.date_sub("start_date", F.col("pre_days")) if pre else F.col("start_date")
    return experiments.select(F.explode(F.sequence(first, F.col("end_date"))).alias("date")).distinct()


def read_daily(spark: SparkSession, path: str, schema: T.StructType, experiments: DataFrame, pre: bool = True) -> DataFrame:
    """The log on the days of ``experiments``: a stored table of parameters, filtered to those of this run
    (Spark prunes through a filter). Its days are few, a row each, and broadcast."""
    stored = T.StructType([*[f for f in schema if f.name != "date"], T.StructField("date", T.DateType())])
    log = spark.read.schema(stored).parquet(path)
    return log.join(F.broadcast(period_days(experiments, pre)), "date", "left_semi").select(*schema.names)
