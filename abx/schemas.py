"""Declared schemas (no inference at scale)."""

from pyspark.sql import types as T

USERLOG = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("listing_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("activity", T.StringType()),
    T.StructField("purchase_amount", T.DoubleType()),
])

# The stream form carries a zoned timestamp: watermarks refuse TIMESTAMP_NTZ.
USERLOG_STREAM = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("listing_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("activity", T.StringType()),
    T.StructField("purchase_amount", T.DoubleType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("is_host", T.BooleanType()),
    T.StructField("firstname", T.StringType()),
    T.StructField("lastname", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("creation_date", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("is_host", T.BooleanType()),
    T.StructField("firstname", T.StringType()),
    T.StructField("lastname", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("creation_date", T.StringType()),
])

EXPERIMENTS = T.StructType([
    T.StructField("experiment_id", T.StringType(), False),
    T.StructField("ratio", T.DoubleType(), False),
    T.StructField("population", T.StringType(), False),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), False),
    T.StructField("pre_days", T.IntegerType(), False),
])
