"""Table sinks: overwrite, append, per-experiment partition replace, keyed write."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from abx.operators.audits import assert_unique_key


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace the table's contents (and schema) with ``df``."""
    w = df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Replace the table by ``df``, stored in ``buckets`` files by hash of ``key`` and sorted by it: tables of the
    same key and bucket count join and group by it without a shuffle. One shuffle here, one file a bucket."""
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Add rows; columns are matched by name and the column count must agree."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        target = spark.table(name).columns
        if sorted(target) != sorted(df.columns):
            raise ValueError(f"append to {name}: columns {sorted(df.columns)} != {sorted(target)}")
        df.select(*target).write.insertInto(name)
    else:
        df.write.mode("append").format("parquet").saveAsTable(name)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Partition overwrite mode 'dynamic' for a write; the session's own setting comes back."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def replace_partitions(df: DataFrame, name: str, partition_by: Sequence[str] = ("experiment_id",),
                       manifest: Iterable | None = None) -> list:
    """Write ``df`` into a table partitioned by ``partition_by``, leaving partitions outside of it untouched.

    Without ``manifest`` the partitions that ``df`` has are replaced. With it (values of the one
    partition column, the experiments of this run), exactly those are replaced: one for which
    ``df`` has no row is emptied, and a row of any other is an error before the table
    changes. Returns the values emptied. Which partitions were written is observed
    during the write; nothing is computed twice.
    """
    spark = df.sparkSession
    seen = None
    if manifest is not None:
        manifest = sorted(set(manifest))
        (column,) = partition_by
        value = F.col(f"`{column}`")
        inside = F.coalesce(value.isin(manifest), F.lit(False))
        stray = F.raise_error(F.concat(F.lit(f"{name}: not in the manifest: {column} "), F.coalesce(value.cast("string"), F.lit("null"))))
        df = df.withColumn(column, F.when(inside, value).otherwise(stray))
        seen = Observation()
        df = df.observe(seen, F.collect_set(value).alias("values"))       # as long as the manifest at most
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(name)
    else:
        cols = spark.table(name).columns
        with _dynamic_overwrite(spark):
            df.select(*cols).write.insertInto(name, overwrite=True)
    if seen is None:
        return []
    written = set(seen.get["values"])
    empty = [v for v in manifest if v not in written]
    for v in empty:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{column}` = {_literal(v)})")
    return empty


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"DATE '{value}'" if isinstance(value, dt.date) else str(value)


def batch_writer(name: str, batch_col: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``: each micro-batch is one partition of the table, named by the
    batch's number, so a batch that is run again after a failure replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch.withColumn(batch_col, F.lit(int(batch_id)).cast("long")), name, [batch_col], [int(batch_id)])
    return write


def write_keyed(df: DataFrame, name: str, key: str) -> None:
    """Overwrite a table keyed by ``key`` after checking it is unique and non-null."""
    assert_unique_key(df, key)
    overwrite_table(df, name)
