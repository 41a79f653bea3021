"""Shared helpers: the cluster's shared folder, written tables, worker caches, names."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \\t-\\r"  # the ASCII white space that separates words: \x20 and \x09-\x0D


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session that names none
    (tests) gets a folder of its own; a cluster without one is an error."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="abx-shared-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends
    there, and losing an executor loses nothing. Removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/abx-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    key = "_abx_worker_cache"
    module = sys.modules.setdefault(key, types.ModuleType(key))
    return module.__dict__.setdefault(name, {})


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of 16 MB or 2,000 rows at most, so that a
    worker's memory does not follow the length of texts. Smaller settings are kept."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)):
        now = int(str(spark.conf.get(key)).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(items: list, limit: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of ``items`` whose lengths sum to at most ``limit`` (one item at least)."""
    a = total = 0
    for i, x in enumerate(items):
        n = len(x) if x else 0
        if i > a and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if items:
        yield a, len(items)
