"""Scans: columnar files, CSV, managed tables, and small parameter rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from abx.config import Experiment
from abx.schemas import EXPERIMENTS


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Columnar scan with a declared schema; ``columns`` selects (pruned at the reader)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row; quoted fields may hold newlines. Nothing is inferred."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Managed table by ``db.table`` name."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def rows_to_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """Small parameter rows to a frame, with declared types (never data-sized input).

    They become a local relation of the plan: its size is known, and no job reads it."""
    rows = list(rows)
    kinds = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)]
    return spark.createDataFrame(pa.table(columns, schema=kinds), schema)


def experiments_frame(spark: SparkSession, experiments: Sequence[Experiment]) -> DataFrame:
    """The experiment parameters as a frame. Its size is the number of experiments."""
    rows = [(e.experiment_id, float(e.ratio), e.population, e.start_date, e.end_date, int(e.pre_days))
            for e in experiments]
    return rows_to_frame(spark, rows, EXPERIMENTS)
