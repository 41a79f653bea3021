"""Database set-up and listing."""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_database(spark: SparkSession, name: str, drop_first: bool = False) -> None:
    """Create the database; drop it (cascade) first only when asked."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"bad database name {name!r}")
    if drop_first:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))
