"""Feature tables: one-hot columns and a keyed write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abx.functions.columns import clean_feature_column, clean_feature_name

def levels(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null values of ``col``, for a table in which they are few by
    nature (a dimension): each becomes a column of the plan. Open domains take
    ``one_hot_long``, which brings nothing to the driver."""
    vals = df.select(F.col(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct().collect()
    return sorted(r["v"] for r in vals)


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` without those of ``columns`` that it has."""
    return df.drop(*[c for c in columns if c in df.columns])


def one_hot(df: DataFrame, level_map: dict[str, Sequence[str]]) -> DataFrame:
    """Replace each column of ``level_map`` by one 0/1 double column per level given (no
    level dropped; null and other values give all zeros), named '<column>_<level>' with
    spaces removed, '(' -> '-' and ')' removed. Name clashes raise.

    The levels are a parameter, so the schema does not depend on the rows: batch,
    stream and later data get the same columns.
    """
    keep = [c for c in df.columns if c not in level_map]
    out = [F.col(c) for c in keep]
    names = set(keep)
    for c, values in level_map.items():
        for v in values:
            n = clean_feature_name(f"{c}_{v}")
            if n in names:
                raise ValueError(f"feature name clash: {n!r}")
            names.add(n)
            out.append(F.when(F.col(c).cast("string") == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(n))
    return df.select(*out)


def one_hot_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One-hot features in long form: (key, feature, value 1.0) for each non-null value of
    ``columns``. Features are named as in ``one_hot``; any number of levels."""
    def name(c: str):
        return clean_feature_column(F.concat(F.lit(f"{c}_"), F.col(c).cast("string")))

    parts = F.array(*[F.struct(name(c).alias("feature"), F.lit(1.0).alias("value")) for c in columns])
    return (df.select(F.col(key), F.explode(parts).alias("f")).select(key, "f.feature", "f.value")
            .where(F.col("feature").isNotNull()))


def write_feature_table(df: DataFrame, key: str, path: str, mode: str = "overwrite") -> None:
    """Write a keyed feature table after checking the key is unique and non-null."""
    from abx.operators.audits import assert_unique_key
    assert_unique_key(df, key)
    df.write.mode(mode).parquet(path)


def one_hot_sparse(df: DataFrame, columns: Sequence[str], output: str = "features",
                   numeric: Sequence[str] = ()):
    """Sparse one-hot for model input when levels are many: StringIndexer +
    OneHotEncoder(dropLast=False) per column, assembled with ``numeric`` into
    one vector column. Levels are learned on the cluster, but the fitted indexer holds
    all of them on the driver: for columns whose levels fit there. Others take
    ``one_hot_long``.
    Returns (fitted pipeline model, transformed frame)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in columns]
    enc = OneHotEncoder(inputCols=[f"{c}__idx" for c in columns], outputCols=[f"{c}__vec" for c in columns],
                        dropLast=False, handleInvalid="error")
    asm = VectorAssembler(inputCols=list(numeric) + [f"{c}__vec" for c in columns], outputCol=output)
    model = Pipeline(stages=[*idx, enc, asm]).fit(df)
    out = model.transform(df).drop(*[f"{c}__idx" for c in columns], *[f"{c}__vec" for c in columns])
    return model, out
