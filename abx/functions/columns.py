"""Scalar column builders. All are native Spark expressions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pad_id(x, width: int = 8) -> Column:
    """Left-pad with zeros to ``width``; longer input is kept whole, null stays null.

    ``lpad`` would cut long input, so the zeros are built with ``repeat``.
    """
    s = _c(x).cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(width) - F.length(s))), s)


def hash_unit(*parts) -> Column:
    """First 32 bits of md5 of the '|'-joined parts, as a bigint in [0, 2^32).

    A pure function of its inputs: the same subject gets the same value on every
    run, partitioning, batch or stream.
    """
    joined = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def round6(x) -> Column:
    """Round at 1e-6, halves to the even digit: rint(x * 1e6) / 1e6.

    Doubles throughout, so large values keep theirs, NaN stays NaN, infinities
    stay infinite and null stays null; plain IEEE steps, the same in every engine.
    """
    return F.rint(_c(x).cast("double") * F.lit(1e6)) / F.lit(1e6)


def to_cents(x) -> Column:
    """Money sums back to whole cents (drops summation-order noise)."""
    return F.rint(_c(x).cast("double") * F.lit(100.0)) / F.lit(100.0)


def date_label(x) -> Column:
    """Day label 'yyyy-MM-dd' as the result tables carry it."""
    return F.date_format(_c(x), "yyyy-MM-dd")


def clean_feature_name(name: str) -> str:
    """Feature column names: spaces dropped, '(' -> '-', ')' dropped."""
    return name.replace(" ", "").replace("(", "-").replace(")", "")


def clean_feature_column(name: Column) -> Column:
    """``clean_feature_name`` of a string column."""
    return F.translate(F.replace(F.replace(name, F.lit(" "), F.lit("")), F.lit("("), F.lit("-")), ")", "")
