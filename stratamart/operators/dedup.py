"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_highest(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """One row per key: the one with the highest ``order_by``, nulls lowest.

    The winner is the maximum of a struct led by ``order_by``; the remaining
    columns break ties, so the result is the same on every run. A maximum is
    combined before the shuffle, so a key with very many copies costs each task
    one row, where ranking in a window would sort the whole group.
    """
    others = [c for c in df.columns if c not in (key, order_by)]
    best = df.groupBy(key).agg(F.max(F.struct(order_by, *others)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.`{c}`").alias(c) for c in df.columns])


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns (all columns when none are named)."""
    return (df.select(*columns) if columns else df).distinct()
