"""Grouped and global summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per(df: DataFrame, *keys: str, name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def row_total(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def multiplicity(df: DataFrame, key: str, key_name: str, count_name: str) -> DataFrame:
    """Rows per non-null key: what an inner join on the key multiplies by.

    Joining this instead of ``df`` keeps a repeated key from fanning out.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(key_name))
        .agg(F.count(F.lit(1)).alias(count_name))
    )
