"""Row filters and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.clock import RunClock
from stratamart.functions.dates import in_year


def older_than(df: DataFrame, age: int, column: str = "age") -> DataFrame:
    return df.filter(F.col(column) > age)


def of_year(df: DataFrame, year: int, column: str) -> DataFrame:
    return df.filter(in_year(F.col(column), year))


def of_run_day(df: DataFrame, clock: RunClock, column: str = "loaddt") -> DataFrame:
    """Rows of the run date; prunes partitions when ``column`` partitions the table."""
    return df.filter(F.col(column) == clock.day_col)


def member_of(column: Column, values: Sequence) -> Column:
    return column.isin(list(values))


def with_scalar(df: DataFrame, other: DataFrame, aggregate: Column, name: str) -> DataFrame:
    """Attach one aggregate of ``other`` to every row, as a scalar subquery does."""
    return df.withColumn(name, other.select(aggregate).scalar())


def map_values(column: Column, mapping: dict, otherwise: Column | None = None) -> Column:
    """CASE over equal values; unmapped values stay, unless ``otherwise`` is given."""
    result = None
    for value, target in mapping.items():
        branch = (column == F.lit(value), F.lit(target))
        result = F.when(*branch) if result is None else result.when(*branch)
    return result.otherwise(column if otherwise is None else otherwise)
