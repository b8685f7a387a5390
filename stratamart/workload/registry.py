"""Registration of queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from stratamart.workload.adapters import SQL, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a function of ``Tables``; ``sql`` selects from the adapter tables."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # Instants are compared as UTC text; casts take the zone when they are built.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(Tables(spark, folder)))

        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = SQL + sql
        return build

    return register


def _is_time(field) -> bool:
    return isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType))


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, as ``comparable`` writes them."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if _is_time(f) else f"`{f.name}`" for f in df.schema])


def comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, whole decimals as integers: equal on every engine."""
    out = []
    for field in df.schema:
        column = df[f"`{field.name}`"]
        if _is_time(field):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, DecimalType):
            # A fraction would be lost without a trace, so it is an error.
            whole = F.when(column.isNull() | (column == F.floor(column)), column.cast("bigint"))
            column = whole.otherwise(F.raise_error(F.lit(f"{field.name} has a fraction"))).alias(field.name)
        out.append(column)
    return df.select(*out)
