"""Dense surrogate keys: numbers from 1 on without gaps or collisions, stable over reruns.

A key map is a table of natural keys and their numbers. Keys that it knows keep their number; new
ones are range-split, written once (so that a retried task sees the same ranges), counted by range,
and numbered inside each range behind the running sum of the counts. Only one count for each
range reaches the driver, and no window spans more than a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.session import pinned
from stratamart.sinks.tables import append_rows, refresh_table

NUMBER = "sk"


def extend_key_map(rows: DataFrame, name: str, *natural: str, ranges: int | None = None) -> int:
    """Give every natural key of ``rows`` a number in the map ``name``; returns how many were new.

    Null parts of a key are values of their own. One load at a time may extend a map. A load killed before
    the append leaves the map as it was.
    """
    spark = rows.sparkSession
    keys = rows.select(*[F.col(f"`{c}`") for c in natural]).distinct()
    start, exists = 0, spark.catalog.tableExists(name)
    if exists:
        known = spark.table(name)
        start = known.agg(F.max(NUMBER)).first()[0] or 0
        same = [F.col(f"_{c}").eqNullSafe(keys[c]) for c in natural]
        keys = keys.join(known.select(*[F.col(c).alias(f"_{c}") for c in natural]), same, "left_anti")
    split = keys.repartitionByRange(ranges, *natural) if ranges else keys.repartitionByRange(*natural)
    fixed = pinned(split.withColumn("_range", F.spark_partition_id()), "new-keys")
    before, total = {}, 0
    for row in fixed.groupBy("_range").count().orderBy("_range").collect():
        before[row["_range"]], total = total, total + row["count"]
    if not total and exists:
        return 0
    offsets = F.array(*[F.lit(before.get(i, 0)).cast("long") for i in range(max(before, default=0) + 1)])
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*natural))
    numbered = fixed.select(*natural, (F.lit(start) + F.get(offsets, F.col("_range")) + inside).alias(NUMBER))
    append_rows(numbered, name) if exists else refresh_table(numbered, name)
    return total


def with_dense_key(rows: DataFrame, name: str, *natural: str) -> DataFrame:
    """``rows`` with the number of their natural key."""
    known = rows.sparkSession.table(name).select(*[F.col(c).alias(f"_{c}") for c in natural], NUMBER)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_{c}")) for c in natural]
    return rows.join(known, same, "left").drop(*[f"_{c}" for c in natural])
