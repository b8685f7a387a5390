"""Slowly changing tables: type 1 upsert and type 2 daily snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.joins import left_join, sized
from stratamart.session import staged
from stratamart.sinks.key_index import FILTER_BITS, add_keys, candidate_partitions, index_name, rebuild_key_index
from stratamart.sinks.tables import in_partitions, reload_partition, replace_partitions


class AmbiguousMatch(ValueError):
    """Several source rows match one target row."""


def upsert_type1(
    source: DataFrame, name: str, key: str = "custno", partition: str = "datadt", candidates: list[str | None] | None = None,
) -> None:
    """Update rows whose key is in ``source``, insert the others; keeps no history.

    Follows MERGE: every target row with a matched key takes the source values,
    a matched row moves to the source row's partition, null keys never match,
    unmatched source rows are all inserted, and two source rows for one matched
    key are an error raised before anything changes.

    ``source`` is read several times, so give a table or a staged frame. Of the
    target, only the key and partition columns are scanned, whole or of the ``candidates``
    (partition values, as text, outside which no key of the source is); only the
    partitions that lose or gain rows are read fully and rewritten.
    """
    spark = source.sparkSession
    target = spark.table(name)
    searched = target
    if candidates is not None:
        searched = in_partitions(target, partition, candidates, as_text=True)
    # The source's partitions, and its size for the joins, by one pass.
    days = source.groupBy(partition).agg(F.count(F.lit(1)).alias("n_rows")).collect()
    size = sum(row["n_rows"] for row in days)
    copies = (
        source.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_copies"))
    )
    matched = searched.select(key, partition).join(sized(copies, size), F.col(key) == F.col("_key"))
    # Matched target rows combined to one row per key and partition.
    hits = matched.groupBy("_key", partition).agg(F.max("_copies").alias("_copies"))
    with staged(hits) as stage:
        found = spark.table(stage)
        losing = found.groupBy(partition).agg(F.max("_copies").alias("_copies")).collect()
        if any(row["_copies"] > 1 for row in losing):
            raise AmbiguousMatch(f"{name}: several source rows match one target row on {key}")
        touched = list(dict.fromkeys([row[partition] for row in losing + days]))
        if not touched:
            return
        inserts = source.join(sized(found.select("_key").distinct(), size), F.col(key) == F.col("_key"), "left_anti")
        rows = _updated(in_partitions(target, partition, touched), source, key, size)
        replace_partitions(rows.unionByName(inserts.select(*target.columns)), name, partition, touched)


def upsert_indexed(source: DataFrame, name: str, key: str = "custno", partition: str = "datadt", bits: int = FILTER_BITS) -> list[str | None]:
    """``upsert_type1`` that asks the table's key index where the keys can be; returns the partitions searched.

    The first load of a table without an index builds it. The source's bits are added before the table
    changes, so the index never misses a stored key, whenever a load is killed.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(index_name(name)):
        rebuild_key_index(spark, name, key, partition, bits)
    found = candidate_partitions(source, name, key, bits)
    add_keys(source, name, key, partition, bits)
    upsert_type1(source, name, key, partition, found)
    return found


def newest_only(source: DataFrame, name: str, key: str = "custno", partition: str = "datadt") -> DataFrame:
    """Rows of ``source`` whose key the table does not hold with a later date.

    ``source`` holds one date (or few): only partitions later than its earliest are searched, and only
    their key and partition columns.
    """
    first = source.agg(F.min(partition)).first()[0]
    if first is None:
        return source
    held = source.sparkSession.table(name).filter(F.col(partition) > F.lit(first)).select(F.col(key).alias("_held"), F.col(partition).alias("_later"))
    # A key that is held several times counts by its latest date: combined before the shuffle, so no key is hot.
    held = held.filter(F.col("_held").isNotNull()).groupBy("_held").agg(F.max("_later").alias("_later"))
    return source.join(sized(held), (F.col(key) == F.col("_held")) & (F.col("_later") > F.col(partition)), "left_anti")


def upsert_ordered(source: DataFrame, name: str, key: str = "custno", partition: str = "datadt") -> None:
    """``upsert_type1`` in which a row wins only over an older one, by its date.

    Dates may then be applied in any order, and again: the table is the one that date order gives.
    A late date touches its own keys only. A deleted key is a row marked as such, with its date:
    it stays in the table, so an older row that comes later does not bring the key back, and
    ``live_rows`` leaves it out.
    """
    with staged(newest_only(source, name, key, partition)) as stage:
        upsert_type1(source.sparkSession.table(stage), name, key, partition)


def live_rows(rows: DataFrame, deleted: str = "deleted") -> DataFrame:
    """Rows that are not marks of deleted keys."""
    return rows.filter(~F.coalesce(F.col(deleted), F.lit(False)))


def _updated(current: DataFrame, source: DataFrame, key: str, size: int) -> DataFrame:
    """Target rows, with the source's values where the key matches."""
    incoming = source.select(
        *[F.col(c).alias(f"_new_{c}") for c in current.columns], F.lit(True).alias("_hit")
    )
    joined = left_join(current, sized(incoming, size), key, f"_new_{key}")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in current.columns
    ])


def snapshot_type2(source: DataFrame, name: str, day: date, partition: str = "datadt") -> None:
    """Store the delta of one day as that day's partition; earlier days stay as they are."""
    reload_partition(source, name, partition, day)
