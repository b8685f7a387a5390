"""A maintained index from keys to the partitions that may hold them.

For each partition of a table the index keeps a Bloom filter with one hash: a key's bit is a hash
modulo the filter's size, and the filter is stored in pieces of 32,768 bits (one row each, built by
Spark's bitmap aggregates), of which only those with a bit are there. A load asks only for the
pieces that its own keys fall into, so it reads a part of the index that grows with the load, and
no key column of the table.

Bits are only added: a load adds its keys' bits before it changes the table, so a load killed in
between leaves bits too many, never too few. Keys that have left a partition are found there in
vain until ``rebuild_key_index``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.sinks.tables import in_partitions, refresh_table

#: Bits of a partition's filter: 2**28 hold ten million keys with about 4 % of false hits.
FILTER_BITS = 1 << 28
PIECE_BITS = 32_768


def index_name(table: str) -> str:
    return f"{table}__keys"


def _position(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(bits))


def key_bits(rows: DataFrame, key: str, partition: str, bits: int = FILTER_BITS) -> DataFrame:
    """(part, piece, filter): the pieces of the filters of some rows, combined on the map side; null keys have no bit."""
    at = rows.filter(F.col(key).isNotNull()).select(F.col(partition).cast("string").alias("part"), _position(F.col(key), bits).alias("at"))
    at = at.select("part", F.floor(F.col("at") / PIECE_BITS).cast("int").alias("piece"), (F.col("at") % PIECE_BITS).alias("bit"))
    return at.groupBy("part", "piece").agg(F.bitmap_construct_agg("bit").alias("filter"))


def rebuild_key_index(spark: SparkSession, table: str, key: str, partition: str, bits: int = FILTER_BITS) -> None:
    """Index a table anew: one scan of its key and partition columns."""
    # By piece, so that a load's pieces are few files; the piece number is the folder's remainder.
    pieces = key_bits(spark.table(table), key, partition, bits).withColumn("shelf", F.col("piece") % 64)
    refresh_table(pieces, index_name(table), "shelf")


def add_keys(rows: DataFrame, table: str, key: str, partition: str, bits: int = FILTER_BITS) -> None:
    """Add the bits of rows that a load is about to store."""
    spark = rows.sparkSession
    pieces = key_bits(rows, key, partition, bits).withColumn("shelf", F.col("piece") % 64)
    if spark.catalog.tableExists(index_name(table)):
        pieces.select(*spark.table(index_name(table)).columns).write.insertInto(index_name(table))
    else:
        refresh_table(pieces, index_name(table), "shelf")


def candidate_partitions(rows: DataFrame, table: str, key: str, bits: int = FILTER_BITS) -> list[str | None]:
    """Partition values (as text) whose filter holds a key of ``rows``: all that can hold one of them."""
    spark = rows.sparkSession
    asked = rows.filter(F.col(key).isNotNull()).select(_position(F.col(key), bits).alias("at")).distinct()
    asked = asked.select(
        F.floor(F.col("at") / PIECE_BITS).cast("int").alias("piece"), (F.col("at") % PIECE_BITS).cast("int").alias("bit"),
        (F.floor(F.col("at") / PIECE_BITS) % 64).cast("int").alias("shelf"))
    shelves = [r[0] for r in asked.select("shelf").distinct().collect()]
    held = in_partitions(spark.table(index_name(table)), "shelf", shelves)
    byte = F.conv(F.hex(F.substring("filter", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)), F.lit(2)) == 1
    found = asked.join(held, ["shelf", "piece"]).filter(hit).select("part").distinct()
    # At most as many as the table has partitions.
    return [r["part"] for r in found.collect()]

