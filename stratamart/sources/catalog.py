"""Catalog tables, external text tables, views and metadata."""

from __future__ import annotations

from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart.clock import RunClock


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_matching_tables(spark: SparkSession, database: str, pattern: str) -> DataFrame:
    """Union of all tables of a database whose name matches (``trans_mobile_20*``).

    Columns are matched by name; a column one table lacks is null there.
    """
    names = sorted(
        t.name for t in spark.catalog.listTables(database)
        if not t.isTemporary and fnmatchcase(t.name, pattern)
    )
    if not names:
        raise ValueError(f"no table in {database} matches {pattern}")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [spark.table(f"{database}.{n}") for n in names],
    )


def create_text_table(
    spark: SparkSession, name: str, columns: str, location: str | None = None,
    partition_column: str | None = None, delimiter: str = ",",
) -> None:
    """Delimited text table; with a location it is external and keeps its files."""
    part = f" PARTITIONED BY ({partition_column})" if partition_column else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv "
        f"OPTIONS (delimiter '{delimiter}', header 'false'){part}{place}"
    )


def land_text_files(spark: SparkSession, path: str, table: str, overwrite: bool = True, delimiter: str = ",") -> None:
    """Load raw delimited files into a text table by position; the source files stay."""
    columns = StructType([f for f in spark.table(table).schema])
    rows = spark.read.schema(columns).option("delimiter", delimiter).csv(path)
    rows.write.insertInto(table, overwrite=overwrite)


def query_view(spark: SparkSession, df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as a view and run SQL over it."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql)


def run_stamp(spark: SparkSession, clock: RunClock, pattern: str = "yyyyMMddHHmmss") -> str:
    """Run timestamp as text, for run-named folders.

    Whole seconds (``ss``): a fraction pattern there would repeat within a minute.
    """
    return spark.range(1).select(F.date_format(clock.ts_col, pattern)).first()[0]


def lookup_rule(spark: SparkSession, table: str, rule_id: int) -> str:
    """Source path stored under an id in the metadata table; exactly one row must match."""
    found = spark.table(table).filter(F.col("id") == rule_id).select("rulesql").take(2)
    if len(found) != 1:
        raise LookupError(f"{table}: {'no' if not found else 'more than one'} rule with id {rule_id}")
    return found[0]["rulesql"]


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def table_ddl(spark: SparkSession, name: str) -> str:
    return spark.sql(f"SHOW CREATE TABLE {name}").first()[0]


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def database_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def create_masked_view(spark: SparkSession, source: DataFrame, view: str, masked: list[str]) -> None:
    """View that shows the named text columns masked."""
    source.select(
        *[F.mask(F.col(c)).alias(c) if c in masked else F.col(c) for c in source.columns]
    ).createOrReplaceTempView(view)
