"""Copies between files and tables, with reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stratamart.clock import RunClock
from stratamart.plans.audit import counted, reconcile
from stratamart.plans.curation import customers_over
from stratamart.sinks.files import run_path, write_csv, write_json
from stratamart.sinks.tables import refresh_table
from stratamart.sources.files import read_inferred, read_positional, read_typed
from stratamart.sources.schemas import CONSUMER_NAMES, CONSUMER_SHORT


def copy_csv(spark: SparkSession, source: str, target_prefix: str, clock: RunClock, names: Sequence[str] = CONSUMER_NAMES) -> DataFrame:
    """Copy CSV files to a run-named folder and check that no row was lost."""
    rows, watch = counted(spark.read.csv(source), "rows copied")
    path = write_csv(rows, run_path(target_prefix, clock))
    copied = read_positional(spark, path, names)
    reconcile(watch.get["n_rows"], copied)
    return copied


def files_to_table_to_json(
    spark: SparkSession, source: str, csv_prefix: str, table: str, export_table: str, json_prefix: str, clock: RunClock,
) -> DataFrame:
    """Copy CSV files, load the copy into a table, export another table as JSON."""
    copied = copy_csv(spark, source, csv_prefix, clock)
    refresh_table(copied, table)
    write_json(spark.table(export_table), run_path(json_prefix, clock))
    return spark.table(table)


def typed_files_to_partitions(
    spark: SparkSession, source: str, table: str, json_prefix: str, csv_path: str, clock: RunClock, files: int = 2,
) -> DataFrame:
    """Typed CSV without malformed rows into a table partitioned by age, then JSON and CSV exports."""
    rows = read_typed(spark, source, CONSUMER_SHORT, malformed="DROPMALFORMED")
    refresh_table(rows, table, partition_by="custage")
    loaded = spark.table(table)
    write_json(loaded, run_path(json_prefix, clock), files=files)
    write_csv(loaded, csv_path, mode="overwrite", files=files)
    return loaded


def raw_and_curated_customers(
    spark: SparkSession, source: str, raw_table: str, curated_table: str, age: int = 30, sample_path: str | None = None,
) -> DataFrame:
    """Customer files into a raw table and, from that table, the customers above an age."""
    refresh_table(read_inferred(spark, source, CONSUMER_NAMES, sample_path=sample_path), raw_table)
    # The curated frame reads the stored table, so the text is parsed only once.
    refresh_table(customers_over(spark.table(raw_table), age), curated_table)
    return spark.table(curated_table)
