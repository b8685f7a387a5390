"""Dated customer deltas applied as type 1 upserts or type 2 snapshots."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stratamart.functions.dates import uri_day
from stratamart.operators.summaries import rows_per
from stratamart.plans.audit import SUCCESS, StepLog
from stratamart.plans.curation import curate_delta
from stratamart.sinks.tables import create_table
from stratamart.sinks.upsert import snapshot_type2, upsert_indexed, upsert_ordered, upsert_type1
from stratamart.sources.budget import MAX_BAD_RECORDS, drop_external, load_external
from stratamart.sources.catalog import lookup_rule
from stratamart.sources.schemas import DELTA

# Layout of the change tables.
CHANGE_COLUMNS = "custno BIGINT, name STRING, age BIGINT, profession STRING, datadt DATE, upd_ts TIMESTAMP"
JOB = "customer_change_load"
#: Step codes of the audit rows.
READ_DELTA, STORE_SNAPSHOT, APPLY_UPSERT, UNKNOWN_FLAG = "read_delta", "store_snapshot", "apply_upsert", "unknown_flag"


def create_change_table(spark: SparkSession, name: str) -> None:
    create_table(spark, name, CHANGE_COLUMNS, partition_by="datadt")


def apply_type1(delta: DataFrame, table: str) -> None:
    create_change_table(delta.sparkSession, table)
    upsert_type1(delta, table, "custno", "datadt")


def apply_ordered(delta: DataFrame, table: str) -> None:
    """Type 1 in which a row wins only over an older one: days may come in any order."""
    create_change_table(delta.sparkSession, table)
    upsert_ordered(delta, table, "custno", "datadt")


def apply_indexed(delta: DataFrame, table: str) -> None:
    """Type 1 through the table's key index."""
    create_change_table(delta.sparkSession, table)
    upsert_indexed(delta, table, "custno", "datadt")


def apply_type2(delta: DataFrame, table: str, day) -> None:
    create_change_table(delta.sparkSession, table)
    snapshot_type2(delta, table, day, "datadt")


def rows_per_day(spark: SparkSession, table: str) -> DataFrame:
    """Check after a load: stored rows per data date."""
    return rows_per(spark.table(table), "datadt")


def load_delta(
    spark: SparkSession, rules_table: str, rule_id: int, type1_table: str, type2_table: str,
    view: str = "cust_ext", max_bad_records: int = MAX_BAD_RECORDS,
) -> None:
    """Load the file the metadata table names into both change tables."""
    uri = lookup_rule(spark, rules_table, rule_id)
    day = uri_day(uri)
    delta = curate_delta(load_external(spark, uri, DELTA, view, max_bad_records), day)
    apply_type2(delta, type2_table, day)
    apply_type1(delta, type1_table)


def customer_etl(
    spark: SparkSession, uri: str, flag: str, database: str = "curatedds", view: str | None = None,
    max_bad_records: int = MAX_BAD_RECORDS, swallow: bool = False,
) -> str:
    """Load one dated delta file by ``flag``: ``'scd1'`` upserts, ``'scd2'`` keeps daily snapshots.

    Any other flag loads nothing, drops the session's default view, too, and leaves an audit row. Every step is audited in
    ``audit_tbl``; a failed step stops the run (with ``swallow`` it is only logged).
    The delta's view is named after the run, so concurrent runs do not meet, and is
    dropped at the end with what lies behind it; a ``view`` that is given stays.
    Returns the run id.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    log = StepLog(spark, f"{database}.audit_tbl", JOB)
    own = view or "cust_ext_" + re.sub("[^0-9A-Za-z]", "_", log.process_id)
    loads = {
        "scd1": (APPLY_UPSERT, lambda rows, day: apply_type1(rows, f"{database}.cust_part_curated_merge")),
        "scd2": (STORE_SNAPSHOT, lambda rows, day: apply_type2(rows, f"{database}.cust_part_curated", day)),
    }
    try:
        delta = None
        with log.step(READ_DELTA, swallow):
            day = uri_day(uri)
            delta = curate_delta(load_external(spark, uri, DELTA, own, max_bad_records), day)
        if delta is None:
            return log.process_id
        if flag in loads:
            step, load = loads[flag]
            with log.step(step, swallow):
                load(delta, day)
        else:
            log.record(UNKNOWN_FLAG, SUCCESS)
            for name in {own, "cust_ext"}:
                drop_external(spark, name)
    finally:
        if view is None:
            drop_external(spark, own)
    return log.process_id
