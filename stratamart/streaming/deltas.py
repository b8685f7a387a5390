"""Dated delta files picked up once each by a file stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stratamart.functions.dates import path_date
from stratamart.operators.joins import sized
from stratamart.plans.audit import FAILURE, StepLog
from stratamart.plans.curation import curate_delta
from stratamart.plans.customer_changes import apply_ordered, apply_type2, create_change_table
from stratamart.session import child_names
from stratamart.sinks.upsert import AmbiguousMatch
from stratamart.sources.budget import MAX_BAD_RECORDS
from stratamart.sources.files import BAD_RECORD
from stratamart.sources.schemas import DELTA

JOB = "delta_pickup"
SET_ASIDE = "day_set_aside"


def landed_days(spark: SparkSession, landed: str) -> list[date]:
    """Days that have landed so far, oldest first: names of partition folders, not rows."""
    days = [n.split("=", 1)[1] for n in child_names(spark, landed) if n.startswith("datadt=")]
    return sorted(date.fromisoformat(d) for d in days if d[:1].isdigit())


def _schema() -> StructType:
    return StructType.fromDDL(DELTA).add(BAD_RECORD, "string")


def landed_rows(spark: SparkSession, landed: str, day: date | None) -> DataFrame:
    rows = spark.read.schema(_schema().add("datadt", "date").add("source", "string")).parquet(landed)
    return rows.filter(F.col("datadt").isNull() if day is None else F.col("datadt") == F.lit(day))


def apply_batch(
    spark: SparkSession, batch: DataFrame, landed: str, type1_table: str | None, type2_table: str | None,
    max_bad_records: int = MAX_BAD_RECORDS, audit_table: str | None = None,
) -> None:
    """Land newly found files, then rebuild every day they touch from all files of that day.

    Rows land under ``landed`` by day and file; a replayed batch replaces its own
    files only. A day's snapshot (type 2) is reloaded from all of its files, so it
    does not matter in how many batches they came. In the upsert (type 1) a row wins only over
    an older one, so a late file never overwrites newer values and touches its own keys only: no
    later day is read again. Rows that the table already holds as they are take no part.

    The budget of malformed rows holds for a dated delta, however many files it
    has. A day over budget, or a file without a date, is set aside with an audit
    row and stops nothing else; so is the upsert of a day that holds two rows for one
    stored key.
    """
    before = set(landed_days(spark, landed))
    # Each split holds rows of one file, so a task writes one folder: no shuffle.
    rows = batch.withColumn("source", F.sha2(F.col("_file").cast("binary"), 256)).drop("_file")
    # The days are observed on the write (as many as files at most): the files are parsed once.
    watch = Observation()
    rows = rows.observe(watch, F.collect_set("datadt").alias("days"), F.count_if(F.col("datadt").isNull()).alias("dateless"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("datadt", "source").parquet(landed)
    touched = list(watch.get["days"])
    database = (type1_table or type2_table or "default.x").rpartition(".")[0] or "default"
    log = StepLog(spark, audit_table or f"{database}.audit_tbl", JOB)
    if watch.get["dateless"]:
        log.record(SET_ASIDE, FAILURE, "a delta file carries no date in its name")
    days = sorted(touched)
    good = {}
    for day in days:
        # One pass over a small column; a day is at most one dated delta.
        bad = landed_rows(spark, landed, day).filter(F.col(BAD_RECORD).isNotNull()).count()
        if bad <= max_bad_records:
            good[day] = curate_delta(landed_rows(spark, landed, day).filter(F.col(BAD_RECORD).isNull()), day)
        else:
            log.record(SET_ASIDE, FAILURE, f"delta of {day}: {bad} malformed rows, {max_bad_records} allowed")
    for day in days:
        if type2_table and day in good:
            apply_type2(good[day], type2_table, day)
    if type1_table:
        for day, delta in good.items():
            again = day in before
            try:
                # All rows of the day count when two of them claim one key.
                conflicting = delta.groupBy("custno").count().filter("custno is not null and count > 1").take(1) if again else []
                if conflicting:
                    raise AmbiguousMatch(f"{type1_table}: several source rows match one target row on custno")
                apply_ordered(unapplied(delta, type1_table) if again else delta, type1_table)
            except AmbiguousMatch as error:  # raised before anything changes
                log.record(SET_ASIDE, FAILURE, f"delta of {day}: {error}")


def unapplied(delta: DataFrame, table: str) -> DataFrame:
    """Rows of a delta that the table does not hold as they are (nulls compare equal)."""
    create_change_table(delta.sparkSession, table)
    held = delta.sparkSession.table(table)
    # Only the delta's own day can hold its rows.
    days = [F.col(f"_h_{c}").eqNullSafe(F.col(c)) for c in delta.columns]
    condition = days[0]
    for part in days[1:]:
        condition = condition & part
    return delta.join(sized(held.select(*[F.col(c).alias(f"_h_{c}") for c in delta.columns])), condition, "left_anti")


def pick_up_deltas(
    spark: SparkSession, folder: str, checkpoint: str, type1_table: str | None = None, type2_table: str | None = None,
    pattern: str = "customers_*", max_bad_records: int = MAX_BAD_RECORDS, max_files: int | None = None,
    landed: str | None = None, audit_table: str | None = None,
) -> StreamingQuery:
    """Start a stream that applies every file not seen before, then stops.

    ``pattern`` matches dated files, or dated folders of part files. The checkpoint
    remembers which files are done; a rerun without new files changes nothing.
    ``max_files`` throttles a batch and does not change the result. Landed rows are
    kept under ``landed`` (beside the checkpoint unless given).
    """
    reader = (
        spark.readStream.format("csv").schema(_schema()).option("header", True).option("enforceSchema", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    found = reader.load(f"{folder}/{pattern}").select(
        "*", F.col("_metadata.file_path").alias("_file"), path_date(F.col("_metadata.file_path")).alias("datadt"),
    )
    store = landed or f"{checkpoint.rstrip('/')}-landed"

    def apply(batch: DataFrame, _batch_id: int) -> None:
        apply_batch(spark, batch, store, type1_table, type2_table, max_bad_records, audit_table)

    return (
        found.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(apply).start()
    )
