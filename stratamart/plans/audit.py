"""Audit rows, step error capture and row-count reconciliation."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.keys import run_id

# Layouts of the two log tables and the entry kinds.
STEP_COLUMNS = "processid STRING, jobname STRING, processtype STRING, errormsg STRING, errtype STRING, ts TIMESTAMP"
PROGRESS_COLUMNS = "proc_name STRING, exec_ts TIMESTAMP, description STRING"
START, SUCCESS, FAILURE = "START", "SUCCESS", "FAILURE"


class StepLog:
    """START / SUCCESS / FAILURE rows of one run; all share the run's id."""

    def __init__(self, spark: SparkSession, table: str, job: str, process_id: str | None = None):
        self.spark, self.table, self.job = spark, table, job
        self.process_id = process_id or run_id()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({STEP_COLUMNS}) USING parquet")

    def record(self, step: str, kind: str, message: str = "") -> None:
        self.spark.sql(
            f"INSERT INTO {self.table} VALUES (:id, :job, :step, :message, :kind, current_timestamp())",
            args={"id": self.process_id, "job": self.job, "step": step, "message": message, "kind": kind},
        )

    @contextmanager
    def step(self, name: str, swallow: bool = False):
        """Log around a step; a failure is logged with its message, then raised again."""
        self.record(name, START)
        try:
            yield
        except Exception as error:
            self.record(name, FAILURE, str(error))
            if not swallow:
                raise
        else:
            self.record(name, SUCCESS)


class ProgressLog:
    """Plain progress notes of a load."""

    def __init__(self, spark: SparkSession, table: str, process: str):
        self.spark, self.table, self.process = spark, table, process
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({PROGRESS_COLUMNS}) USING parquet")

    def note(self, description: str) -> None:
        self.spark.sql(
            f"INSERT INTO {self.table} VALUES (:process, current_timestamp(), :note)",
            args={"process": self.process, "note": description},
        )


class CountMismatch(RuntimeError):
    """Source and target hold different numbers of rows."""


def counted(df: DataFrame, name: str = "rows written") -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while it is written (no extra scan)."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows")), watch


class ContentMismatch(RuntimeError):
    """Source and target hold different values; the message names the columns."""


def _sums(df: DataFrame) -> list:
    """Number of rows and, for each column, a sum of hashes: the same for the same values in any order."""
    sums = [F.sum(F.xxhash64(F.col(f"`{c}`"), F.lit(i)).cast("decimal(38,0)")).alias(f"sum_{i}") for i, c in enumerate(df.columns)]
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64("*").cast("decimal(38,0)")).alias("sum_rows"), *sums]


def checksummed(df: DataFrame, name: str = "content written") -> tuple[DataFrame, Observation]:
    """The frame with counter and checksums that fill while it is written (no extra scan). Columns of map type cannot be hashed."""
    watch = Observation(name)
    return df.observe(watch, *_sums(df)), watch


def reconcile_content(watch: Observation, target: DataFrame) -> int:
    """Compare what was written with the rows read back, one scan; returns the count, or raises.

    The columns must be in the written order and of the written types. A changed cell names its column; cells
    that changed places within their columns differ in the rows' own sum.
    """
    wrote, read = watch.get, target.agg(*_sums(target)).first()
    if wrote["n_rows"] != read["n_rows"]:
        raise CountMismatch(f"source has {wrote['n_rows']} rows, target {read['n_rows']}")
    wrong = [c for i, c in enumerate(target.columns) if wrote[f"sum_{i}"] != read[f"sum_{i}"]]
    if wrong or wrote["sum_rows"] != read["sum_rows"]:
        raise ContentMismatch(f"values differ in {', '.join(wrong) or 'the rows, not in any column alone'}")
    return read["n_rows"]


def reconcile(source_rows: int, target: DataFrame) -> int:
    """Compare with the rows read back; returns the count, or raises."""
    target_rows = target.count()
    if source_rows != target_rows:
        raise CountMismatch(f"source has {source_rows} rows, target {target_rows}")
    return target_rows
