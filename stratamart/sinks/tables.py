"""Table loads: refresh, append, partition reload, subset, delete, update."""

from __future__ import annotations

import threading
from contextlib import contextmanager
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.session import new_staging_name
from stratamart.sinks.versions import HIVE_NULL, current_version, is_versioned, publish

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
#: Overwrites that depend on a session setting take turns.
_TURNS = threading.RLock()


def create_table(
    spark: SparkSession, name: str, columns: str, partition_by: str | None = None, comment: str | None = None,
) -> None:
    """Create an empty parquet table if it is absent."""
    part = f" PARTITIONED BY ({partition_by})" if partition_by else ""
    note = " COMMENT '" + comment.replace("'", "\\'") + "'" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{part}{note}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def refresh_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    """Full refresh: replaces data and schema.

    The rows are written to a new table first; only when that has succeeded does it
    take the old one's place, so a failed refresh leaves the old table as it was. For
    a partitioned table the rows are rebalanced on the partition column first, so each
    partition gets few files and a large one gets several.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        _store(df, name, partition_by)
        return
    database, _, table = name.rpartition(".")
    fresh = f"{database + '.' if database else ''}{table}__{new_staging_name(spark).rpartition('_')[2]}"
    try:
        _store(df, fresh, partition_by)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    if partition_by:
        # Renaming a partitioned table is not possible in every catalog. Its rows are computed and stored
        # by now; what is left is a copy of plain files.
        try:
            _store(spark.table(fresh), name, partition_by)
        except Exception as error:
            raise SwapFailed(f"{name}: the new rows are complete in {fresh}") from error
        spark.sql(f"DROP TABLE {fresh}")
    else:
        _swap_in(spark, fresh, name)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")


def _swap_in(spark: SparkSession, fresh: str, name: str) -> None:
    """Put a table in place of another. The old one is dropped last, and comes back if the new one cannot take its name."""
    aside = f"{fresh}_old"
    _rename(spark, name, aside)
    try:
        _rename(spark, fresh, name)
    except Exception as error:
        try:
            _rename(spark, aside, name)
        except Exception:
            raise SwapFailed(f"{name}: the old rows are complete in {aside}, the new ones in {fresh}") from error
        raise SwapFailed(f"{name}: holds the old rows; the new ones are complete in {fresh}") from error
    spark.sql(f"DROP TABLE {aside}")


def _store(df: DataFrame, name: str, partition_by: str | None) -> None:
    writer = (df.hint("rebalance", partition_by) if partition_by else df).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


class SwapFailed(RuntimeError):
    """Stored rows did not take their place; the message names the table that holds them."""


def _in_table_order(df: DataFrame, name: str) -> DataFrame:
    return df.select(*df.sparkSession.table(name).columns)


def truncate_and_insert(df: DataFrame, name: str) -> None:
    """Replace all rows, those of every partition, and keep the table's definition. Columns are matched by name."""
    with _overwrite_mode(df.sparkSession, "static"):
        df.sparkSession.sql(f"INSERT OVERWRITE {name} SELECT * FROM {{rows}}", rows=_in_table_order(df, name))


def append_rows(df: DataFrame, name: str, by_position: bool = False) -> None:
    """Append, matching columns by name.

    ``by_position`` ignores the names, as a plain ``INSERT … SELECT`` does; with
    columns in another order it stores them under the wrong names.
    """
    (df if by_position else _in_table_order(df, name)).write.insertInto(name)


def append_partitioned(df: DataFrame, name: str, partition_by: str) -> None:
    """Append to a partitioned table, creating it on first use."""
    if df.sparkSession.catalog.tableExists(name):
        append_rows(df.hint("rebalance", partition_by), name)
    else:
        refresh_table(df, name, partition_by)


def append_by_ingest_day(df: DataFrame, name: str, day: date, column: str = "ingest_dt") -> None:
    """Append to the partition of the ingestion day: a static partition, so nothing is shuffled."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.limit(0).withColumn(column, F.lit(day)).write.format("parquet").partitionBy(column).saveAsTable(name)
    others = [c for c in spark.table(name).columns if c != column]
    spark.sql(f"INSERT INTO {name} PARTITION ({column} = DATE'{day.isoformat()}') SELECT * FROM {{rows}}", rows=df.select(*others))


def reload_partition(df: DataFrame, name: str, column: str, day: date) -> None:
    """Replace one day of a table: delete the day, insert the given rows as that day.

    A static partition overwrite touches no other partition, needs no session
    setting, and leaves the day empty when there are no rows. Rerunning it
    gives the same table.
    """
    spark = df.sparkSession
    others = [c for c in spark.table(name).columns if c != column]
    if is_versioned(spark, name):
        publish(df.select(*others, F.lit(day).alias(column)), name, [day])
        return
    spark.sql(
        f"INSERT OVERWRITE {name} PARTITION ({column} = DATE'{day.isoformat()}') SELECT * FROM {{rows}}",
        rows=df.select(*others),
    )


def cluster_rows(df: DataFrame, *columns: str, parts: int | None = None) -> DataFrame:
    """Range-split and sort by the clustering columns.

    Files then cover narrow key ranges that row-group statistics can skip, and
    a day or customer with very many rows is spread over several tasks.
    """
    split = df.repartitionByRange(parts, *columns) if parts else df.repartitionByRange(*columns)
    return split.sortWithinPartitions(*columns)


def clone_schema(df: DataFrame, name: str) -> None:
    """Create a table with the frame's columns and no rows, if absent."""
    df.limit(0).write.format("parquet").mode("ignore").saveAsTable(name)


def load_subset(df: DataFrame, name: str, condition: Column) -> None:
    """Replace a table by the rows that meet a condition."""
    clone_schema(df, name)
    truncate_and_insert(df.filter(condition), name)


def delete_all(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    # INSERT reads this setting from the session only; a writer option is ignored.
    with _TURNS:
        before = spark.conf.get(_OVERWRITE_MODE, None)
        spark.conf.set(_OVERWRITE_MODE, mode)
        try:
            yield
        finally:
            spark.conf.unset(_OVERWRITE_MODE) if before is None else spark.conf.set(_OVERWRITE_MODE, before)


def partition_values(spark: SparkSession, name: str) -> set[str]:
    """Partition values of a table with one partition column (a metadata call).

    Partition names carry ``%XX`` escapes for characters a path cannot hold.
    """
    return {unquote(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def replace_partitions(rows: DataFrame, name: str, column: str, touched: list) -> None:
    """Replace the ``touched`` partitions of ``name`` by ``rows``.

    The rows may be computed from the same table. They are first written to a
    staging table; only then are the partitions swapped, and those without rows
    dropped. Readers can see the swap between partitions, since plain parquet
    tables have no transactions. If the swap fails, the staging table stays and the
    error names it: ``finish_swap`` completes the swap from there. A versioned table
    (``sinks.versions``) is published instead: readers see all old or all new rows.
    """
    spark = rows.sparkSession
    if is_versioned(spark, name):
        publish(rows, name, touched)
        return
    stage = new_staging_name(spark)
    try:
        _store(_in_table_order(rows, name), stage, column)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        raise
    try:
        finish_swap(spark, stage, name, column, touched)
    except Exception as error:
        raise SwapFailed(f"{name}: complete it with finish_swap(spark, {stage!r}, {name!r}, {column!r}, {touched!r})") from error


def finish_swap(spark: SparkSession, stage: str, name: str, column: str, touched: list) -> None:
    """Put a staging table's partitions in place of the touched ones; may be repeated. Drops the stage at the end."""
    filled = partition_values(spark, stage)
    # A session of its own: the caller's settings stay as they are for its other threads.
    own = spark.newSession()
    own.conf.set(_OVERWRITE_MODE, "dynamic")
    own.table(stage).select(*own.table(name).columns).write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)
    for value in touched:
        if (HIVE_NULL if value is None else str(value)) not in filled:
            spec = "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {spec})")
    spark.sql(f"DROP TABLE IF EXISTS {stage}")


def touched_partitions(rows: DataFrame, column: str) -> list:
    """Distinct partition values of some rows: as many as partitions, not rows."""
    return [r[0] for r in rows.select(column).distinct().collect()]


def in_partitions(df: DataFrame, column: str, values: list, as_text: bool = False) -> DataFrame:
    """Rows of some partitions; ``as_text`` compares the values' text (partitions are pruned either way)."""
    present = [v for v in values if v is not None]
    keep = (F.col(column).cast("string") if as_text else F.col(column)).isin(present)
    return df.filter(keep | F.col(column).isNull() if None in values else keep)


def _rewrite(spark: SparkSession, name: str, condition: Column, change) -> None:
    """Rewrite the partitions (or the table) that hold rows meeting a condition."""
    hit = F.coalesce(condition, F.lit(False))
    table = spark.table(name)
    parts = _partition_columns(spark, name)
    if len(parts) == 1:
        touched = touched_partitions(table.filter(hit), parts[0])
        if touched:
            replace_partitions(change(in_partitions(table, parts[0], touched), hit), name, parts[0], touched)
        return
    stage = new_staging_name(spark)
    try:
        _store(change(table, hit), stage, None)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        raise
    try:
        truncate_and_insert(spark.table(stage), name)
    except Exception as error:  # the table may have lost its rows by now: the stage holds them all
        raise SwapFailed(f"{name}: complete it with truncate_and_insert(spark.table({stage!r}), {name!r}) and drop {stage}") from error
    spark.sql(f"DROP TABLE IF EXISTS {stage}")


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    held = current_version(spark, name) if is_versioned(spark, name) else name
    return [c.name for c in spark.catalog.listColumns(held) if c.isPartition]


def delete_where(spark: SparkSession, name: str, condition: Column) -> None:
    """Delete the rows for which the condition is true (not null)."""
    _rewrite(spark, name, condition, lambda rows, hit: rows.filter(~hit))


def update_where(spark: SparkSession, name: str, condition: Column, values: dict[str, object]) -> None:
    """Set columns on the rows for which the condition is true.

    A partition column cannot be set: moving rows is the upsert's work.
    """
    if set(_partition_columns(spark, name)) & set(values):
        raise ValueError("a partition column cannot be updated")

    def change(rows: DataFrame, hit: Column) -> DataFrame:
        schema = rows.schema
        return rows.withColumns({
            c: F.when(hit, (v if isinstance(v, Column) else F.lit(v)).cast(schema[c].dataType)).otherwise(F.col(c))
            for c, v in values.items()
        })

    _rewrite(spark, name, condition, change)
