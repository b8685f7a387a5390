"""File writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratamart.clock import RunClock


def _sized(df: DataFrame, files: int | None) -> DataFrame:
    """The frame in ``files`` parts; by default Spark keeps one file per task."""
    if files is None:
        return df
    return df.coalesce(1) if files == 1 else df.repartition(files)


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False,
    delimiter: str = ",", files: int | None = None,
) -> str:
    """CSV files. One single file means one task, so ask for it only for small results.

    Values keep their blanks at both ends, which Spark's writer trims by default.
    """
    (
        _sized(df, files).write.mode(mode).option("header", header).option("delimiter", delimiter)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> str:
    _sized(df, files).write.mode(mode).json(path)
    return path


def run_path(prefix: str, clock: RunClock) -> str:
    """Folder named after the run: ``prefix`` + ``yyyyMMddHHmmss``."""
    return prefix + clock.suffix()


def export_csv(df: DataFrame, path: str, delimiter: str = ",") -> str:
    """Outbound export: sharded CSV with a header, replacing an earlier export."""
    return write_csv(df, path, mode="overwrite", header=True, delimiter=delimiter)
