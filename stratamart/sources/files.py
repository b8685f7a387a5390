"""File readers. All are lazy, splittable and accept any path Hadoop can open."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratamart.functions.dates import path_date

BAD_RECORD = "_corrupt_record"


def read_positional(spark: SparkSession, path: str, names: Sequence[str], delimiter: str = ",") -> DataFrame:
    """Headerless CSV, all strings, columns named by position."""
    return spark.read.option("header", False).option("delimiter", delimiter).csv(path).toDF(*names)


def read_inferred(
    spark: SparkSession, path: str, names: Sequence[str] | None = None, header: bool = False,
    delimiter: str = ",", sample_path: str | None = None,
) -> DataFrame:
    """CSV with inferred types.

    Inference reads its input once more. ``sample_path`` (one part file, say)
    limits that pass; the full read then uses the types found there.
    """
    reader = spark.read.option("header", header).option("delimiter", delimiter)
    if sample_path is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        df = reader.schema(reader.option("inferSchema", True).csv(sample_path).schema).csv(path)
    return df.toDF(*names) if names else df


def read_typed(
    spark: SparkSession, path: str, schema: str | StructType, header: bool = False,
    delimiter: str = ",", malformed: str = "FAILFAST",
) -> DataFrame:
    """CSV with a declared schema, by position; the header row's names are ignored (``read_by_header`` follows them).

    ``malformed``: ``FAILFAST`` stops, ``DROPMALFORMED`` skips bad rows,
    ``PERMISSIVE`` nulls bad fields.
    """
    return (
        spark.read.schema(schema).option("header", header).option("enforceSchema", True)
        .option("delimiter", delimiter).option("mode", malformed).csv(path)
    )


class HeaderMismatch(ValueError):
    """A file's header names a column twice, or (strictly) other columns than declared."""


def _first_line(spark: SparkSession, file: str) -> str | None:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(path)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def files_by_header(spark: SparkSession, path: str, delimiter: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files under a path by the names in their own header (trimmed, lower case). Files without a line are left out.

    One short read for each file, on the driver; rows are never read here.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    for file in map(unquote, spark.read.text(path).inputFiles()):
        line = _first_line(spark, file)
        if line is not None:
            names = tuple(n.strip().lower() for n in next(csv.reader([line.lstrip("\ufeff")], delimiter=delimiter), []))
            if len(set(names)) < len(names):
                raise HeaderMismatch(f"{file}: a column stands twice in {names}")
            found.setdefault(names, []).append(file)
    return found


def read_by_header(
    spark: SparkSession, path: str, schema: str | StructType, delimiter: str = ",", malformed: str = "FAILFAST", strict: bool = False,
) -> DataFrame:
    """CSV with a declared schema whose columns are found by each file's own header.

    Files in one folder may have their columns in another order, lack some (null) or have more
    (left out); ``strict`` refuses the last two. Files of one header are one read, and the reads
    are joined by name, so the number of scans is that of different headers.
    """
    fields = {f.name.lower(): f for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema)}
    parts = []
    for names, group in sorted(files_by_header(spark, path, delimiter).items()):
        if strict and set(names) != set(fields):
            raise HeaderMismatch(f"{group[0]}: header {names}, declared {tuple(fields)}")
        own = StructType([StructField(f"c{i}", fields[n].dataType if n in fields else StringType()) for i, n in enumerate(names)])
        rows = (
            spark.read.schema(own).option("header", True).option("enforceSchema", True).option("delimiter", delimiter)
            .option("mode", malformed).csv(group)
        )
        at = {n: i for i, n in enumerate(names)}
        parts.append(rows.select(*[(F.col(f"c{at[n]}") if n in at else F.lit(None).cast(f.dataType)).alias(f.name) for n, f in fields.items()]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], StructType(list(fields.values())))


def read_json_lines(
    spark: SparkSession, path: str, schema: str | StructType | None = None, malformed: str = "FAILFAST",
) -> DataFrame:
    """One JSON document per line; a declared schema saves the inference pass.

    ``malformed`` as for ``read_typed``: by default a cut line stops the load
    instead of becoming a row of nulls.
    """
    reader = spark.read.option("mode", malformed)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_flagged(
    spark: SparkSession, path: str, schema: str | StructType, header: bool = True, delimiter: str = ",",
) -> DataFrame:
    """CSV with a declared schema plus ``_corrupt_record``, the raw text of bad rows."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return (
        spark.read.schema(StructType(fields.fields).add(BAD_RECORD, "string"))
        .option("header", header).option("enforceSchema", True).option("delimiter", delimiter)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD).csv(path)
    )


def with_file_date(df: DataFrame, name: str = "datadt") -> DataFrame:
    """Add the date that a file's name, or its folder's, ends with (``customers_20250701``)."""
    return df.withColumn(name, path_date(F.col("_metadata.file_path")))
