"""External file with a budget of malformed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart.session import new_staging_name
from stratamart.sources.files import BAD_RECORD, read_flagged

MAX_BAD_RECORDS = 2


class TooManyBadRecords(ValueError):
    """The file holds more malformed rows than allowed."""


def load_external(
    spark: SparkSession, path: str, schema: str | StructType, view: str = "cust_ext",
    max_bad_records: int = MAX_BAD_RECORDS, header: bool = True, delimiter: str = ",",
) -> DataFrame:
    """Read a CSV file, allow a few malformed rows, and register the rest as ``view``.

    The text is parsed once, into a staging table; bad rows are counted during
    that write. Above the budget nothing is registered and the call fails.
    """
    watch = Observation(f"bad records of {view}")
    is_bad = F.col(BAD_RECORD).isNotNull()
    flagged = read_flagged(spark, path, schema, header, delimiter).observe(
        watch, F.count_if(is_bad).alias("bad"), F.count(F.lit(1)).alias("read")
    )
    name = new_staging_name(spark)
    try:
        flagged.filter(~is_bad).drop(BAD_RECORD).write.format("parquet").saveAsTable(name)
        bad = watch.get["bad"]
        if bad > max_bad_records:
            raise TooManyBadRecords(f"{path}: {bad} malformed rows, {max_bad_records} allowed")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    drop_external(spark, view)
    spark.table(name).createOrReplaceTempView(view)
    # A setting belongs to its session, as the temporary view does.
    spark.conf.set(_BACKING + view, name)
    return spark.table(view)


#: Session setting that names the staging table behind a registered view.
_BACKING = "spark.stratamart.external."


def drop_external(spark: SparkSession, view: str = "cust_ext") -> None:
    """Drop this session's view and the staging table behind it, if present."""
    spark.catalog.dropTempView(view)
    name = spark.conf.get(_BACKING + view, None)
    if name:
        spark.conf.unset(_BACKING + view)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
