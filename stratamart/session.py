"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings that change results or keep plans adaptive. Sizes (memory, cores,
#: shuffle partitions) belong to the cluster and are left to spark-submit.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

STAGING_DB = "stratamart_staging"


def build_session(app_name: str = "stratamart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; keyword names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder: on a cluster that would be one machine's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    folder = tempfile.mkdtemp(prefix="stratamart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever written to it twice."""
    return f"{shared_dir(spark)}/stratamart/{label}-{uuid.uuid4().hex}"


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder that Hadoop can open; none if it is absent."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(entry.getPath().getName() for entry in files.listStatus(path)) if files.exists(path) else []


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path that ``release_pinned`` deletes."""
    path = new_path(spark, label)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """What ``release_pinned`` would delete now."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, []))


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete written intermediates that nothing reads any more."""
    held = _SCRATCH.get(spark.sparkContext.applicationId, [])
    for folder in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        if folder in held:
            held.remove(folder)


def pinned(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back, for plans that read it several times.

    The rows stay until ``release_pinned``, because the frame is still lazy here.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_pinned(spark: SparkSession) -> None:
    """Delete every scratch path of this application; call it once the results are stored."""
    delete_scratch(spark, scratch_paths(spark))


def new_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose managed tables live under the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, name)}'")
    return name


def new_staging_name(spark: SparkSession) -> str:
    """Unused name of a managed staging table (dropping the table drops its files)."""
    if not spark.catalog.databaseExists(STAGING_DB):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGING_DB} LOCATION '{new_path(spark, 'staging')}'")
    return f"{STAGING_DB}.stage_{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, partition_by: str | None = None):
    """Write ``df`` once to a staging table, yield its name, drop it afterwards.

    A written table cuts the lineage and survives lost executors, and every
    later read of it sees the same rows.
    """
    spark = df.sparkSession
    name = new_staging_name(spark)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.saveAsTable(name)
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
