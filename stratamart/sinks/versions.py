"""Tables whose loads appear in one step.

A versioned table is a view over one of several version tables. A load writes the partitions
it changes into folders of its own, creates the next version - new folders for those
partitions, the old version's folders for all others - and then replaces the view: one catalog
operation, before which every reader sees the old rows and after which the new ones. Nothing is
copied, and nothing that a reader holds is overwritten; a query planned before the swap reads
the old version to its end. A load killed before the swap leaves the table as it was, with
folders that ``collect_versions(orphans=True)`` removes; killed after it, the load is complete.

Old versions stay until ``collect_versions`` drops them. Two loads at a time: the later swap
is refused (``PublishConflict``) when the version that it was built from is no longer current.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from stratamart.session import child_names

POINTER = "stratamart.version"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
_SWAPS = threading.RLock()


class PublishConflict(RuntimeError):
    """Another load was published since this one began."""


def _names(name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return database or "default", table


def _root(spark: SparkSession, name: str) -> str:
    database, table = _names(name)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}__versions"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def is_versioned(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and POINTER in _properties(spark, name)


def current_version(spark: SparkSession, name: str) -> str:
    """The version table that the view shows now."""
    return _properties(spark, name)[POINTER]


def partition_column(spark: SparkSession, name: str) -> str:
    return next(c.name for c in spark.catalog.listColumns(current_version(spark, name)) if c.isPartition)


def _folders(spark: SparkSession, version: str) -> dict[str | None, str]:
    """Folder of each partition of a version: catalog entries, one call; None is the null partition."""
    state = spark._jsparkSession.sessionState()
    found = state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(version), spark._jvm.scala.Option.empty())
    column = next(c.name for c in spark.catalog.listColumns(version) if c.isPartition)
    out = {}
    for i in range(found.size()):
        value = found.apply(i).spec().apply(column)
        out[None if value == HIVE_NULL else value] = found.apply(i).location().toString()
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, version: str, columns: str, column: str, folders: dict[str | None, str], root: str) -> None:
    # The number may be left from a killed load; its folders are not touched by this.
    spark.sql(f"DROP TABLE IF EXISTS {version}")
    spark.sql(f"CREATE TABLE {version} ({columns}) USING parquet PARTITIONED BY ({column}) LOCATION {_quoted(f'{root}/none-{uuid.uuid4().hex}')}")
    entries = [f"PARTITION ({column} = {'NULL' if v is None else _quoted(v)}) LOCATION {_quoted(path)}" for v, path in folders.items()]
    for at in range(0, len(entries), 500):
        spark.sql(f"ALTER TABLE {version} ADD {' '.join(entries[at:at + 500])}")


def _swap(spark: SparkSession, name: str, version: str) -> None:
    """The commit: the view shows ``version`` from here on."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({_quoted(POINTER)} = {_quoted(version)}) AS SELECT * FROM {version}")


def _columns(spark: SparkSession, version: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(version).schema)


def create_versioned(spark: SparkSession, name: str, columns: str, partition_by: str) -> None:
    """Create an empty versioned table if it is absent."""
    if not spark.catalog.tableExists(name):
        version = f"{name}__v0"
        _create(spark, version, columns, partition_by, {}, _root(spark, name))
        _swap(spark, name, version)


def publish(rows: DataFrame, name: str, touched: list) -> str:
    """Replace the ``touched`` partitions by ``rows``, in one step; returns the new version.

    ``rows`` may be computed from the table itself. Touched partitions without rows are empty afterwards;
    rows of other partitions than the touched ones are refused before anything changes.
    """
    spark = rows.sparkSession
    base = current_version(spark, name)
    column, root = partition_column(spark, name), _root(spark, name)
    kept = {v: path for v, path in _folders(spark, base).items() if v not in {None if t is None else str(t) for t in touched}}
    load = f"{root}/load-{uuid.uuid4().hex}"
    ordered = rows.select(*spark.table(base).columns).hint("rebalance", column)
    ordered.write.partitionBy(column).parquet(load)
    fresh = {}
    for child in child_names(spark, load):
        if child.startswith(f"{column}="):
            value = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(child.split("=", 1)[1])
            fresh[None if value == HIVE_NULL else value] = f"{load}/{child}"
    if fresh.keys() & kept.keys():
        raise ValueError(f"{name}: rows of partitions that the load does not replace: {sorted(map(str, fresh.keys() & kept.keys()))}")
    version = f"{name}__v{int(base.rpartition('__v')[2]) + 1}"
    with _SWAPS:
        if current_version(spark, name) != base:
            raise PublishConflict(f"{name}: {base} is no longer the current version")
        _create(spark, version, _columns(spark, base), column, kept | fresh, root)
        _swap(spark, name, version)
    return version


def versions(spark: SparkSession, name: str) -> list[str]:
    """Version tables that exist, oldest first."""
    database, table = _names(name)
    found = [t.name for t in spark.catalog.listTables(database) if t.name.startswith(f"{table.lower()}__v") and t.name.rpartition("__v")[2].isdigit()]
    return [f"{database}.{t}" for t in sorted(found, key=lambda t: int(t.rpartition("__v")[2]))]


def collect_versions(spark: SparkSession, name: str, keep: int = 1, orphans: bool = False) -> list[str]:
    """Drop all but the newest ``keep`` versions, and the folders that only they use; returns the folders deleted.

    ``orphans`` also deletes folders that no version uses: leave it off while a load may be running.
    """
    current = current_version(spark, name)
    every = versions(spark, name)
    number = int(current.rpartition("__v")[2])
    # Versions above the current one belong to killed loads.
    live = [v for v in every if int(v.rpartition("__v")[2]) <= number][-max(1, keep):]
    gone = [v for v in every if v not in live]
    used = {path for v in live for path in _folders(spark, v).values()}
    old = {path for v in gone for path in _folders(spark, v).values()} - used
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    root = _root(spark, name)
    if orphans:
        loads = {f"{root}/{child}" for child in child_names(spark, root)}
        in_use = {path.rpartition("/")[0] for path in used}
        old |= {f for f in loads if not any(_same(f, u) for u in in_use)}
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    for folder in old:
        path = hadoop.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return sorted(old)


def _same(a: str, b: str) -> bool:
    """Two spellings of a path (``file:/x`` and ``/x``) that end in the same load."""
    return a.rpartition("/")[2] == b.rpartition("/")[2]
