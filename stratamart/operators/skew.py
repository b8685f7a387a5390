"""Finding heavy keys and spreading them over tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

#: A key with fewer rows than this fits one task and needs no splitting. The
#: session setting ``spark.stratamart.minHotRows`` overrides it.
MIN_HOT_ROWS = 5_000_000
MIN_HOT_ROWS_CONF = "spark.stratamart.minHotRows"
#: Most keys of a column that are split, the heaviest first; bounds what reaches the driver.
#: A key that is left whole has at most 1 / MAX_HOT_KEYS of all rows.
MAX_HOT_KEYS = 20_000
#: Most parts of one key: bounds the copies of the other side's rows.
MAX_SALTS = 4096


@dataclass(frozen=True)
class HotKeys:
    """Heavy values of one key column; ``None`` stands for the null key.

    ``parts`` says into how many parts each value's rows go (all ``DEFAULT_SALTS`` if not given).
    """

    values: tuple = field(default_factory=tuple)
    parts: tuple[int, ...] = field(default_factory=tuple)

    def __bool__(self) -> bool:
        return bool(self.values)

    def _only(self, keep) -> "HotKeys":
        found = [(v, n) for v, n in zip(self.values, self._parts()) if keep(v)]
        return HotKeys(tuple(v for v, _ in found), tuple(n for _, n in found))

    def _parts(self) -> tuple[int, ...]:
        return self.parts or (DEFAULT_SALTS,) * len(self.values)

    def __or__(self, other: "HotKeys") -> "HotKeys":
        most = dict(zip(self.values, self._parts()))
        for v, n in zip(other.values, other._parts()):
            most[v] = max(n, most.get(v, 0))
        return HotKeys(tuple(most), tuple(most.values()))

    def __sub__(self, other: "HotKeys") -> "HotKeys":
        gone = set(other.values)
        return self._only(lambda v: v not in gone)

    def without_null(self) -> "HotKeys":
        return self._only(lambda v: v is not None)

    def salts(self, key: Column, fixed: int | None = None) -> Column:
        """Number of parts of each row's key; 1 for keys that are not heavy."""
        if fixed is not None:
            return F.when(self.holds(key), fixed).otherwise(1)
        parts, out = dict(zip(self.values, self._parts())), F.lit(1)
        for n in sorted(set(parts.values())):
            out = F.when(self._only(lambda v, n=n: parts[v] == n).holds(key), n).otherwise(out)
        return out

    def holds(self, key: Column) -> Column:
        """True or false, never null, for every row. An expression of literals: for few keys; plans use ``flagged``."""
        present = [v for v in self.values if v is not None]
        found = F.coalesce(key.isin(present), F.lit(False)) if present else F.lit(False)
        return found | key.isNull() if None in self.values else found


DEFAULT_SALTS = 64
NO_HOT_KEYS = HotKeys()


def find_all_hot_keys(df: DataFrame, *keys: str, min_rows: int | None = None) -> dict[str, HotKeys]:
    """Heavy values of several key columns, by exact counts.

    A table with fewer than ``min_rows`` rows has none. Otherwise each key is counted:
    combined on the map side, spread over all tasks, and only the heaviest
    values reach the driver. Results of joins never depend on it. Ask once for a stored
    table and hand the answer to every plan that joins it.
    """
    if min_rows is None:
        min_rows = int(df.sparkSession.conf.get(MIN_HOT_ROWS_CONF, str(MIN_HOT_ROWS)))
    if df.select(*[f"`{k}`" for k in keys]).count() < min_rows:
        return dict.fromkeys(keys, NO_HOT_KEYS)
    out = {}
    for key in keys:
        counted = df.groupBy(F.col(key).alias("item")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
        found = counted.orderBy(F.col("n").desc(), "item").limit(MAX_HOT_KEYS).collect()
        # A power of two of parts with at most min_rows rows each: few different numbers.
        parts = [min(MAX_SALTS, max(2, 1 << (-(-r["n"] // max(1, min_rows)) - 1).bit_length())) for r in found]
        out[key] = HotKeys(tuple(r["item"] for r in found), tuple(parts))
    return out


def find_hot_keys(df: DataFrame, key: str, min_rows: int | None = None) -> HotKeys:
    """Heavy values of one key column."""
    return find_all_hot_keys(df, key, min_rows=min_rows)[key]


def above_mean(df: DataFrame, key: str, times: float = 1.25) -> int:
    """A row count that some keys exceed at every scale: a multiple of the mean."""
    return int(times * df.count() / max(1, df.select(key).distinct().count())) + 1


def salt_of(df: DataFrame, salts: Column | int) -> Column:
    """A salt in [0, salts) that a retried task computes again.

    Row content spreads different rows; the partition id spreads equal copies
    that came from different input splits. A random salt would change on retry.
    """
    content = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and t != "variant"]
    salts = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(*content, F.spark_partition_id()), salts).cast("int")


def flagged(df: DataFrame, key: str, **sides: HotKeys) -> DataFrame:
    """``df`` with one column for each of ``sides``: the number of parts of the row's key, null where it is not heavy.

    The keys are data, not literals: one table of (key, parts, ...) for all sides, at most ``MAX_HOT_KEYS`` rows
    each, is broadcast and joined once, so the plan is the same for one key and for all.
    """
    kind = df.schema[key].dataType
    found: dict = {}
    for name, hot in sides.items():
        for value, parts in zip(hot.values, hot._parts()):
            found.setdefault(value, {})[name] = parts
    if not found:
        return df.withColumns({name: F.lit(None).cast("int") for name in sides})
    schema = StructType([StructField("_item", kind), *[StructField(name, IntegerType()) for name in sides]])
    columns = [pa.array(list(found), to_arrow_type(kind)), *[pa.array([p.get(name) for p in found.values()], pa.int32()) for name in sides]]
    keys = df.sparkSession.createDataFrame(pa.Table.from_arrays(columns, schema.names), schema)
    return df.join(F.broadcast(keys), F.col(key).eqNullSafe(F.col("_item")), "left").drop("_item")


def salted(df: DataFrame, parts: str, salts: int | None = None, name: str = "_salt") -> DataFrame:
    """Side that is split, of a ``flagged`` frame: heavy rows get a salt, all others 0."""
    number = F.lit(salts) if salts else F.col(parts)
    return df.withColumn(name, F.when(F.col(parts).isNotNull(), salt_of(df, number)).otherwise(F.lit(0)))


def replicated(df: DataFrame, parts: str, salts: int | None = None, name: str = "_salt") -> DataFrame:
    """Other side: one copy of each heavy-key row per salt of its key."""
    number = F.lit(salts) if salts else F.col(parts)
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.when(F.col(parts).isNotNull(), number - 1).otherwise(0))))
