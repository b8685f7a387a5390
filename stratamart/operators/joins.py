"""Equi-joins that hold when one key has a large share of the rows.

Without heavy keys each function is one plain Spark join, and AQE picks
broadcast, hash or sort-merge by measured size. Heavy keys are salted: one
side is split (into parts by the key's weight, or into ``salts``), the other
replicated for those keys only. No row is dropped. With heavy keys an input is read
more than once: give stored tables, or ``pinned`` frames. ``fans_out`` tells that the result
has many times the rows of its inputs: AQE merges partitions by what is shuffled, which would leave
such a join little more than one task for each core, so it keeps all shuffle partitions.
Both inputs must have distinct column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.skew import NO_HOT_KEYS, HotKeys, flagged, replicated, salted

_FLAGS = ("_lparts", "_rparts")
#: Most rows that ``sized`` sends to every task.
BROADCAST_ROWS = 50_000


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Right side of a join, broadcast or sort-merged by its number of rows (at most ``rows``; none: unknown, so merged).

    Spark takes the size of a stored table's files for the size of its rows. Compressed keys fill a small
    file with so many rows that a broadcast of them costs the driver many times the size that was allowed.
    """
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df.hint("merge")


def _on(left_key: str, right_key: str):
    return (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_rsalt"))


def _uncoalesced(df: DataFrame, *keys: str) -> DataFrame:
    """One side of a join, shuffled as the join asks for; by a given number, so that AQE merges the partitions of neither side."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _split_join(
    split: DataFrame, copies: DataFrame, split_key: str, copies_key: str, parts: str, salts: int | None, how: str, fans_out: bool = False,
) -> DataFrame:
    """Join of two flagged sides, ``split`` by the salts of its heavy keys."""
    split = salted(split, parts, salts).drop(*_FLAGS)
    copies = replicated(copies, parts, salts, "_rsalt").drop(*_FLAGS)
    if fans_out:
        copies = _uncoalesced(copies, copies_key, "_rsalt")
    return split.join(copies, _on(split_key, copies_key), how).drop("_salt", "_rsalt")


def inner_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    hot: HotKeys = NO_HOT_KEYS, salts: int | None = None,
) -> DataFrame:
    """Inner join; ``hot`` are heavy keys of ``left``."""
    hot = hot.without_null()  # null keys never match and are filtered by the join
    if not hot:
        return left.join(right, F.col(left_key) == F.col(right_key))
    sides = (flagged(left, left_key, _lparts=hot), flagged(right, right_key, _lparts=hot))
    return _split_join(*sides, left_key, right_key, "_lparts", salts, "inner")


def left_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    hot_left: HotKeys = NO_HOT_KEYS, hot_right: HotKeys = NO_HOT_KEYS, salts: int | None = None, fans_out: bool = False,
) -> DataFrame:
    """Left outer join, safe for heavy keys of either side.

    A key heavy on the right certainly has right rows, so for it the outer join
    equals the inner join, where the right side may be split. A key heavy only
    on the left is split there; each left row keeps one salt and still meets
    every right row of its key.
    """
    hot_right = hot_right.without_null()
    hot_left = hot_left - hot_right
    if not hot_left and not hot_right:
        right = _uncoalesced(right, right_key) if fans_out else right
        return left.join(right, F.col(left_key) == F.col(right_key), "left")
    return _left_flagged(
        flagged(left, left_key, _lparts=hot_left, _rparts=hot_right),
        flagged(right, right_key, _lparts=hot_left.without_null(), _rparts=hot_right),
        left_key, right_key, bool(hot_right), salts, fans_out)


def _left_flagged(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot_right: bool, salts: int | None, fans_out: bool = False,
) -> DataFrame:
    """Left join of two sides flagged with the parts of keys heavy on the left (only) and on the right."""
    rest = F.col("_rparts").isNull()
    joined = _split_join(left.filter(rest), right.filter(rest), left_key, right_key, "_lparts", salts, "left", fans_out)
    if not hot_right:
        return joined
    heavy = _split_join(right.filter(~rest), left.filter(~rest), right_key, left_key, "_rparts", salts, "inner", fans_out)
    return joined.unionByName(heavy.select(*joined.columns))


def full_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    hot_left: HotKeys = NO_HOT_KEYS, hot_right: HotKeys = NO_HOT_KEYS, salts: int | None = None,
) -> DataFrame:
    """Full outer join, safe for heavy keys of either side and for null keys.

    Null keys never match: their rows are added as they are and not shuffled. The
    others meet in a plain full join, so that column pruning and filters reach
    both scans. Spark cannot split a full outer join at run time; heavy keys go
    through a left join plus the right rows whose key the left side lacks.
    """
    hot_right = hot_right.without_null()
    hot_left = hot_left.without_null() - hot_right
    some_left, some_right = left.filter(F.col(left_key).isNotNull()), right.filter(F.col(right_key).isNotNull())
    if hot_left or hot_right:
        some_left, some_right = (flagged(df, key, _lparts=hot_left, _rparts=hot_right) for df, key in ((some_left, left_key), (some_right, right_key)))
        light = F.col("_lparts").isNull() & F.col("_rparts").isNull()
        heavy_left, heavy_right = some_left.filter(~light), some_right.filter(~light)
        some_left, some_right = some_left.filter(light).drop(*_FLAGS), some_right.filter(light).drop(*_FLAGS)
    joined = some_left.join(some_right, F.col(left_key) == F.col(right_key), "full")
    joined = joined.unionByName(left.filter(F.col(left_key).isNull()), allowMissingColumns=True)
    joined = joined.unionByName(right.filter(F.col(right_key).isNull()), allowMissingColumns=True)
    if not hot_left and not hot_right:
        return joined
    matched = _left_flagged(heavy_left, heavy_right, left_key, right_key, bool(hot_right), salts)
    # At most MAX_HOT_KEYS distinct keys per side.
    seen = heavy_left.select(F.col(left_key).alias("_seen")).distinct()
    lonely = heavy_right.drop(*_FLAGS).join(seen, F.col(right_key) == F.col("_seen"), "left_anti")
    return joined.unionByName(matched.select(*joined.columns)).unionByName(lonely, allowMissingColumns=True)


def semi_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` whose key tuple occurs in ``right`` (EXISTS, multi-column IN).

    The right keys are made distinct first, which combines on the map side.
    """
    right_keys = right_keys or left_keys
    keys = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(right_keys)]).distinct()
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(left_keys)]
    return left.join(keys, on, "left_semi")
