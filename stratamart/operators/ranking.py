"""Window analytics per key, ordered by one value.

``rank_within`` adds, per ``key``:

===============  =====================================================
``row_number``   position by (value, tie), 1-based
``rank``         1 + rows with a lower value
``dense_rank``   1 + distinct lower values
``cume_dist``    share of rows with an equal or lower value
``first``        lowest value (null when a null value comes first)
``nth``          n-th value, null until the row's frame (with peers) has n rows
``next, prev``   value of the following / preceding row by (value, tie)
===============  =====================================================

Nulls sort first. Two ways give the same rows: one window on one shuffle, and
for heavy keys a split by ranges, since a window puts a whole key in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.operators.skew import NO_HOT_KEYS, HotKeys, flagged
from stratamart.session import pinned


@dataclass(frozen=True)
class RankNames:  # fixed values: column names of the outbound report
    """Output column names."""

    row_number: str = "rownum_amt"
    rank: str = "rnk_amt"
    dense_rank: str = "densernk_amt"
    cume_dist: str = "cumedist_amt"
    first: str = "first_trans_amt"
    nth: str = "third_highest_trans"
    next: str = "next_trans"
    prev: str = "prev_trans"


def rank_within(
    df: DataFrame, key: str, value: str, tie: str, nth: int = 3,
    names: RankNames = RankNames(), hot: HotKeys = NO_HOT_KEYS, ranges: int | None = None,
) -> DataFrame:
    """``df`` plus the eight columns; ``hot`` keys take the range-split way."""
    if not hot:
        return _by_window(df, key, value, tie, nth, names)
    split, light = flagged(df, key, _parts=hot), F.col("_parts").isNull()
    rest = _by_window(split.filter(light).drop("_parts"), key, value, tie, nth, names)
    heavy = _by_ranges(split.filter(~light).drop("_parts"), key, value, tie, nth, names, ranges)
    return rest.unionByName(heavy)


def _by_window(df, key, value, tie, nth, names: RankNames) -> DataFrame:
    # Both orders share the partitioning; Spark sorts (value, tie) once for both.
    peers = Window.partitionBy(key).orderBy(value)
    rows = Window.partitionBy(key).orderBy(value, tie)
    return df.select(
        "*",
        F.row_number().over(rows).cast("long").alias(names.row_number),
        F.rank().over(peers).cast("long").alias(names.rank),
        F.dense_rank().over(peers).cast("long").alias(names.dense_rank),
        F.cume_dist().over(peers).alias(names.cume_dist),
        F.first(value).over(peers).alias(names.first),
        F.nth_value(value, nth).over(peers).alias(names.nth),
        F.lead(value).over(rows).alias(names.next),
        F.lag(value).over(rows).alias(names.prev),
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _by_ranges(df, key, value, tie, nth, names: RankNames, ranges: int | None) -> DataFrame:
    """Sort heavy keys across many tasks, rank inside each range, add what came before.

    1. Range-partition by (key, value, tie) and write once, with the range
       number; the written table pins the ranges for every later read.
    2. Rank inside each (range, key).
    3. One summary row per (range, key) - ranges plus keys in number - gives the
       rows and distinct values before it, and the ends its peers reach.
    """
    order = [F.col(key).asc_nulls_first(), F.col(value).asc_nulls_first(), F.col(tie).asc_nulls_first()]
    split = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    fixed = pinned(split.withColumn("_range", F.spark_partition_id()), "ranges")

    peers = Window.partitionBy("_range", key).orderBy(value)
    rows = Window.partitionBy("_range", key).orderBy(value, tie)
    local = fixed.select(
        "*",
        F.row_number().over(rows).cast("long").alias("_rn"),
        F.rank().over(peers).cast("long").alias("_rank"),
        F.dense_rank().over(peers).cast("long").alias("_dense"),
        F.count(F.lit(1)).over(peers).alias("_upto"),
        F.lead(value).over(rows).alias("_next"),
        F.lag(value).over(rows).alias("_prev"),
    )

    summary = _range_summary(fixed, key, value, nth)
    here = summary.select(
        F.col("_range").alias("_srange"), F.col(key).alias("_skey"),
        "_off", "_n", "_doff", "_lo", "_hi", "_lo_start", "_hi_end", "_total", "_first", "_nth", "_before", "_after",
    )
    # The summary has at most (ranges + heavy keys) rows; Spark broadcasts it by its size.
    joined = local.join(
        here, (F.col("_range") == F.col("_srange")) & _same(F.col(key), F.col("_skey"))
    )
    last = F.when(_same(F.col(value), F.col("_hi")), F.col("_hi_end")).otherwise(F.col("_off") + F.col("_upto"))
    return joined.select(
        *df.columns,
        (F.col("_off") + F.col("_rn")).alias(names.row_number),
        F.when(_same(F.col(value), F.col("_lo")), F.col("_lo_start"))
        .otherwise(F.col("_off") + F.col("_rank")).alias(names.rank),
        (F.col("_doff") + F.col("_dense")).alias(names.dense_rank),
        (last / F.col("_total")).alias(names.cume_dist),
        F.col("_first").alias(names.first),
        F.when(last >= nth, F.col("_nth")).alias(names.nth),
        F.when(F.col("_rn") == F.col("_n"), F.col("_after")).otherwise(F.col("_next")).alias(names.next),
        F.when(F.col("_rn") == 1, F.col("_before")).otherwise(F.col("_prev")).alias(names.prev),
    )


def _range_summary(rows: DataFrame, key: str, value: str, nth: int) -> DataFrame:
    """One row per (range, key): what lies in it, before it and after it."""
    # Equal values are counted first, so a value with many copies stays one row.
    # Read three times below, so written once.
    counted = pinned(rows.groupBy("_range", key, value).agg(F.count(F.lit(1)).alias("_c")), "range-counts")
    # struct(flag, value) orders nulls first, as the window does.
    entry = F.struct(F.col(value).isNotNull().cast("int").alias("f"), F.col(value).alias("v"), F.col("_c").alias("c"))
    per_range = counted.groupBy("_range", key).agg(
        F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d"),
        F.min(entry).alias("_lo_e"), F.max(entry).alias("_hi_e"),
    )
    in_order = Window.partitionBy(key).orderBy("_range")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    ends = per_range.select(
        "_range", key, "_n", "_d",
        F.col("_lo_e.v").alias("_lo"), F.col("_hi_e.v").alias("_hi"),
        F.col("_lo_e.c").alias("_lo_c"), F.col("_hi_e.c").alias("_hi_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("_total"),
        F.lag(F.col("_hi_e.v")).over(in_order).alias("_before"),
        F.lead(F.col("_lo_e.v")).over(in_order).alias("_after"),
        F.row_number().over(in_order).alias("_pos"),
    )
    # A range that starts with the value the previous one ended on repeats it.
    shared = F.when((F.col("_pos") > 1) & _same(F.col("_lo"), F.col("_before")), 1).otherwise(0)
    upto_here = in_order.rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("_shared", shared).withColumn(
        "_doff", F.coalesce(F.sum("_d").over(before), F.lit(0)) - F.sum("_shared").over(upto_here)
    )
    # Peers of a border value may lie in several ranges: their first and last row.
    starts = F.struct(F.col("_lo").alias("v"), (F.col("_off") + 1).alias("s"), (F.col("_off") + F.col("_lo_c")).alias("e"))
    stops = F.struct(
        F.col("_hi").alias("v"), (F.col("_off") + F.col("_n") - F.col("_hi_c") + 1).alias("s"),
        (F.col("_off") + F.col("_n")).alias("e"),
    )
    peers = (
        ends.select(F.col(key).alias("_pkey"), F.inline(F.array(starts, stops)))
        .groupBy("_pkey", "v").agg(F.min("s").alias("_start"), F.max("e").alias("_end"))
    )
    low = peers.select(F.col("_pkey").alias("_lkey"), F.col("v").alias("_lv"), F.col("_start").alias("_lo_start"))
    high = peers.select(F.col("_pkey").alias("_hkey"), F.col("v").alias("_hv"), F.col("_end").alias("_hi_end"))
    ends = ends.join(low, _same(F.col(key), F.col("_lkey")) & _same(F.col("_lo"), F.col("_lv")))
    ends = ends.join(high, _same(F.col(key), F.col("_hkey")) & _same(F.col("_hi"), F.col("_hv")))
    fixed = _first_and_nth(counted, key, value, nth)
    return ends.join(fixed, _same(F.col(key), F.col("_fkey")))


def _first_and_nth(counted: DataFrame, key: str, value: str, nth: int) -> DataFrame:
    """Lowest and n-th value per key, from the n smallest values of each range."""
    entry = F.struct(F.col(value).isNotNull().cast("int").alias("f"), F.col(value).alias("v"), F.col("_c").alias("c"))
    low_in_range = Window.partitionBy("_range", key).orderBy(F.col(value).asc_nulls_first())
    # Spark keeps only the first n rows of each window group for this filter.
    lowest = counted.withColumn("_p", F.row_number().over(low_in_range)).filter(F.col("_p") <= nth)
    merged = lowest.groupBy(F.col(key).alias("_fkey")).agg(F.sort_array(F.collect_list(entry)).alias("_es"))
    # Walk the sorted (value, count) entries until n rows have passed.
    walked = F.aggregate(
        "_es",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast(counted.schema[value].dataType).alias("v")),
        lambda acc, e: F.struct(
            (acc["seen"] + e["c"]).alias("seen"),
            F.when((acc["seen"] < nth) & (acc["seen"] + e["c"] >= nth), e["v"]).otherwise(acc["v"]).alias("v"),
        ),
    )
    return merged.select("_fkey", F.col("_es")[0]["v"].alias("_first"), walked["v"].alias("_nth"))
