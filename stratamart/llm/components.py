"""Connected components of a link table by alternating star contraction.

Each round hangs the neighbours of a node on its smallest neighbour, first those above
the node, then those below it. The table keeps at most its size and ends as stars. Every
round is written to the shared folder; only a count and a hash sum, observed on that write,
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import drop_stored, stored, stored_with


def _turned(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _turned(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a")
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """The links, written, with their number and a hash sum observed on the way."""
    return stored_with(links, "links", n=F.count(F.lit(1)), total=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node. ``links`` has (a, b)."""
    found = _stars(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0) if found is None else found


def _stars(links: DataFrame) -> DataFrame | None:
    current, state = _written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while state["n"]:
        (following, after), before = _written(_small_star(_large_star(current))), state
        drop_stored(current)
        current, state = following, after
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    drop_stored(current)
    return None


def merged(known: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """The components of ``known`` and more links, None without any: only links between components of ``known`` are contracted."""
    if known is None:
        return _stars(links)
    for side in "ab":
        of = known.select(F.col("node").alias(side), F.col("component").alias("__of"))
        links = links.join(of, side, "left").withColumn(side, F.coalesce("__of", side)).drop("__of")
    more = _stars(links)
    if more is None:
        return known
    onward = more.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    moved = known.join(onward, "component", "left").select("node", F.coalesce("__to", "component").alias("component"))
    fresh = more.join(known.select("node"), "node", "left_anti")
    return stored(moved.unionByName(fresh), "components")
