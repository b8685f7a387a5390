"""Packing: optimal length buckets and token-budget batches.

The global histogram of document lengths (in tokens, or a given column) is an aggregate; dynamic programming
over it chooses at most ``buckets`` upper bounds so that padding every document to the
bound of its bucket adds the fewest tokens. Inside each bucket documents fill batches of
``budget`` padded tokens: bound * rows <= budget, at least one row.

A token is a word, or each ``PIECE`` characters of a longer run without white space, so that the
budget bounds the batches of unbroken texts too. The histogram has a row for each distinct
length, so the bounds are the optimal ones; ``rounded`` (off by default) takes cells instead,
exact up to ``CELLS_EXACT`` and within 1/64 of the length beyond. Row numbers inside a bucket come from counts of hash parts and numbers inside each
part: no bucket is ever sorted in one task, and only its last batch is not full.

Null and empty texts have length 0 and are packed with the shortest; a text longer than the
budget is a batch of its own. Ties are broken by the hash of the whole row's key and text;
repeated rows are packed each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import parts_for, stored, table
from stratamart.llm.registry import query

BUCKETS = 16
BUDGET = 8192
CELLS_EXACT = 256
#: Longest run of characters that is one token.
PIECE = 16
#: Documents that one task numbers.
PART_ROWS = 200_000


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^\\x20\\x09-\\x0D]{{1,{PIECE}}}"))


def cell(length: Column) -> Column:
    """Upper end of a length's cell."""
    # The cell is 1/64 of the power of two at or below the length.
    width = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))) - 6))
    return F.when(length <= CELLS_EXACT, length).otherwise((F.ceil(length / width) * width)).cast("long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bounds of the buckets with the least padding; lengths ascend, the last is the last bound.

    cost[k][j]: least padded total of the first j lengths in k buckets, and the last bucket of
    k that ends at j begins after the best i. The best i never moves back as j grows, so each
    layer is filled by halving, all halves of a depth at once.
    """
    n = len(lengths)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    choices = []
    for _ in range(min(buckets, n)):
        new, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        a, b, low, high = (np.array([x]) for x in (1, n, 0, n - 1))
        while len(a):
            j = (a + b) // 2
            size = np.minimum(high, j - 1) - low + 1
            begin = np.cumsum(size) - size
            nth = np.repeat(np.arange(len(j)), size)
            i = np.arange(len(nth)) - begin[nth] + low[nth]
            value = cost[i] + lengths[j - 1][nth] * (total[j][nth] - total[i])
            least = np.minimum.reduceat(value, begin)
            ties = np.flatnonzero(value == least[nth])
            best = i[ties[np.searchsorted(nth[ties], np.arange(len(j)))]]
            new[j], choice[j] = least, best
            a, b = np.concatenate([a, j + 1]), np.concatenate([j - 1, b])
            low, high = np.concatenate([low, best]), np.concatenate([best, high])
            some = a <= b
            a, b, low, high = a[some], b[some], low[some], high[some]
        choices.append(choice)
        cost = new
    bounds, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return bounds[::-1]


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET,
         length: str | None = None, rounded: bool = False) -> DataFrame:
    """(key, n_tokens, bucket, bound, batch, slot) of every document.

    ``bucket`` counts from 0, ``bound`` is its padded length, ``batch`` counts from 0 inside
    the bucket and ``slot`` inside the batch. ``n_tokens`` is the column ``length`` (null counts as 0)
    where given, else the text's tokens.
    """
    tokens = token_count(F.col(f"`{text}`").cast("string")) if length is None else F.coalesce(F.col(f"`{length}`"), F.lit(0))
    rows = docs.select(
        F.col(f"`{key}`").alias("__key"), tokens.cast("long").alias("n_tokens"),
        F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).alias("__h"))
    # Read several times; written once, without the texts.
    rows = stored(rows, "packing-lengths")
    lengths = cell(F.col("n_tokens")) if rounded else F.col("n_tokens")
    histogram = rows.withColumn("cell", lengths).groupBy("cell").agg(F.count("*").alias("n"), F.max("n_tokens").alias("most")).orderBy("cell").toPandas()
    bounds = best_bounds(histogram["most"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64), buckets)
    if not bounds:
        return rows.select(F.col("__key").alias(key), "n_tokens", F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("bound"),
                           F.lit(0).cast("long").alias("batch"), F.lit(0).cast("int").alias("slot"))
    parts = parts_for(int(histogram["n"].sum()), PART_ROWS)
    limits = F.array(*[F.lit(b).cast("long") for b in bounds])
    placed = rows.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("n_tokens")))).withColumn(
        "part", F.pmod(F.col("__h"), F.lit(parts)).cast("int"))
    # One row for each bucket and part; the rows before each part are a running sum.
    counts = placed.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("bucket", "part", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("bucket", "part").orderBy("__h", "__key"))
    numbered = placed.withColumn("inside", inside).join(counts, ["bucket", "part"])
    bound = F.element_at(limits, F.col("bucket") + 1)
    size = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(bound, F.lit(1)))).cast("long")
    at = F.col("before") + F.col("inside") - 1
    return numbered.select(
        F.col("__key").alias(key), "n_tokens", "bucket", bound.alias("bound"),
        F.floor(at / size).cast("long").alias("batch"), (at % size).cast("int").alias("slot"))


@query()
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Bucket, batch and place in it of every document."""
    return pack(table(spark, folder, "documents"))
