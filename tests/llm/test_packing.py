import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import packing as P


def test_bounds_are_optimal():
    dice = np.random.default_rng(2)
    for _ in range(40):
        n, k = int(dice.integers(1, 9)), int(dice.integers(1, 5))
        lengths = np.sort(dice.choice(60, n, replace=False))
        counts = dice.integers(1, 20, n)

        def padded(bounds):
            return sum(int(c) * min(b for b in bounds if b >= x) for x, c in zip(lengths, counts))

        got = P.best_bounds(lengths, counts, k)
        assert got[-1] == lengths[-1] and len(got) <= k and got == sorted(got)
        best = min(padded([*map(int, some), int(lengths[-1])]) for r in range(min(k, n)) for some in combinations(lengths[:-1], r))
        assert padded(got) == best


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_ROWS", 50)
    dice = random.Random(1)
    rows = [(i, " ".join(["w"] * int(dice.expovariate(0.01)))) for i in range(600)]
    rows += [(1000 + i, "same text of five words") for i in range(300)]  # a hot length
    rows += [(2000, None), (2001, ""), (2002, "x " * 30000), (None, "a b"), (None, "a b"), (7, "a b")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, bucket int").repartition(5)
    out = P.pack(docs, buckets=6, budget=400).toPandas()
    assert list(out.columns) == ["doc_id", "n_tokens", "bucket", "bound", "batch", "slot"]
    assert sorted(out.n_tokens) == sorted(len((t or "").split()) for _, t in rows)
    assert (out.n_tokens <= out.bound).all() and out.bucket.nunique() <= 6
    for (bucket, bound), group in out.groupby(["bucket", "bound"]):
        size = max(1, 400 // max(1, bound))
        fill = group.groupby("batch").slot.agg(["count", "max", "nunique"])
        assert (fill["nunique"] == fill["count"]).all() and (fill["max"] == fill["count"] - 1).all()
        assert sorted(fill.index) == list(range(len(fill))) and (fill["count"].sort_index().iloc[:-1] == size).all()
        assert fill["count"].max() <= size


def test_budget_bounds_unbroken_texts_and_many_lengths(spark):
    """Texts without blanks have their real size, and bounds are exact for any number of lengths."""
    docs = spark.createDataFrame([(i, "x" * 30_000) for i in range(5)] + [(9, "é" * 33 + " " + "y" * 16)], "doc_id long, text string")
    out = P.pack(docs, budget=4000).toPandas()
    assert sorted(out.n_tokens) == [4] + [1875] * 5 and out[out.n_tokens > 4].groupby("batch").size().max() == 2
    lengths = spark.range(300_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") * 3 + 1).alias("n"))
    bounds = {r.bound for r in P.pack(lengths, length="n", buckets=2).select("bound").distinct().collect()}
    # Equal counts of evenly spaced lengths: two halves.
    assert bounds == {3 * 149_999 + 1, 3 * 299_999 + 1}


@pytest.mark.parametrize("length", [0, 1, 255, 256, 257, 300, 511, 512, 513, 1000, 65_537, 10_000_000])
def test_cells(spark, length):
    got = spark.range(1).select(P.cell(F.lit(length).cast("long"))).first()[0]
    assert length <= got <= length + max(0, length // 64)


def test_empty(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_lengths_are_packed_at_the_optimum(spark):
    """Lengths that one cell would hold together; rounded, the cells bound the excess."""
    lengths = [300] * 9 + [301] * 50 + [302] * 2 + [303] * 40 + [1000, 1003, 1010] * 5 + [1015]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    distinct = sorted(set(lengths))
    padded = lambda bounds: sum(min(b for b in bounds if b >= x) for x in lengths)
    best = min(padded([*some, distinct[-1]]) for r in range(4) for some in combinations(distinct[:-1], r))
    assert sum(r.bound for r in P.pack(docs, buckets=4).collect()) == best
    assert best <= sum(r.bound for r in P.pack(docs, buckets=4, rounded=True).collect()) <= best * 65 / 64


def test_given_lengths_bound_the_batches(spark):
    """Texts without white space: their token counts, not their one word, fill the budget."""
    docs = spark.createDataFrame([(i, "x" * 3000, 3000) for i in range(10)] + [(20, None, None)], "doc_id long, text string, n_ids int")
    out = P.pack(docs, buckets=2, budget=8192, length="n_ids").toPandas()
    assert sorted(out.n_tokens) == [0] + [3000] * 10
    assert out.groupby(["bucket", "batch"]).n_tokens.sum().max() == 6000
