import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import top_inner as T


def brute(rows, modulus, k):
    usable = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in usable:
        if q % modulus == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("skewed", [False, True])
def test_equals_brute_force(spark, monkeypatch, skewed):
    monkeypatch.setattr(T, "BUCKET", 32)
    monkeypatch.setattr(T, "QUERIES", 8)
    dice = random.Random(skewed)
    centre = [dice.gauss(0, 1) for _ in range(8)]
    rows = []
    for i in range(400):
        scale = math.exp(dice.gauss(0, 1.5)) if skewed else 1
        v = [scale * (dice.gauss(0, 0.3) + (c if skewed and i % 3 == 0 else 0)) for c in centre]
        rows.append((i, v))
    rows += [(1000 + i, [0.5] * 8) for i in range(100)]  # one common vector: ties
    rows += [(2000, [0.0] * 8), (2020, [-1.0] * 8), (2040, None), (2060, [None] + [1.0] * 7), (2080, [float("nan")] * 8),
             (2100, [float("inf")] * 8), (None, [1.0] * 8), (2120, [2.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = T.top_inner(frame, F.col("vec_id") % 20 == 0, 20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 20)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [-3.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, T.top_inner(frame, F.col("vec_id") % 20 == 0, 20).collect())) == [
        (0, 1, 1, 64 * 128), (0, 2, 20, -64 * 192), (20, 1, 0, -64 * 192), (20, 2, 1, -128 * 192)]
    assert T.top_inner(frame.limit(0), F.lit(True), 5).count() == 0


def test_pruning_keeps_the_best():
    dice = np.random.default_rng(1)
    p = np.rint(dice.normal(size=(300, 6)) * dice.lognormal(0, 1, (300, 1)) * 50).astype(int)
    p = p[np.argsort(-(p**2).sum(1), kind="stable")]
    q = np.rint(dice.normal(size=(40, 6)) * 30).astype(int)
    floor = np.sort(q @ p.T, axis=1)[:, -10].astype(float)
    i, j, s = T.scores_in(np.arange(40) + 1000, q, np.arange(300), p, 10, floor, float(np.sqrt((p**2).sum(1).max())))
    for n in range(40):
        want = np.lexsort((np.arange(300), -(q[n] @ p.T)))[:10]
        mine = i == n
        order = np.lexsort((j[mine], -s[mine]))
        assert j[mine][order].tolist() == want.tolist()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_large_components(spark, monkeypatch, kind):
    """Components of 1e6 and more take part, and scores beyond 2**53 are exact to the last unit."""
    monkeypatch.setattr(T, "BUCKET", 32)
    monkeypatch.setattr(T, "QUERIES", 8)
    dice = random.Random(5)
    rows = [(i, [dice.gauss(0, 0.3) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, [dice.gauss(0, 1) * 10 ** dice.uniform(4, 7) for _ in range(8)]) for i in range(150)]
    rows += [(400 + i, [float(2**20)] * 8) for i in range(30)]
    # Products that differ by less than doubles of their size can hold.
    rows += [(500 + i, [1e7] * 7 + [1e7 + dice.randint(-9, 9) / 64]) for i in range(60)]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = sorted(map(tuple, T.top_inner(frame, F.col("vec_id") % 20 == 0, 20).collect()))
    assert got == brute(rows, 20, 20)
    assert any(abs(s) > 2**53 for *_, s in got)


def test_scores_beyond_64_bits_stop(spark):
    frame = spark.createDataFrame([(0, [1e300, 0.0]), (1, [0.0, 1.0]), (20, [0.0, 3.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, T.top_inner(frame, F.col("vec_id") == 0, 2).collect())) == [(0, 1, 1, 0), (0, 2, 20, 0)]
    with pytest.raises(Exception, match="does not fit a 64-bit integer"):
        T.top_inner(frame.union(frame.selectExpr("vec_id + 2", "embedding")), F.col("vec_id") == 0, 2).collect()
