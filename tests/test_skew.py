"""Skew-safe joins and windows give the rows of the plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from stratamart.operators.joins import full_join, inner_join, left_join, semi_join
from stratamart.operators.ranking import rank_within
from stratamart.operators.skew import NO_HOT_KEYS, HotKeys, find_all_hot_keys, find_hot_keys
from tests.conftest import rows

LEFT = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (5, "f"), (9, "g"), (9, "g"), (9, "g")]
RIGHT = [(1, "p"), (1, "q"), (1, "q"), (3, "r"), (None, "s"), (9, "t"), (5, "u"), (5, "u"), (7, "v"), (7, "w")]


@pytest.fixture(scope="module")
def sides(spark):
    many_left = LEFT + [(1, f"x{i % 7}") for i in range(60)]
    many_right = RIGHT + [(7, f"y{i % 5}") for i in range(60)] + [(5, "z")] * 30
    return (
        spark.createDataFrame(many_left, "lk bigint, lv string").repartition(4),
        spark.createDataFrame(many_right, "rk bigint, rv string").repartition(4),
    )


HOT = [HotKeys(), HotKeys((1,)), HotKeys((1, 9, None)), HotKeys((2, 5, 1))]
PAIRS = [
    (HotKeys(), HotKeys()), (HotKeys((1,)), HotKeys()), (HotKeys((1, 9, None)), HotKeys((5, 7))),
    (HotKeys(), HotKeys((3, 9))), (HotKeys((2, 5, 1)), HotKeys((1, None))),
]


@pytest.mark.parametrize("hot_left, hot_right", PAIRS)
def test_left_join(sides, hot_left, hot_right):
    left, right = sides
    plain = left.join(right, F.col("lk") == F.col("rk"), "left")
    assert rows(left_join(left, right, "lk", "rk", hot_left, hot_right, salts=5)) == rows(plain)


@pytest.mark.parametrize("hot_left, hot_right", PAIRS)
def test_full_join(sides, hot_left, hot_right):
    left, right = sides
    plain = left.join(right, F.col("lk") == F.col("rk"), "full")
    assert rows(full_join(left, right, "lk", "rk", hot_left, hot_right, salts=5)) == rows(plain)


@pytest.mark.parametrize("hot", HOT)
def test_inner_join(sides, hot):
    left, right = sides
    plain = left.join(right, F.col("lk") == F.col("rk"))
    assert rows(inner_join(left, right, "lk", "rk", hot, salts=5)) == rows(plain)


def test_semi_join_on_two_columns(spark):
    a = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x")], "p string, q string")
    b = spark.createDataFrame([("a", "bc"), ("a", "bc"), (None, "x")], "r string, s string")
    # Concatenated keys would confuse ('ab','c') with ('a','bc').
    assert rows(semi_join(a, b, ["p", "q"], ["r", "s"])) == [("a", "bc")]


def test_hot_key_detection(spark):
    df = spark.range(90000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("decimal(38,9)").alias("k"),
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("n"),
    )
    hot = find_all_hot_keys(df, "k", "n", min_rows=1000)
    assert [int(v) for v in hot["k"].values] == [7]
    assert hot["n"].values == (None,)
    assert not find_hot_keys(df, "k", min_rows=10**6)
    assert df.filter(hot["k"].holds(F.col("k"))).count() == 30001
    assert df.filter(~hot["n"].holds(F.col("n"))).count() == 60000
    assert not find_hot_keys(df.limit(0), "k", min_rows=1)


@pytest.mark.parametrize("seed, spread, ranges", [(1, 3, 16), (2, 1, 3), (3, 40, 16), (4, 2, 1), (5, 100000, 3)])
def test_ranking_by_ranges_equals_windows(spark, seed, spread, ranges):
    rng = random.Random(seed)
    data = [
        (rng.choice([None, 1, 1, 1, 2, 3]), i, None if rng.random() < 0.1 else float(rng.randrange(spread)))
        for i in range(300)
    ] + [(8, 1000, 5.0), (9, 1001, None)]
    df = spark.createDataFrame(data, "custno bigint, txnno bigint, amount double").repartition(5)
    everything = HotKeys((None, 1, 2, 3, 8, 9))
    plain = rank_within(df, "custno", "amount", "txnno")
    assert plain.count() == len(data)
    assert rows(rank_within(df, "custno", "amount", "txnno", hot=everything, ranges=ranges)) == rows(plain)
    some = rank_within(df, "custno", "amount", "txnno", hot=HotKeys((1, None)), ranges=ranges)
    assert rows(some) == rows(plain)


def test_ranking_values(spark):
    data = [(1, 1, 10.0), (1, 2, 20.0), (1, 3, 20.0), (1, 4, 30.0), (2, 5, 7.0)]
    df = spark.createDataFrame(data, "custno bigint, txnno bigint, amount double")
    assert rows(rank_within(df, "custno", "amount", "txnno").drop("amount")) == sorted([
        (1, 1, 1, 1, 1, 0.25, 10.0, None, 20.0, None),
        (1, 2, 2, 2, 2, 0.75, 10.0, 20.0, 20.0, 10.0),
        (1, 3, 3, 2, 2, 0.75, 10.0, 20.0, 30.0, 20.0),
        (1, 4, 4, 4, 3, 1.0, 10.0, 20.0, None, 20.0),
        (2, 5, 1, 1, 1, 1.0, 7.0, None, None, None),
    ], key=repr)


@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys((3,), (2,))])
def test_join_that_fans_out_keeps_its_partitions(spark, hot):
    """Little is shuffled and much comes out, so partitions merged by the bytes shuffled would make one large task."""
    left = spark.range(400).selectExpr("id % 40 AS k", "id AS a")
    right = spark.range(400).selectExpr("id % 50 AS j", "id AS b")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = left_join(left, right, "k", "j", hot_right=hot, fans_out=True)
        plain = left_join(left, right, "k", "j")
        assert many.groupBy(F.spark_partition_id()).count().count() > plain.groupBy(F.spark_partition_id()).count().count()
        assert rows(many) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
