"""Dense keys: unique, without gaps, stable."""

from stratamart.plans import key_maps
from tests.conftest import rows


def numbers(spark, name):
    return {(r.a, r.b): r.sk for r in spark.table(name).collect()}


def test_dense_unique_and_stable(spark, db):
    name = f"{db}.map"
    data = [(i % 500, f"x{i % 3}") for i in range(4000)] + [(None, "x"), (None, "x"), (1, None)]
    first = spark.createDataFrame(data, "a long, b string").repartition(7)
    assert key_maps.extend_key_map(first, name, "a", "b", ranges=5) == len(set(data))
    one = numbers(spark, name)
    assert sorted(one.values()) == list(range(1, len(set(data)) + 1))
    assert key_maps.extend_key_map(first, name, "a", "b") == 0 and numbers(spark, name) == one
    more = spark.createDataFrame([(9000 + i % 40, "y") for i in range(100)] + data[:50], "a long, b string")
    assert key_maps.extend_key_map(more, name, "a", "b", ranges=3) == 40
    two = numbers(spark, name)
    assert {k: two[k] for k in one} == one and sorted(two.values()) == list(range(1, len(one) + 41))
    joined = key_maps.with_dense_key(first, name, "a", "b")
    assert joined.count() == len(data) and {(r.a, r.b): r.sk for r in joined.collect()} == one


def test_no_rows(spark, db):
    none = spark.createDataFrame([], "a long, b string")
    assert key_maps.extend_key_map(none, f"{db}.m", "a", "b") == 0 and key_maps.extend_key_map(none, f"{db}.m", "a", "b") == 0
    assert rows(spark.table(f"{db}.m")) == []
    assert key_maps.extend_key_map(spark.createDataFrame([(1, "q")], none.schema), f"{db}.m", "a", "b") == 1
    assert rows(spark.table(f"{db}.m")) == [(1, "q", 1)]
