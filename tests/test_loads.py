from datetime import date

import pytest
from pyspark.sql import functions as F

from stratamart.sinks import tables
from stratamart.sinks.upsert import AmbiguousMatch, snapshot_type2, upsert_type1
from tests.conftest import rows

D1, D2, D3 = date(2025, 7, 1), date(2025, 7, 2), date(2025, 7, 3)


def frame(spark, data, ddl="custno bigint, name string, datadt date"):
    return spark.createDataFrame(data, ddl)


@pytest.fixture
def target(spark, db):
    name = f"{db}.t"
    tables.create_table(spark, name, "custno BIGINT, name STRING, datadt DATE", "datadt")
    return name


def test_partition_reload(spark, target):
    tables.reload_partition(frame(spark, [(1, "a", D1)]), target, "datadt", D1)
    tables.reload_partition(frame(spark, [(2, "b", D2)]), target, "datadt", D2)
    tables.reload_partition(frame(spark, [(3, "c", D2)]), target, "datadt", D2)
    tables.reload_partition(frame(spark, [(3, "c", D2)]), target, "datadt", D2)
    assert rows(spark.table(target)) == [(1, "a", D1), (3, "c", D2)]
    # An empty source empties the day and nothing else.
    tables.reload_partition(frame(spark, []), target, "datadt", D2)
    assert rows(spark.table(target)) == [(1, "a", D1)]


def test_reload_matches_columns_by_name(spark, target):
    tables.reload_partition(frame(spark, [(1, "a", D1)]).select("datadt", "name", "custno"), target, "datadt", D1)
    assert rows(spark.table(target)) == [(1, "a", D1)]


def test_append_doubles_on_rerun_and_by_position_swaps(spark, db):
    name = f"{db}.a"
    tables.create_table(spark, name, "x STRING, y STRING")
    df = spark.createDataFrame([("1", "2")], "y string, x string")
    tables.append_rows(df, name)
    tables.append_rows(df, name)
    assert rows(spark.table(name)) == [("2", "1"), ("2", "1")]
    tables.append_rows(df, name, by_position=True)
    assert rows(spark.table(name))[0] == ("1", "2")


def test_refresh_and_truncate(spark, db):
    name = f"{db}.r"
    tables.refresh_table(spark.range(3), name)
    tables.refresh_table(spark.range(2).selectExpr("id", "'x' z"), name)
    assert spark.table(name).columns == ["id", "z"] and spark.table(name).count() == 2
    tables.truncate_and_insert(spark.range(5).selectExpr("'q' z", "id"), name)
    assert spark.table(name).filter("z = 'q'").count() == 5
    tables.delete_all(spark, name)
    assert spark.table(name).count() == 0


def test_ingest_day_and_dynamic_append(spark, db):
    name = f"{db}.m"
    tables.append_by_ingest_day(spark.range(2), name, D1)
    tables.append_by_ingest_day(spark.range(1), name, D1)
    tables.append_by_ingest_day(spark.range(1), name, D2)
    assert tables.partition_values(spark, name) == {"2025-07-01", "2025-07-02"}
    assert spark.table(name).count() == 4


def test_clone_and_subset(spark, db):
    df = spark.createDataFrame([("Furniture", 1), ("Laptop", 2), (None, 3)], "c string, i int")
    tables.clone_schema(df, f"{db}.c")
    assert spark.table(f"{db}.c").count() == 0 and spark.table(f"{db}.c").columns == ["c", "i"]
    for _ in range(2):
        tables.load_subset(df, f"{db}.c", F.col("c") == "Furniture")
    assert rows(spark.table(f"{db}.c")) == [("Furniture", 1)]


def test_cluster_rows_spreads_a_hot_key(spark):
    df = spark.range(10000).selectExpr("if(id % 3 = 0, 7, id) custno", "id txnno")
    out = tables.cluster_rows(df, "custno", "txnno", parts=8)
    assert out.filter("custno = 7").select(F.spark_partition_id()).distinct().count() > 1


def test_delete_and_update(spark, target, db):
    data = [(1, "a", D1), (2, None, D1), (3, "c", D2), (4, "d", D3)]
    tables.append_rows(frame(spark, data), target)
    tables.delete_where(spark, target, F.col("name") == "c")
    assert rows(spark.table(target)) == [(1, "a", D1), (2, None, D1), (4, "d", D3)]
    assert tables.partition_values(spark, target) == {"2025-07-01", "2025-07-03"}
    tables.update_where(spark, target, F.col("custno") == 2, {"name": "b"})
    assert rows(spark.table(target)) == [(1, "a", D1), (2, "b", D1), (4, "d", D3)]
    with pytest.raises(ValueError):
        tables.update_where(spark, target, F.lit(True), {"datadt": D1})
    plain = f"{db}.etl_meta"
    tables.refresh_table(spark.createDataFrame([(3, "x"), (4, "y")], "id bigint, rulesql string"), plain)
    tables.update_where(spark, plain, F.col("id") == 3, {"rulesql": "z"})
    tables.delete_where(spark, plain, F.col("id") == 4)
    assert rows(spark.table(plain)) == [(3, "z")]


def test_null_partition_is_replaced(spark, target):
    tables.append_rows(frame(spark, [(1, "a", None), (2, "b", None), (3, "c", D1)]), target)
    tables.delete_where(spark, target, F.col("custno") == 1)
    assert rows(spark.table(target)) == [(2, "b", None), (3, "c", D1)]
    tables.delete_where(spark, target, F.col("custno") == 2)
    assert rows(spark.table(target)) == [(3, "c", D1)]


def test_partition_values_with_special_characters(spark, db):
    name = f"{db}.s"
    tables.refresh_table(spark.createDataFrame([(1, "a:b/c"), (2, "it's"), (3, "x y")], "i int, p string"), name, "p")
    assert tables.partition_values(spark, name) == {"a:b/c", "it's", "x y"}
    tables.update_where(spark, name, F.col("i") == 1, {"i": 10})
    tables.delete_where(spark, name, F.col("i") == 2)
    assert rows(spark.table(name)) == [(10, "a:b/c"), (3, "x y")]
    assert tables.partition_values(spark, name) == {"a:b/c", "x y"}


def test_upsert_moves_updates_inserts(spark, target):
    tables.append_rows(frame(spark, [(1, "chn", D1), (2, "mum", D1), (9, "old", D3)]), target)
    upsert_type1(frame(spark, [(1, "blr", D2), (3, "hyd", D2)]), target)
    assert rows(spark.table(target)) == [(1, "blr", D2), (2, "mum", D1), (3, "hyd", D2), (9, "old", D3)]
    # Rerun gives the same table; emptying a day drops its partition.
    upsert_type1(frame(spark, [(1, "blr", D2), (3, "hyd", D2)]), target)
    upsert_type1(frame(spark, [(2, "pun", D2)]), target)
    assert rows(spark.table(target)) == [(1, "blr", D2), (2, "pun", D2), (3, "hyd", D2), (9, "old", D3)]
    assert tables.partition_values(spark, target) == {"2025-07-02", "2025-07-03"}


def test_upsert_edge_cases(spark, target):
    tables.append_rows(frame(spark, [(1, "a", D1), (1, "b", D2), (None, "n", D1)]), target)
    # Both target rows of a matched key change; null keys never match; unmatched copies are all inserted.
    upsert_type1(frame(spark, [(1, "z", D3), (None, "m", D3), (5, "p", D3), (5, "q", D3)]), target)
    assert rows(spark.table(target)) == sorted(
        [(1, "z", D3), (1, "z", D3), (None, "n", D1), (None, "m", D3), (5, "p", D3), (5, "q", D3)], key=repr
    )
    before = rows(spark.table(target))
    with pytest.raises(AmbiguousMatch):
        upsert_type1(frame(spark, [(1, "y", D3), (1, "x", D3)]), target)
    upsert_type1(frame(spark, []), target)
    assert rows(spark.table(target)) == before
    assert spark.sql("SHOW TABLES IN stratamart_staging").filter("tableName like 'stage%'").count() == 0


def test_snapshots(spark, target):
    snapshot_type2(frame(spark, [(1, "chn", D1), (2, "mum", D1)]), target, D1)
    for _ in range(2):
        snapshot_type2(frame(spark, [(1, "blr", D2), (3, "hyd", D2)]), target, D2)
    assert rows(spark.table(target)) == [(1, "blr", D2), (1, "chn", D1), (2, "mum", D1), (3, "hyd", D2)]
