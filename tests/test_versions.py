"""Versioned tables: one-step publication under failure, readers during a swap; plain tables that lose no rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stratamart.plans import customer_changes as changes
from stratamart.session import child_names
from stratamart.sinks import tables, versions
from stratamart.sinks.upsert import upsert_type1
from tests.conftest import rows

COLUMNS = "k long, v string, day date"
D1, D2, D3 = date(2025, 3, 1), date(2025, 3, 2), date(2025, 3, 3)


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS)


@pytest.fixture
def table(spark, db):
    name = f"{db}.t"
    versions.create_versioned(spark, name, COLUMNS, "day")
    versions.publish(frame(spark, [(1, "a", D1), (2, "b", D1), (3, "c", D2), (4, "n", None)]), name, [D1, D2, None])
    return name


def content(spark, name):
    return rows(spark.table(name))


def test_untouched_partitions_are_taken_over_without_a_copy(spark, table):
    before = versions._folders(spark, versions.current_version(spark, table))
    versions.publish(frame(spark, [(9, "x", D2)]), table, [D2])
    after = versions._folders(spark, versions.current_version(spark, table))
    assert content(spark, table) == sorted([(1, "a", D1), (2, "b", D1), (9, "x", D2), (4, "n", None)], key=repr)
    assert {k for k in after if after[k] != before.get(k)} == {str(D2)}
    versions.publish(frame(spark, []), table, [D1, None])
    assert content(spark, table) == [(9, "x", D2)]


def test_a_reader_during_a_swap_sees_one_version(spark, table):
    planned = spark.table(table)
    old = content(spark, table)
    versions.publish(planned.withColumn("v", F.lit("new")), table, [D1, D2, None])
    assert rows(planned) == old
    assert {v for _, v, _ in content(spark, table)} == {"new"} and len(content(spark, table)) == len(old)


@pytest.mark.parametrize("step", ["_create", "_swap"])
def test_a_load_killed_before_the_swap_changes_nothing(spark, table, monkeypatch, step):
    old = content(spark, table)

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, killed)
        with pytest.raises(KeyboardInterrupt):
            versions.publish(frame(spark, [(9, "x", D2)]), table, [D2])
    assert content(spark, table) == old
    root = versions._root(spark, table)
    held = len([c for c in child_names(spark, root) if c.startswith("load-")])
    versions.collect_versions(spark, table, orphans=True)
    assert len([c for c in child_names(spark, root) if c.startswith("load-")]) == held - 1
    versions.publish(frame(spark, [(9, "x", D2)]), table, [D2])
    assert (9, "x", D2) in content(spark, table) and (3, "c", D2) not in content(spark, table)


def test_two_loads_from_one_version(spark, table, monkeypatch):
    write = versions._columns

    def meanwhile(spark, version):
        raise AssertionError

    real = versions.current_version
    calls = []

    def moved(spark, name):
        calls.append(name)
        return real(spark, name) if len(calls) < 3 else "other__v99"

    monkeypatch.setattr(versions, "current_version", moved)
    old = content(spark, table)
    with pytest.raises(versions.PublishConflict):
        versions.publish(frame(spark, [(9, "x", D2)]), table, [D2])
    monkeypatch.undo()
    assert content(spark, table) == old and write is versions._columns and meanwhile


def test_rows_outside_the_touched_partitions_are_refused(spark, table):
    old = content(spark, table)
    with pytest.raises(ValueError, match="does not replace"):
        versions.publish(frame(spark, [(9, "x", D1)]), table, [D2])
    assert content(spark, table) == old


def test_old_versions_are_collected(spark, table):
    for i in range(3):
        versions.publish(frame(spark, [(i, "x", D2)]), table, [D2])
    assert len(versions.versions(spark, table)) == 5
    gone = versions.collect_versions(spark, table, keep=2)
    assert len(versions.versions(spark, table)) == 2 and len(gone) == 2
    assert content(spark, table) == sorted([(1, "a", D1), (2, "b", D1), (2, "x", D2), (4, "n", None)], key=repr)
    planned = spark.table(versions.versions(spark, table)[0])
    assert (1, "x", D2) in rows(planned)


def test_loads_work_on_versioned_tables(spark, table):
    tables.delete_where(spark, table, F.col("k") == 2)
    tables.update_where(spark, table, F.col("k") == 4, {"v": "it's \\ n"})
    tables.reload_partition(frame(spark, [(7, "r", D3)]), table, "day", D3)
    upsert_type1(frame(spark, [(1, "moved", D3), (8, "new", D1)]), table, "k", "day")
    assert content(spark, table) == sorted([(8, "new", D1), (3, "c", D2), (4, "it's \\ n", None), (7, "r", D3), (1, "moved", D3)], key=repr)
    with pytest.raises(ValueError):
        tables.update_where(spark, table, F.col("k") == 1, {"day": D1})


def test_change_loads_publish(spark, db):
    name = f"{db}.published"
    versions.create_versioned(spark, name, changes.CHANGE_COLUMNS, "datadt")
    plain = f"{db}.plain"
    delta = spark.createDataFrame([(1, "A", 30, "x", None, D1), (2, "B", 31, "y", None, D1)], spark.table(name).schema)
    later = spark.createDataFrame([(2, "B2", 32, "z", None, D2), (3, "C", 33, "w", None, D2)], spark.table(name).schema)
    for rows_ in (delta, later):
        changes.apply_type1(rows_, name)
        changes.apply_type1(rows_, plain)
    assert content(spark, name) == content(spark, plain)
    changes.apply_type2(later, name, D2)
    assert spark.table(name).count() == 3


# --- plain tables ---------------------------------------------------------------


@pytest.mark.parametrize("change", ["delete", "update"])
def test_a_failed_write_back_keeps_all_rows(spark, db, monkeypatch, change):
    name = f"{db}.plain"
    tables.refresh_table(spark.range(1000).withColumn("v", F.lit("a")), name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('note' = 'kept')")

    def half(rows_, target):
        spark.sql(f"TRUNCATE TABLE {target}")
        raise OSError("disk")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "truncate_and_insert", half)
        with pytest.raises(tables.SwapFailed) as error:
            if change == "delete":
                tables.delete_where(spark, name, F.col("id") < 10)
            else:
                tables.update_where(spark, name, F.col("id") < 10, {"v": "b"})
    stage = str(error.value).partition("spark.table('")[2].partition("'")[0]
    assert spark.table(stage).count() == (990 if change == "delete" else 1000)
    tables.truncate_and_insert(spark.table(stage), name)
    assert spark.table(name).filter("id < 10 and v = 'a'").count() == 0 and spark.table(name).count() >= 990


@pytest.mark.parametrize("fails", [1, 2, 3])
def test_a_refresh_that_cannot_rename_names_the_rows(spark, db, monkeypatch, fails):
    name = f"{db}.r"
    tables.refresh_table(spark.range(5), name)
    real, count = tables._rename, []

    def rename(*args):
        count.append(args)
        if len(count) == fails or (fails == 3 and len(count) > 1):
            raise OSError("catalog")
        real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_rename", rename)
        with pytest.raises((tables.SwapFailed, OSError)) as error:
            tables.refresh_table(spark.range(7), name)
    if fails < 3:
        assert spark.table(name).count() == 5
    else:
        aside, fresh = str(error.value).partition("complete in ")[2].replace("the new ones in ", "").split(", ")
        assert (spark.table(aside).count(), spark.table(fresh).count()) == (5, 7)
