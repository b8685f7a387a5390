"""Key index, ordered upsert and KPIs by day against the plain loads."""

from datetime import date, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from stratamart.plans import kpi_days
from stratamart.sinks import key_index, tables, upsert
from stratamart.sinks.upsert import live_rows, upsert_indexed, upsert_ordered, upsert_type1
from tests.conftest import rows

COLUMNS = "custno long, v string, datadt date"
DAYS = [date(2025, 3, 1) + timedelta(i) for i in range(5)]
BITS = 1 << 16


def frame(spark, data, columns=COLUMNS):
    return spark.createDataFrame(data, columns)


@pytest.fixture
def table(spark, db):
    name = f"{db}.t"
    tables.create_table(spark, name, COLUMNS, "datadt")
    return name


def test_indexed_upsert_equals_the_plain_one(spark, db, table):
    plain = f"{db}.plain"
    tables.create_table(spark, plain, COLUMNS, "datadt")
    searched = []
    for i, day in enumerate(DAYS):
        delta = frame(spark, [(k, f"{day}", day) for k in range(i * 100, i * 100 + 100)] + [(i * 100 - 1, "again", day), (None, "n", day)])
        searched.append(upsert_indexed(delta, table, "custno", "datadt", BITS))
        upsert_type1(delta, plain, "custno", "datadt")
    late = frame(spark, [(150, "late", DAYS[4]), (10_000, "new", None)])
    searched.append(upsert_indexed(late, table, "custno", "datadt", BITS))
    upsert_type1(late, plain, "custno", "datadt")
    assert rows(spark.table(table)) == rows(spark.table(plain))
    # The last load finds its key on the second day only (one hash in 65,536 bits: other days are rare hits).
    assert str(DAYS[1]) in searched[-1] and len(searched[-1]) < len(DAYS)


def test_index_has_every_stored_key(spark, table):
    data = [(k, "a", DAYS[k % 5]) for k in range(2000)] + [(7_000, "z", None)]
    upsert_indexed(frame(spark, data), table, "custno", "datadt", BITS)
    for k in (0, 1, 2, 3, 4, 1999):
        found = key_index.candidate_partitions(frame(spark, [(k, "", DAYS[0])]), table, "custno", BITS)
        assert str(DAYS[k % 5]) in found
    assert None in key_index.candidate_partitions(frame(spark, [(7_000, "", DAYS[0])]), table, "custno", BITS)
    assert key_index.candidate_partitions(frame(spark, []), table, "custno", BITS) == []
    assert key_index.candidate_partitions(frame(spark, [(None, "", DAYS[0])]), table, "custno", BITS) == []
    key_index.rebuild_key_index(spark, table, "custno", "datadt", BITS)
    assert str(DAYS[1]) in key_index.candidate_partitions(frame(spark, [(1, "", DAYS[0])]), table, "custno", BITS)


def test_a_load_killed_after_the_index_changes_no_result(spark, table, monkeypatch):
    from stratamart.sinks import upsert

    upsert_indexed(frame(spark, [(1, "a", DAYS[0])]), table, "custno", "datadt", BITS)

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(upsert, "upsert_type1", killed)
        with pytest.raises(KeyboardInterrupt):
            upsert_indexed(frame(spark, [(2, "b", DAYS[1])]), table, "custno", "datadt", BITS)
    assert rows(spark.table(table)) == [(1, "a", DAYS[0])]
    upsert_indexed(frame(spark, [(2, "b", DAYS[1]), (1, "c", DAYS[1])]), table, "custno", "datadt", BITS)
    assert rows(spark.table(table)) == [(1, "c", DAYS[1]), (2, "b", DAYS[1])]


def test_only_the_searched_partitions_are_read(spark, table):
    upsert_indexed(frame(spark, [(k, "a", DAYS[k % 5]) for k in range(50)]), table, "custno", "datadt", BITS)
    found = key_index.candidate_partitions(frame(spark, [(3, "", DAYS[0])]), table, "custno", BITS)
    read = tables.in_partitions(spark.table(table), "datadt", found, as_text=True)
    assert len(read.inputFiles()) < len(spark.table(table).inputFiles())


DELTAS = {
    DAYS[0]: [(1, "one", False), (2, "two", False), (3, "three", False)],
    DAYS[1]: [(2, "two again", False), (3, None, True), (4, "four", False)],
    DAYS[2]: [(4, None, True), (1, "one at last", False)],
}


@pytest.mark.parametrize("order", list(permutations(range(3))))
def test_days_in_any_order_give_one_table(spark, db, order):
    columns, name = "custno long, v string, deleted boolean, datadt date", f"{db}.o"
    tables.create_table(spark, name, columns, "datadt")
    for i in (*order, order[0]):
        upsert_ordered(frame(spark, [(k, v, gone, DAYS[i]) for k, v, gone in DELTAS[DAYS[i]]], columns), name)
    assert rows(live_rows(spark.table(name)).select("custno", "v", "datadt")) == [(1, "one at last", DAYS[2]), (2, "two again", DAYS[1])]
    assert spark.table(name).count() == 4


def test_ordered_upsert_of_nothing(spark, table):
    upsert_ordered(frame(spark, []), table)
    upsert_ordered(frame(spark, [(1, "a", DAYS[1])]), table)
    upsert_ordered(frame(spark, [(1, "old", DAYS[0])]), table)
    assert rows(spark.table(table)) == [(1, "a", DAYS[1])]


def test_kpi_days_merge_and_reload(spark, db):
    place = "state string, city string, category string, product string"
    pos = spark.createDataFrame(
        [(i, i % 37, float(i % 200), "Texas" if i % 3 else None, "c", "k", "p", str(DAYS[i % 3])) for i in range(600)],
        f"txnno long, custno long, amount double, {place}, loaddt string")
    consumers = spark.createDataFrame([(i,) for i in range(30)] + [(5,)], "custno long")
    mobile = spark.createDataFrame([(i,) for i in range(0, 600, 2)] + [(4,)], "txnno long")
    name = f"{db}.partials"
    partials = kpi_days.day_partials(consumers, pos, mobile)
    kpi_days.load_days(partials, name, DAYS[:3])
    joined = pos.join(mobile, "txnno").join(consumers, "custno")

    def exact(frame_):
        return {r.state: tuple(r)[1:] for r in frame_.groupBy("state").agg(
            F.max("amount"), F.min("amount"), F.sum("amount"), F.count_distinct("custno"), F.count_if(F.col("state").isin("Nevada", "Texas", "Oregon")),
            F.count_if(F.col("amount") < 100), F.count_if(F.col("amount") >= 100)).collect()}

    def got():
        return {r.state: (r.max_amt, r.min_amt, r.sum_amt, r.approx_cnt_cust, r.states_cnt, r.mid_amt_cnt, r.high_amt_cnt)
                for r in kpi_days.merged_kpi(spark, name).collect()}

    assert got() == exact(joined)
    # One day again, with other transactions: only its partials change, and days without rows lose theirs.
    changed = pos.filter(F.col("loaddt") == str(DAYS[1])).withColumn("amount", F.col("amount") + 1)
    kpi_days.load_days(kpi_days.day_partials(consumers, changed, mobile), name, [DAYS[1], DAYS[2]])
    left = joined.filter(F.col("loaddt") == str(DAYS[0])).unionByName(changed.join(mobile, "txnno").join(consumers, "custno").select(*joined.columns))
    assert got() == exact(left)


def test_large_upsert_broadcasts_no_keys(spark, table, monkeypatch):
    """Sequential keys fill a small file with many rows; a small delta is still broadcast."""
    plans = []

    def keep(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        tables.replace_partitions(rows, *args)

    monkeypatch.setattr(upsert, "replace_partitions", keep)
    for n in (60_000, 70_000, 10):
        upsert_ordered(spark.range(n).selectExpr("id AS custno", f"'{n}' AS v", "DATE'2025-03-01' AS datadt"), table)
    assert ["BroadcastHashJoin" in plan for plan in plans] == [False, False, True]
    found = spark.table(table).groupBy("v").count()
    assert rows(found) == [("10", 10), ("70000", 69_990)]
