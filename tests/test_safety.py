"""Loads under failure: nothing is lost, nothing stays behind."""

import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from stratamart.operators.joins import full_join
from stratamart.operators.skew import HotKeys, find_all_hot_keys
from stratamart.plans import customer_changes as changes
from stratamart.session import child_names, new_path, pinned, release_pinned
from stratamart.sinks import tables
from stratamart.sources import budget, files
from stratamart.streaming import deltas
from tests.conftest import rows

HEAD = "custno,firstname,lastname,age,profession,upd_ts\n"
D1, D2 = date(2025, 3, 1), date(2025, 3, 2)


def person(i, day, name="Ann"):
    return f"{i},{name},Lee,{20 + i},Clerk,{day} 08:00:00\n"


def land(folder, day, part, lines):
    place = folder / f"customers_{day:%Y%m%d}"
    place.mkdir(exist_ok=True, parents=True)
    (place / f"part-{part}.csv").write_text(HEAD + "".join(lines))


@pytest.fixture
def run(spark, db, tmp_path):
    def go(**more):
        deltas.pick_up_deltas(spark, str(tmp_path / "in"), str(tmp_path / "ckpt"), f"{db}.one", f"{db}.two", **more).awaitTermination(180)
    return go


def test_parts_and_late_files_give_the_whole_day(spark, db, tmp_path, run):
    folder = tmp_path / "in"
    for part in range(2):
        land(folder, D1, part, [person(part * 4 + i, D1) for i in range(4)])
    land(folder, D2, 0, [person(3, D2, "Bea"), person(9, D2)])
    run(max_files=1)
    land(folder, D1, "late", [person(9, D1, "Old"), person(20, D1)])
    run(max_files=1)
    snapshots = spark.table(f"{db}.two").groupBy("datadt").count()
    assert rows(snapshots) == [(D1, 10), (D2, 2)]
    latest = {r.custno: (r.name, r.datadt) for r in spark.table(f"{db}.one").collect()}
    assert len(latest) == 10 and latest[3] == ("Bea,Lee", D2) and latest[9] == ("Ann,Lee", D2) and latest[20] == ("Ann,Lee", D1)
    before = rows(spark.table(f"{db}.one"))
    run()
    assert rows(spark.table(f"{db}.one")) == before


def test_replayed_batch_changes_nothing(spark, db, tmp_path):
    landed = str(tmp_path / "landed")
    batch = spark.createDataFrame(
        [(1, "A", "B", 30, "x", None, None, "f1", D1), (None, "N", "K", 31, "y", None, None, "f1", D1)],
        "custno long, firstname string, lastname string, age long, profession string, upd_ts timestamp, _corrupt_record string, _file string, datadt date")
    for _ in range(3):
        deltas.apply_batch(spark, batch, landed, f"{db}.one", f"{db}.two")
    assert spark.table(f"{db}.one").count() == spark.table(f"{db}.two").count() == 2


def test_budget_counts_the_whole_day_and_blocks_nothing_else(spark, db, tmp_path, run):
    folder = tmp_path / "in"
    for part in range(2):
        land(folder, D1, part, [person(part, D1), "x,a\n", "y,b\n"])
    land(folder, D2, 0, [person(5, D2), "x,a\n", "y,b\n"])
    (folder / "customers_nodate").write_text(HEAD + person(7, D1))
    run()
    assert rows(spark.table(f"{db}.two").select("custno", "datadt")) == [(5, D2)]
    log = spark.table(f"{db}.audit_tbl").filter("errtype = 'FAILURE' and processtype = 'day_set_aside'")
    assert sorted(m.errormsg[:10] for m in log.collect()) == ["a delta fi", "delta of 2"]


def test_a_day_with_two_rows_of_a_key_is_reported_and_blocks_nothing_else(spark, db, tmp_path, run):
    land(tmp_path / "in", D1, 0, [person(1, D1)])
    run()
    land(tmp_path / "in", D1, 1, [person(1, D1, "Eve")])
    land(tmp_path / "in", D2, 0, [person(4, D2)])
    run()
    assert rows(spark.table(f"{db}.one").select("custno", "name")) == [(1, "Ann,Lee"), (4, "Ann,Lee")]
    assert spark.table(f"{db}.audit_tbl").filter("errtype = 'FAILURE' and errormsg like '%several source rows%'").count() == 1


def test_dated_names_with_extensions(spark):
    from stratamart.functions.dates import path_date, uri_day

    names = ["/a/customers_20250301", "/a/customers_20250301.csv", "/a/customers_20250301/p-1.csv.gz", "/a/customers_20250301.d/p", "/a/none"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "p string").select(path_date(F.col("p"))).collect()]
    assert got == [D1] * 4 + [None] and uri_day("/a/customers_20250301.csv") == D1


def test_truncate_under_dynamic_mode(spark, db):
    name = f"{db}.t"
    tables.refresh_table(spark.createDataFrame([(1, 0), (2, 1)], "v int, p int"), name, "p")
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        tables.truncate_and_insert(spark.createDataFrame([(3, 1)], "v int, p int"), name)
        assert spark.conf.get(key) == "dynamic"
    finally:
        spark.conf.unset(key)
    assert rows(spark.table(name)) == [(3, 1)]


def test_delete_in_a_table_with_two_partition_columns(spark, db):
    name = f"{db}.t"
    spark.createDataFrame([(i, i % 2, i % 3) for i in range(12)], "v int, p int, q int").write.partitionBy("p", "q").saveAsTable(name)
    tables.delete_where(spark, name, F.col("p") == 0)
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 3, 5, 7, 9, 11]


@pytest.mark.parametrize("partition", [None, "p"])
def test_failed_refresh_keeps_the_old_table(spark, db, partition):
    name = f"{db}.t"
    tables.refresh_table(spark.createDataFrame([("1", 0)], "v string, p int"), name, partition)
    bad = spark.createDataFrame([("x", 0)], "v string, p int").select(F.col("v").cast("int").alias("v"), "p")
    with pytest.raises(Exception):
        tables.refresh_table(bad, name, partition)
    assert rows(spark.table(name)) == [("1", 0)]
    tables.refresh_table(spark.createDataFrame([(5, 1), (6, 2)], "v int, p int"), name, partition)
    assert rows(spark.table(name)) == [(5, 1), (6, 2)] and dict(spark.table(name).dtypes)["v"] == "int"
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["t"]
    # A table may be refreshed from itself.
    tables.refresh_table(spark.table(name).filter("v = 5"), name, partition)
    assert rows(spark.table(name)) == [(5, 1)]


def test_failed_swap_can_be_finished(spark, db, monkeypatch):
    name = f"{db}.t"
    tables.refresh_table(spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "v int, p int"), name, "p")
    finish = tables.finish_swap
    monkeypatch.setattr(tables, "finish_swap", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(tables.SwapFailed) as error:
        tables.update_where(spark, name, F.col("v") < 3, {"v": F.col("v") * 10})
    stage = str(error.value).split("'")[1]
    assert spark.table(stage).count() == 2
    finish(spark, stage, name, "p", [0, 1])
    assert rows(spark.table(name)) == [(10, 0), (20, 1), (3, 2)] and not spark.catalog.tableExists(stage)


def test_cut_json_line_stops_the_load(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"orderId": "1"}\n{"orderId": "2", "x\n')
    for schema in (None, "orderId string"):
        with pytest.raises(Exception):
            files.read_json_lines(spark, str(tmp_path), schema).collect()
    assert files.read_json_lines(spark, str(tmp_path), "orderId string", malformed="DROPMALFORMED").count() == 1


def test_two_sessions_and_concurrent_runs(spark, db, tmp_path):
    land(tmp_path, D1, 0, [person(1, D1)])
    path, other = str(tmp_path / "customers_20250301"), spark.newSession()
    for session in (spark, other):
        session.conf.set("spark.sql.session.timeZone", "UTC")
    mine = budget.load_external(spark, path, files_schema())
    theirs = budget.load_external(other, path, files_schema())
    assert mine.count() == theirs.count() == 1
    for session in (spark, other):
        budget.drop_external(session)
    left = spark.sql("SHOW TABLES IN stratamart_staging").count()
    errors = []

    def one(number):
        try:
            changes.customer_etl(spark, path, "scd2", f"{db}_{number}")
        except Exception as error:  # reported below
            errors.append(error)

    threads = [threading.Thread(target=one, args=(n,)) for n in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert all(spark.table(f"{db}_{n}.cust_part_curated").count() == 1 for n in range(3))
    assert spark.sql("SHOW TABLES IN stratamart_staging").count() == left
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("cust_ext")]
    for n in range(3):
        spark.sql(f"DROP DATABASE {db}_{n} CASCADE")


def files_schema():
    from stratamart.sources.schemas import DELTA

    return DELTA


def test_hot_keys_are_counted_in_parallel(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    hot = find_all_hot_keys(df, "k", min_rows=1000)["k"]
    assert hot.values == (1,) and hot.parts == (32,)
    assert not find_all_hot_keys(df, "k", min_rows=60_000)["k"]
    both = hot | HotKeys((7,), (4,))
    assert both.values == (1, 7) and both.parts == (32, 4) and (both - hot).values == (7,)
    got = {r.k: r.n for r in df.select("k", both.salts(F.col("k")).alias("n")).distinct().collect() if r.k < 20}
    assert got[1] == 32 and got[7] == 4 and got[9] == 1


def test_full_join_prunes_and_pushes(spark, db):
    spark.range(100).selectExpr("id a", "id + 1 b", "id + 2 c").write.saveAsTable(f"{db}.l")
    spark.range(100).selectExpr("id x", "id + 1 y", "id + 2 z").write.saveAsTable(f"{db}.r")
    joined = full_join(spark.table(f"{db}.l"), spark.table(f"{db}.r"), "a", "x").filter("y is not null").select("b", "y")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("c#" not in line and "z#" not in line for line in scans)
    assert any("IsNotNull(y)" in line for line in scans) and any("IsNotNull(a)" in line for line in scans)


def test_ingest_day_insert_has_no_exchange(spark, db, monkeypatch):
    name = f"{db}.days"
    for i in range(2):
        tables.append_by_ingest_day(spark.range(i, i + 1).selectExpr("id v"), name, D1)
    tables.append_by_ingest_day(spark.range(5, 6).selectExpr("id v"), name, D2)
    assert rows(spark.table(name)) == [(0, D1), (1, D1), (5, D2)]


def test_pinned_rows_are_released(spark):
    root = new_path(spark, "x").rsplit("/", 1)[0]
    pinned(spark.range(3).toDF("v"), "probe")
    assert any(n.startswith("probe") for n in child_names(spark, root))
    release_pinned(spark)
    assert not any(n.startswith("probe") for n in child_names(spark, root))


def test_heavy_keys_do_not_read_the_inputs_again(spark):
    from stratamart.operators.skew import NO_HOT_KEYS
    from stratamart.plans import discovery
    from stratamart.workload.adapters import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    key = t.pos().select("custno").first()[0]

    def scans(hot):
        wide = discovery.consumer_wide(t.consumer(), t.online(), t.mobile(), t.pos(), hot, {"txnno": NO_HOT_KEYS, "custno": hot})
        return wide._jdf.queryExecution().executedPlan().toString().count("FileScan")

    try:
        assert scans(HotKeys((key,), (8,))) <= 1.5 * scans(NO_HOT_KEYS)
    finally:
        release_pinned(spark)
