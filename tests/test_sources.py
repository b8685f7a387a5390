from datetime import date, datetime

import pytest

from stratamart.clock import RunClock
from stratamart.plans import audit, transfers
from stratamart.sinks import files as out
from stratamart.sinks import tables
from stratamart.sources import catalog, files
from stratamart.sources.budget import TooManyBadRecords, drop_external, load_external
from stratamart.sources.schemas import CONSUMER, CONSUMER_NAMES, CONSUMER_SHORT, DELTA, ONLINE
from tests.conftest import rows

PEOPLE = "1,Ann,Lee,47,Pilot\n2,Bob,Ray,26,\n3,Cid,Moon,41,Cook\n"
ORDERS = (
    '{"orderId":"1","storeLocation":"Oslo","customerId":"7","products":['
    '{"productId":"12","productCategory":"Laptop","productName":"L","productPrice":"540"},'
    '{"productId":"34P","productCategory":"Furniture","productName":"T","productPrice":"40"}]}\n'
    '{"orderId":"2","storeLocation":"Oslo","customerId":"8","products":[]}\n'
)


def put(path, text):
    path.write_text(text)
    return str(path)


def test_positional_and_inferred(spark, tmp_path):
    path = put(tmp_path / "custs", PEOPLE)
    df = files.read_positional(spark, path, CONSUMER_NAMES)
    assert set(dict(df.dtypes).values()) == {"string"}
    typed = files.read_inferred(spark, path, CONSUMER_NAMES)
    assert dict(typed.dtypes)["age"] == "int" and rows(typed)[1] == (2, "Bob", "Ray", 26, None)
    sampled = files.read_inferred(spark, path, CONSUMER_NAMES, sample_path=path)
    assert sampled.dtypes == typed.dtypes and rows(sampled) == rows(typed)


def test_typed_drops_or_fails_on_malformed(spark, tmp_path):
    path = put(tmp_path / "custs", PEOPLE + "x,Bad,Row,1,Y\n4,Short\n")
    kept = files.read_typed(spark, path, CONSUMER_SHORT, malformed="DROPMALFORMED")
    assert [r.id for r in kept.orderBy("id").collect()] == [1, 2, 3]
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_typed(spark, path, CONSUMER_SHORT).collect()


def test_header_is_skipped_and_names_come_from_the_schema(spark, tmp_path):
    path = put(tmp_path / "c", "custno,firstname,lastname,age,profession\n" + PEOPLE)
    assert files.read_typed(spark, path, CONSUMER, header=True).columns == list(CONSUMER_NAMES)
    assert files.read_inferred(spark, path, header=True).columns[0] == "custno"


def test_json_lines(spark, tmp_path):
    path = put(tmp_path / "o.json", ORDERS)
    inferred = files.read_json_lines(spark, path)
    declared = files.read_json_lines(spark, path, ONLINE)
    assert inferred.count() == declared.count() == 2
    assert declared.selectExpr("inline(products)").count() == 2


@pytest.mark.parametrize("bad, passes", [(0, True), (2, True), (3, False)])
def test_bad_record_budget(spark, tmp_path, bad, passes):
    text = "custid,firstname,lastname,age,profession\n1,A,B,3,C,2024-08-01 00:00:01\n2,A,B,4,C,2024-08-01 00:00:01\n"
    text += "".join(["x,A,B,3,C,2024-08-01 00:00:01\n", "5,A\n", "6,A,B,old,C,2024-08-01 00:00:01\n"][:bad])
    path = put(tmp_path / "customers_20250701", text)
    if not passes:
        with pytest.raises(TooManyBadRecords):
            load_external(spark, path, DELTA, "v_bad")
        assert not spark.catalog.tableExists("v_bad")
        return
    got = rows(load_external(spark, path, DELTA, "v_ext"))
    assert got == [(1, "A", "B", 3, "C", datetime(2024, 8, 1, 0, 0, 1)), (2, "A", "B", 4, "C", datetime(2024, 8, 1, 0, 0, 1))]
    drop_external(spark, "v_ext")
    assert not spark.catalog.tableExists("v_ext")


def test_file_date(spark, tmp_path):
    put(tmp_path / "customers_20250701", "h\n1,A,B,3,C,2024-08-01 00:00:01\n")
    put(tmp_path / "customers_20250702", "h\n2,A,B,3,C,2024-08-01 00:00:01\n")
    df = files.with_file_date(files.read_typed(spark, str(tmp_path), DELTA, header=True))
    assert rows(df.select("custno", "datadt")) == [(1, date(2025, 7, 1)), (2, date(2025, 7, 2))]


def test_matching_tables(spark, db):
    spark.sql(f"CREATE TABLE {db}.m_2021 USING parquet AS SELECT 1 a, 'x' b")
    spark.sql(f"CREATE TABLE {db}.m_2022 USING parquet AS SELECT 2 a")
    spark.sql(f"CREATE TABLE {db}.other USING parquet AS SELECT 3 a")
    assert rows(catalog.read_matching_tables(spark, db, "m_20*")) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        catalog.read_matching_tables(spark, db, "none*")


def test_text_table_landing(spark, db, tmp_path):
    path = put(tmp_path / "txns", "1,01-02-2024,7,5.5,c,p,ci,st,cash\n")
    name = f"{db}.transactions"
    catalog.create_text_table(spark, name, "txnno INT, txndate STRING, custno INT, amount DOUBLE, category STRING, product STRING, city STRING, state STRING, spendby STRING")
    catalog.land_text_files(spark, path, name)
    catalog.land_text_files(spark, path, name)
    assert spark.table(name).count() == 1
    catalog.land_text_files(spark, path, name, overwrite=False)
    assert spark.table(name).count() == 2
    ext = f"{db}.ext_transactions"
    catalog.create_text_table(
        spark, ext, "txnno INT, amount DOUBLE, load_dt STRING", location=str(tmp_path / "ext"), partition_column="load_dt"
    )
    part = spark.table(name).selectExpr("txnno", "amount", "'2024-01-05' load_dt")
    tables.append_partitioned(part, ext, "load_dt")
    assert rows(spark.table(ext))[0] == (1, 5.5, "2024-01-05")
    spark.sql(f"DROP TABLE {ext}")
    assert (tmp_path / "ext" / "load_dt=2024-01-05").exists()


def test_rule_lookup(spark, db):
    spark.sql(f"CREATE TABLE {db}.etl_meta USING parquet AS SELECT 3L id, '/d/custs_20250701' rulesql")
    assert catalog.lookup_rule(spark, f"{db}.etl_meta", 3) == "/d/custs_20250701"
    with pytest.raises(LookupError, match="no rule"):
        catalog.lookup_rule(spark, f"{db}.etl_meta", 4)
    spark.sql(f"INSERT INTO {db}.etl_meta VALUES (3, 'again')")
    with pytest.raises(LookupError, match="more than one"):
        catalog.lookup_rule(spark, f"{db}.etl_meta", 3)


def test_views_metadata_and_masking(spark, db):
    df = spark.createDataFrame([(1, "Ann 7")], "id int, name string")
    assert rows(catalog.query_view(spark, df, "v_raw", "select id + 1 i from v_raw")) == [(2,)]
    catalog.create_masked_view(spark, df, "v_masked", ["name"])
    assert rows(spark.table("v_masked")) == [(1, "Xxx n")]
    tables.create_table(spark, f"{db}.p", "a INT, d DATE", "d", "it's a note")
    tables.reload_partition(spark.sql("select 1 a"), f"{db}.p", "d", date(2024, 1, 1))
    assert {r.col_name for r in catalog.table_columns(spark, f"{db}.p").collect()} >= {"a", "d"}
    assert "PARTITIONED BY" in catalog.table_ddl(spark, f"{db}.p")
    assert rows(catalog.table_partitions(spark, f"{db}.p")) == [("d=2024-01-01",)]
    assert catalog.database_tables(spark, db).count() >= 1


def test_run_stamp(spark):
    assert catalog.run_stamp(spark, RunClock.at("2025-07-21T03:04:05.678")) == "20250721030405"


def test_csv_and_json_writers(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('n', id) name")
    out.write_csv(df, str(tmp_path / "a"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        out.write_csv(df, str(tmp_path / "a"))
    out.write_csv(df.repartition(5), str(tmp_path / "one"), files=1)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    out.write_csv(df, str(tmp_path / "two"), mode="overwrite", files=2)
    assert len(list((tmp_path / "two").glob("*.csv"))) == 2
    out.write_json(df, str(tmp_path / "j"))
    assert rows(spark.read.json(str(tmp_path / "j")).select("id", "name")) == rows(df)
    out.export_csv(df, str(tmp_path / "x"))
    out.export_csv(df, str(tmp_path / "x"))
    assert spark.read.csv(str(tmp_path / "x"), header=True).count() == 100


def test_transfers(spark, db, tmp_path):
    path = put(tmp_path / "custs", PEOPLE)
    clock = RunClock.at("2024-01-01T00:00:00")
    spark.sql(f"CREATE TABLE {db}.txnrecords USING parquet AS SELECT 1 a")
    loaded = transfers.files_to_table_to_json(
        spark, path, str(tmp_path / "copy_"), f"{db}.custs", f"{db}.txnrecords", str(tmp_path / "txn_"), clock
    )
    assert loaded.count() == 3
    assert spark.read.json(str(tmp_path / "txn_20240101000000")).count() == 1
    parts = transfers.typed_files_to_partitions(
        spark, path, f"{db}.cust_info", str(tmp_path / "cj_"), str(tmp_path / "cc"), clock
    )
    assert {r[0] for r in catalog.table_partitions(spark, f"{db}.cust_info").collect()} == {"custage=26", "custage=41", "custage=47"}
    assert parts.count() == spark.read.csv(str(tmp_path / "cc")).count() == 3
    over = transfers.raw_and_curated_customers(spark, path, f"{db}.customer_raw", f"{db}.customer_curated")
    assert rows(over) == [(1, "Ann,Lee", 47, "Pilot"), (3, "Cid,Moon", 41, "Cook")]


def test_reconcile(spark, tmp_path):
    df, watch = audit.counted(spark.range(10))
    df.write.parquet(str(tmp_path / "p"))
    assert audit.reconcile(watch.get["n_rows"], spark.read.parquet(str(tmp_path / "p"))) == 10
    with pytest.raises(audit.CountMismatch):
        audit.reconcile(11, spark.read.parquet(str(tmp_path / "p")))


def test_step_log(spark, db):
    log = audit.StepLog(spark, f"{db}.audit_tbl", "job")
    with log.step("one"):
        pass
    with pytest.raises(RuntimeError):
        with log.step("two"):
            raise RuntimeError("it's broken")
    with log.step("three", swallow=True):
        raise RuntimeError("ignored")
    got = [(r.processtype, r.errtype, r.errormsg) for r in spark.table(f"{db}.audit_tbl").orderBy("ts").collect()]
    assert got == [
        ("one", "START", ""), ("one", "SUCCESS", ""), ("two", "START", ""), ("two", "FAILURE", "it's broken"),
        ("three", "START", ""), ("three", "FAILURE", "ignored"),
    ]
    assert {r.processid for r in spark.table(f"{db}.audit_tbl").collect()} == {log.process_id}
