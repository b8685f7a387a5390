"""Two-day customer delta with known results, by metadata, by flag and by stream."""

import shutil
from datetime import date, datetime

import pytest

from stratamart.plans import customer_changes as changes
from stratamart.sinks import tables
from stratamart.sources.budget import TooManyBadRecords
from stratamart.streaming.deltas import pick_up_deltas
from pyspark.sql import functions as F
from tests.conftest import rows

# A published two-day delta and the results both loads must give.
DAY1 = """custid,firstname,lastname,age,profession,upd_ts
4000011,Francis,McNamara,47,Therapist,2024-08-01 00:00:01
4000012,Sandy,Raynor,26,Writer,2024-08-01 00:00:01
4000013,Marion,Moon,41,Carpenter,2024-08-01 00:00:01
"""
# The second file's header is one name short.
DAY2 = """custid,firstname,lastname,age,profession
4000012,Sandy,Raynor,26,Editor,2025-07-02 00:10:01
4000019,Kristine,Dougherty,63,Financial analyst,2025-07-02 00:00:01
4000020,Crystal,Powers,67,Engineering technician,2025-07-02 00:00:01
"""
D1, D2, T1 = date(2025, 7, 1), date(2025, 7, 2), datetime(2024, 8, 1, 0, 0, 1)
T2, T3 = datetime(2025, 7, 2, 0, 0, 1), datetime(2025, 7, 2, 0, 10, 1)
FIRST = [
    (4000011, "Francis,McNamara", 47, "Therapist", D1, T1),
    (4000012, "Sandy,Raynor", 26, "Writer", D1, T1),
    (4000013, "Marion,Moon", 41, "Carpenter", D1, T1),
]
SECOND = [
    (4000012, "Sandy,Raynor", 26, "Editor", D2, T3),
    (4000019, "Kristine,Dougherty", 63, "Financial analyst", D2, T2),
    (4000020, "Crystal,Powers", 67, "Engineering technician", D2, T2),
]
SCD1 = sorted([FIRST[0], FIRST[2]] + SECOND, key=repr)
SCD2 = sorted(FIRST + SECOND, key=repr)


def in_order(spark, name):
    return rows(spark.table(name).select("custno", "name", "age", "profession", "datadt", "upd_ts"))


@pytest.fixture
def files(tmp_path):
    out = []
    for day, text in (("20250701", DAY1), ("20250702", DAY2)):
        path = tmp_path / f"customers_{day}"
        path.write_text(text)
        out.append(str(path))
    return out


def test_metadata_driven_load(spark, db, files):
    meta, one, two = f"{db}.etl_meta", f"{db}.scd1_merge", f"{db}.scd2_append"
    tables.refresh_table(spark.createDataFrame([(3, files[0])], "id bigint, rulesql string"), meta)
    changes.load_delta(spark, meta, 3, one, two)
    assert spark.table("cust_ext").count() == 3
    assert in_order(spark, one) == in_order(spark, two) == sorted(FIRST, key=repr)
    tables.update_where(spark, meta, F.col("id") == 3, {"rulesql": files[1]})
    for _ in range(2):
        changes.load_delta(spark, meta, 3, one, two)
        assert spark.table("cust_ext").count() == 3
        assert in_order(spark, one) == SCD1
        assert in_order(spark, two) == SCD2
    assert rows(changes.rows_per_day(spark, two)) == [(D1, 3), (D2, 3)]


@pytest.mark.parametrize("flag, table, other, expected", [
    ("scd1", "cust_part_curated_merge", "cust_part_curated", SCD1),
    ("scd2", "cust_part_curated", "cust_part_curated_merge", SCD2),
])
def test_by_flag(spark, db, files, flag, table, other, expected):
    for path in files:
        changes.customer_etl(spark, path, flag, db)
    assert in_order(spark, f"{db}.{table}") == expected
    assert not spark.catalog.tableExists(f"{db}.{other}")
    log = spark.table(f"{db}.audit_tbl")
    assert log.filter("errtype = 'SUCCESS'").count() == log.filter("errtype = 'START'").count() == 4
    assert log.select("processid").distinct().count() == 2


def test_unknown_flag_loads_nothing(spark, db, files):
    changes.customer_etl(spark, files[0], "scd3", db)
    assert not spark.catalog.tableExists("cust_ext")
    assert {t.name for t in spark.catalog.listTables(db) if not t.isTemporary} == {"audit_tbl"}
    assert spark.table(f"{db}.audit_tbl").filter("processtype = 'unknown_flag' and errtype = 'SUCCESS'").count() == 1


def test_failures_are_audited_and_stop_the_run(spark, db, tmp_path):
    path = tmp_path / "customers_20250703"
    path.write_text(DAY1 + "x,a\ny,b\nz,c\n")
    with pytest.raises(TooManyBadRecords):
        changes.customer_etl(spark, str(path), "scd1", db)
    changes.customer_etl(spark, str(path), "scd1", db, swallow=True)
    changes.customer_etl(spark, str(tmp_path / "nodate"), "scd1", db, swallow=True)
    assert spark.table(f"{db}.audit_tbl").filter("errtype = 'FAILURE' and errormsg <> ''").count() == 3
    assert not spark.catalog.tableExists(f"{db}.cust_part_curated_merge")


def test_stream_picks_up_each_file_once(spark, db, files, tmp_path):
    folder, checkpoint = tmp_path / "landing", str(tmp_path / "ckpt")
    folder.mkdir()
    one, two = f"{db}.s1", f"{db}.s2"

    def run():
        pick_up_deltas(spark, str(folder), checkpoint, one, two).awaitTermination(120)

    for path in files:  # one batch holds both days
        shutil.copy(path, folder)
    run()
    assert in_order(spark, one) == SCD1 and in_order(spark, two) == SCD2
    run()
    assert in_order(spark, one) == SCD1 and in_order(spark, two) == SCD2
    (folder / "customers_20250703").write_text("h\n4000011,Fran,Mc,48,,2025-07-03 00:00:00\n")
    run()
    assert spark.table(one).filter("datadt = date'2025-07-03'").count() == 1
    assert spark.table(one).count() == 5 and spark.table(two).count() == 7
    assert spark.table(one).filter("custno = 4000011").first()["profession"] == "na"
