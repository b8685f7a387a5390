"""Columns by each file's own header, and reconciliation of contents."""

import pytest
from pyspark.sql import functions as F

from stratamart.plans.audit import ContentMismatch, CountMismatch, checksummed, reconcile_content
from stratamart.sources import files
from tests.conftest import rows

SCHEMA = "custno long, firstname string, lastname string, age int"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text("custno,firstname,lastname,age\n1,Ann,Lee,30\n")
    (tmp_path / "b 2.csv").write_text('custno,"LastName", firstname ,age\n2,Roe,Bob,31\n3,"Po, e",Cy,\n')
    (tmp_path / "c.csv").write_text("age,custno\n40,4\n")
    (tmp_path / "d.csv").write_text("\ufefffirstname,zip,custno,lastname,age\nDee,123,5,Fox,50\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text("custno,firstname,lastname,age\n")
    return str(tmp_path)


def test_reordered_short_and_longer_headers(spark, folder):
    got = files.read_by_header(spark, folder, SCHEMA)
    assert got.columns == ["custno", "firstname", "lastname", "age"]
    assert rows(got) == [(1, "Ann", "Lee", 30), (2, "Bob", "Roe", 31), (3, "Cy", "Po, e", None), (4, None, None, 40), (5, "Dee", "Fox", 50)]
    assert len(files.files_by_header(spark, folder)) == 4


def test_strict_and_broken_headers(spark, folder, tmp_path):
    with pytest.raises(files.HeaderMismatch, match="declared"):
        files.read_by_header(spark, folder, SCHEMA, strict=True)
    (tmp_path / "g.csv").write_text("custno,age,custno\n1,2,3\n")
    with pytest.raises(files.HeaderMismatch, match="twice"):
        files.read_by_header(spark, folder, SCHEMA)
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "empty.csv").write_text("")
    assert files.read_by_header(spark, str(tmp_path / "only"), SCHEMA).count() == 0


def test_contents_are_reconciled(spark, tmp_path):
    data = spark.createDataFrame([(1, "a", 1.5, None), (2, "b", None, [1]), (2, "b", None, [1])], "k long, v string, x double, l array<int>")
    watched, watch = checksummed(data.repartition(3))
    watched.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert reconcile_content(watch, back) == 3 and reconcile_content(watch, back.orderBy("k")) == 3
    for column, value in (("v", F.lit("c")), ("x", F.coalesce("x", F.lit(0.0))), ("l", F.lit(None).cast("array<int>"))):
        with pytest.raises(ContentMismatch, match=f"differ in {column}$"):
            reconcile_content(watch, back.withColumn(column, value))
    with pytest.raises(CountMismatch):
        reconcile_content(watch, back.limit(2))
    # The same values in other rows: only the rows' sum tells.
    swapped = spark.createDataFrame([(1, "b", 1.5, None), (2, "a", None, [1]), (2, "b", None, [1])], data.schema)
    with pytest.raises(ContentMismatch, match="not in any column"):
        reconcile_content(watch, swapped)


def test_empty_contents(spark, tmp_path):
    watched, watch = checksummed(spark.range(0).toDF("k"))
    watched.write.parquet(str(tmp_path / "t"))
    assert reconcile_content(watch, spark.read.parquet(str(tmp_path / "t"))) == 0
