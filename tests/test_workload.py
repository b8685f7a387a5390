"""Every registered query against its SQL on the smallest data folder."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratamart.plans import discovery
from stratamart.workload.adapters import DAY1, DAY2, Tables
from stratamart.workload.registry import ORACLES, QUERIES
from tests.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES.get(name), FOLDER) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_wide_fact_row_count(spark):
    """A consumer with m online items and n store rows gives max(1, m) * max(1, n) rows."""
    t = Tables(spark, FOLDER)
    online = t.online().groupBy(F.col("customerid").alias("custno")).agg(F.count("*").alias("m"))
    # A store row may meet several mobile rows of its transaction number.
    store = discovery.stitch_pos_mobile(t.mobile(), t.pos()).groupBy("custno").agg(F.count("*").alias("n"))
    expected = (
        t.consumer().join(online, "custno", "left").join(store, "custno", "left")
        .agg(F.sum(F.greatest(F.lit(1), F.coalesce("m", F.lit(0))) * F.greatest(F.lit(1), F.coalesce("n", F.lit(0)))))
        .first()[0]
    )
    wide = discovery.consumer_wide(t.consumer(), t.online(), t.mobile(), t.pos())
    assert wide.count() == expected
    assert wide.select("custno").distinct().count() == t.consumer().count()


def test_upsert_keeps_one_row_per_key(spark):
    df = QUERIES["scd1_upsert"](spark, FOLDER)
    assert df.count() == df.select("custno").distinct().count()


def test_snapshot_day_counts_equal_the_deltas(spark):
    t = Tables(spark, FOLDER)
    days = {r.datadt: r["count"] for r in QUERIES["scd2_snapshot"](spark, FOLDER).groupBy("datadt").count().collect()}
    assert days == {DAY1: t.delta_day1().count(), DAY2: t.delta_day2().count()}
