"""The four layered loads; tables are the contract between them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratamart.clock import RunClock
from stratamart.operators.skew import HotKeys, find_all_hot_keys
from stratamart.plans import curation, discovery, outbound
from stratamart.plans.audit import ProgressLog
from stratamart.session import release_pinned, staged
from stratamart.sinks import tables
from stratamart.sources.catalog import read_matching_tables
from stratamart.sources.files import read_json_lines, read_typed
from stratamart.sources.schemas import CONSUMER, MOBILE, ONLINE, POS

# Layouts of the curated and discovery tables.
ONLINE_COLUMNS = (
    "transsk DECIMAL(38,9), customerid BIGINT, productname STRING, productcategory STRING, productprice BIGINT, "
    "productidint BIGINT, prodidstr STRING, loadts TIMESTAMP, loaddt DATE"
)
POS_COLUMNS = (
    "txnno DECIMAL(38,9), txndt DATE, custno BIGINT, amount DOUBLE, category STRING, product STRING, "
    "city STRING, state STRING, spendby STRING, loadts TIMESTAMP, loaddt DATE"
)
MOBILE_COLUMNS = (
    "txnno DECIMAL(38,9), dt DATE, ts TIMESTAMP, geo_coordinate STRUCT<lon: DOUBLE, lat: DOUBLE>, net STRING, "
    "provider STRING, activity STRING, postal_code BIGINT, town_name STRING, loadts TIMESTAMP, loaddt DATE, "
    "ingest_dt DATE"
)
WIDE_COLUMNS = (
    "txnno DECIMAL(38,9), txndt DATE, custno BIGINT, fullname STRING, age BIGINT, profession STRING, "
    "trans_day STRING, trans_type STRING, net STRING, online_pos_amount DOUBLE, "
    "geo_coordinate STRUCT<lon: DOUBLE, lat: DOUBLE>, provider STRING, activity STRING, spendby STRING, "
    "city STRING, state STRING, online_pos_category STRING, product STRING, loadts TIMESTAMP, loaddt DATE"
)


@dataclass(frozen=True)
class Layers:
    """Database names of the layers."""

    raw: str = "rawds"
    curated: str = "curatedds"
    discovery: str = "discoveryds"

    def create(self, spark: SparkSession) -> None:
        for name in (self.raw, self.curated, self.discovery):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


@dataclass(frozen=True)
class SourceFiles:
    consumers: str
    pos: str
    online: str
    mobile: str


def load_raw(spark: SparkSession, files: SourceFiles, layers: Layers = Layers()) -> None:
    """Full refresh of the four raw tables, with progress notes."""
    layers.create(spark)
    log = ProgressLog(spark, f"{layers.raw}.audit_meta", "rawload")
    log.note("consumers read")
    tables.refresh_table(read_typed(spark, files.consumers, CONSUMER, header=True), f"{layers.raw}.consumer")
    log.note("store transactions read")
    tables.refresh_table(read_typed(spark, files.pos, POS), f"{layers.raw}.trans_pos")
    log.note("online transactions read")
    tables.refresh_table(read_json_lines(spark, files.online, ONLINE), f"{layers.raw}.trans_online")
    log.note("mobile transactions read")
    tables.refresh_table(read_typed(spark, files.mobile, MOBILE, header=True), f"{layers.raw}.trans_mobile_channel")
    log.note("raw layer complete")


def load_curated(
    spark: SparkSession, clock: RunClock, layers: Layers = Layers(), years: Sequence[int] = (2021, 2022, 2023),
    clamped_year: int = 2023, append: bool = False,
) -> None:
    """Curate the four raw tables.

    Each load of a run day replaces what an earlier run stored for that day.
    ``append`` adds POS and mobile rows instead, so a rerun doubles them.
    """
    raw, cur = layers.raw, layers.curated
    tables.refresh_table(curation.curate_consumers(spark.table(f"{raw}.consumer"), clock), f"{cur}.consumer_full_load")

    online = f"{cur}.trans_online_part"
    tables.create_table(spark, online, ONLINE_COLUMNS, "loaddt")
    tables.reload_partition(curation.curate_online(spark.table(f"{raw}.trans_online"), clock), online, "loaddt", clock.day)
    # The day just stored is read back, so the items are unnested only once.
    today = spark.table(online).filter(F.col("loaddt") == clock.day_col)
    tables.load_subset(today, f"{online}_furniture", F.col("productcategory") == "Furniture")

    pos = f"{cur}.trans_pos_part_cluster"
    tables.create_table(spark, pos, POS_COLUMNS, "loaddt", "Point of sale rows by load day, clustered by customer")
    sales = tables.cluster_rows(curation.curate_pos(spark.table(f"{raw}.trans_pos"), clock), "custno", "txnno")
    if append:
        tables.append_rows(sales, pos)
    else:
        tables.reload_partition(sales, pos, "loaddt", clock.day)

    mobile = spark.table(f"{raw}.trans_mobile_channel")
    # One pass over the raw table, split by year; then each year's table reads its own part.
    pass_over = curation.curate_mobile_of(mobile, years, clamped_year, clock).withColumn("_year", F.year("dt"))
    with staged(pass_over, "_year") as stage:
        for year in years:
            name = f"{cur}.trans_mobile_autopart_{year}"
            tables.create_table(spark, name, MOBILE_COLUMNS, "ingest_dt")
            rows = spark.table(stage).filter(F.col("_year") == year).drop("_year")
            if append:
                tables.append_by_ingest_day(rows, name, clock.day)
            else:
                tables.reload_partition(rows, name, "ingest_dt", clock.day)


def load_discovery(
    spark: SparkSession, clock: RunClock, layers: Layers = Layers(), kpi_year: int = 2023, append: bool = False,
) -> None:
    """Wide consumer fact and the KPI table.

    The fact is replaced as a whole (all its inputs are); ``append`` adds to it. Heavy
    keys are looked up once for fact, KPI and export; those of POS are returned.
    """
    cur, out = layers.curated, layers.discovery
    consumers, pos = spark.table(f"{cur}.consumer_full_load"), spark.table(f"{cur}.trans_pos_part_cluster")
    mobile = read_matching_tables(spark, cur, "trans_mobile_autopart_20*")
    wide = f"{out}.consumer_trans_pos_mob_online"
    tables.create_table(spark, wide, WIDE_COLUMNS)
    hot = find_all_hot_keys(pos, "txnno", "custno")
    fact = discovery.consumer_wide(consumers, spark.table(f"{cur}.trans_online_part"), mobile, pos, hot_pos=hot)
    if append:
        tables.append_rows(fact, wide)
    else:
        tables.truncate_and_insert(fact, wide)
    kpi = discovery.kpi_by_place(consumers, pos, spark.table(f"{cur}.trans_mobile_autopart_{kpi_year}"), hot=hot)
    tables.refresh_table(kpi, f"{out}.trans_aggr")
    return hot


def export_outbound(
    spark: SparkSession, clock: RunClock, path: str, layers: Layers = Layers(), hot: HotKeys | None = None,
) -> str:
    return outbound.export_report(spark.table(f"{layers.curated}.trans_pos_part_cluster"), clock, path, hot)


def run_all(spark: SparkSession, files: SourceFiles, clock: RunClock, export_path: str, layers: Layers = Layers()) -> str:
    """Raw, curated, discovery, outbound; returns the export folder."""
    load_raw(spark, files, layers)
    load_curated(spark, clock, layers)
    hot = load_discovery(spark, clock, layers)
    try:
        return export_outbound(spark, clock, export_path, layers, hot["custno"])
    finally:
        release_pinned(spark)
