"""Sources, sinks, change loads, audit and the delta stream, each read back as a result.

Inputs are written from the given tables first, so every run reads and writes
whole tables. Databases and files live in the shared folder.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.plans import customer_changes as changes
from stratamart.plans import key_maps, kpi_days, layers, transfers
from stratamart.plans.audit import ContentMismatch, checksummed, counted, reconcile, reconcile_content
from stratamart.plans.curation import curate_delta, unnest_products
from stratamart.plans.discovery import kpi_by_place
from stratamart.plans.outbound import export_report
from stratamart.session import new_database, new_path, pinned
from stratamart.sinks import tables, versions
from stratamart.sinks.files import export_csv, write_csv, write_json
from stratamart.sources import catalog, files
from stratamart.sources.budget import load_external
from stratamart.sources.schemas import CONSUMER, CONSUMER_NAMES, CONSUMER_SHORT, DELTA, ONLINE, POS
from stratamart.streaming.deltas import pick_up_deltas
from stratamart.workload.adapters import CLOCK, DAY1, DAY2
from stratamart.workload.domain import REPORT, WIDE
from stratamart.workload.registry import query
from stratamart.workload.relations import KPI_ROWS

D1, D2 = date.fromisoformat(DAY1), date.fromisoformat(DAY2)
CHANGED = "SELECT * FROM delta1 WHERE custno NOT IN (SELECT custno FROM delta2) UNION ALL SELECT * FROM delta2"
BOTH_DAYS = "SELECT * FROM delta1 UNION ALL SELECT * FROM delta2"


def _database(t) -> str:
    return new_database(t.spark, "query")


def _delta_files(t) -> tuple[str, str, str]:
    """Both deltas as dated CSV folders; returns the parent and the two paths."""
    landing = new_path(t.spark, "landing")
    paths = []
    for rows, day in ((t.delta_day1(), D1), (t.delta_day2(), D2)):
        paths.append(write_csv(rows, f"{landing}/customers_{day:%Y%m%d}", header=True))
    return landing, *paths


# -- sources ---------------------------------------------------------------


@query("SELECT custid, firstname, lastname, CAST(age AS VARCHAR) AS age, profession FROM consumer_raw")
def csv_positional(t):
    path = write_csv(t.consumer_raw().select(*CONSUMER_NAMES), new_path(t.spark, "csv"))
    return files.read_positional(t.spark, path, CONSUMER_NAMES).withColumn("custid", F.col("custid").cast("bigint"))


@query("SELECT custid, firstname, CAST(lastname AS BIGINT) AS lastname, age, profession FROM consumer_raw")
def csv_inferred(t):
    """Inference makes numbers of digit-only names."""
    path = write_csv(t.consumer_raw().select(*CONSUMER_NAMES), new_path(t.spark, "csv"))
    return files.read_inferred(t.spark, path, CONSUMER_NAMES).select(
        F.col("custid").cast("bigint"), "firstname", F.col("lastname").cast("bigint"), F.col("age").cast("bigint"), "profession"
    )


@query("""SELECT custid AS id, firstname AS custfname, lastname AS custlname, age AS custage, profession AS custprofession
          FROM consumer_raw WHERE profession IS NULL OR profession <> 'BUILDING'""")
def csv_drop_malformed(t):
    """Ages of one profession are written as text and cannot be read as numbers."""
    spoiled = t.consumer_raw().select(
        "custid", "firstname", "lastname",
        F.when(F.col("profession") == "BUILDING", "old").otherwise(F.col("age").cast("string")).alias("age"), "profession",
    )
    path = write_csv(spoiled, new_path(t.spark, "csv"))
    rows = files.read_typed(t.spark, path, CONSUMER_SHORT, malformed="DROPMALFORMED")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("id", "custage")})


@query("SELECT * FROM consumer_raw")
def csv_header_schema(t):
    path = write_csv(t.consumer_raw().select(*CONSUMER_NAMES), new_path(t.spark, "csv"), header=True)
    return files.read_typed(t.spark, path, CONSUMER, header=True)


@query("SELECT * FROM pos_raw")
def csv_roundtrip(t):
    path = export_csv(t.pos_raw(), new_path(t.spark, "export"))
    return files.read_typed(t.spark, path, POS, header=True)


@query("""SELECT orderId, customerId, p.productId AS productid, CAST(p.productPrice AS BIGINT) AS price FROM items""")
def json_roundtrip(t):
    path = write_json(t.online_raw(), new_path(t.spark, "json"))
    return unnest_products(files.read_json_lines(t.spark, path, ONLINE)).select(
        "orderId", "customerId", F.col("product.productId").alias("productid"),
        F.col("product.productPrice").cast("bigint").alias("price"),
    )


@query("""SELECT c_custkey AS custno, split_part(c_name, '#', 2) AS lastname, 21 + c_custkey % 55 AS age FROM customer
          WHERE c_custkey NOT IN (SELECT min(c_custkey) FROM customer UNION ALL SELECT max(c_custkey) FROM customer)""")
def bad_record_budget(t):
    """The first and last customers' ages are spoiled: two bad rows, as many as allowed."""
    ends = t.read("customer").agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi")).first()
    spoiled = t.delta_day1().withColumn(
        "age", F.when(F.col("custno").isin(ends["lo"], ends["hi"]), "old").otherwise(F.col("age").cast("string"))
    )
    path = write_csv(spoiled, new_path(t.spark, "csv"), header=True)
    return load_external(t.spark, path, DELTA, "budget_ext").select("custno", "lastname", "age")


@query("SELECT txnno, CAST(dt AS VARCHAR) AS dt, provider FROM mobile")
def wildcard_tables(t):
    db = _database(t)
    for year in (2021, 2022, 2023):
        tables.refresh_table(t.mobile_of(year), f"{db}.trans_mobile_autopart_{year}")
    return catalog.read_matching_tables(t.spark, db, "trans_mobile_autopart_20*").select("txnno", "dt", "provider")


@query("""SELECT txnno, txndt AS txndate, custno, amt AS amount, category, '2023-06-30' AS load_dt FROM pos_raw""")
def text_partitions(t):
    """Raw text landed in a text table, then added to an external text table by load date."""
    db = _database(t)
    columns = "txnno BIGINT, txndate STRING, custno BIGINT, amount DOUBLE, category STRING"
    rows = t.pos_raw().select(F.col("txnno").cast("bigint"), "txndt", "custno", "amt", "category")
    path = write_csv(rows, new_path(t.spark, "text"))
    catalog.create_text_table(t.spark, f"{db}.transactions", columns)
    catalog.land_text_files(t.spark, path, f"{db}.transactions")
    ext = f"{db}.ext_transactions"
    catalog.create_text_table(t.spark, ext, f"{columns}, load_dt STRING", new_path(t.spark, "ext"), "load_dt")
    dated = catalog.read_table(t.spark, f"{db}.transactions").withColumn("load_dt", F.lit(CLOCK.day.isoformat()))
    tables.append_partitioned(dated, ext, "load_dt")
    return t.spark.table(ext)


# -- sinks -----------------------------------------------------------------


@query("SELECT custno, age FROM consumer")
def age_partitions(t):
    name = f"{_database(t)}.cust_info"
    tables.refresh_table(t.consumer().select("custno", "age"), name, partition_by="age")
    return t.spark.table(name)


@query("SELECT custno, fullname FROM consumer")
def full_refresh(t):
    """The second refresh replaces rows and columns of the first."""
    name = f"{_database(t)}.consumer"
    tables.refresh_table(t.consumer_raw(), name)
    tables.refresh_table(t.consumer().select("custno", "fullname"), name)
    return t.spark.table(name)


@query("SELECT custno, fullname FROM consumer WHERE age > 40")
def truncate_insert(t):
    name = f"{_database(t)}.consumer"
    tables.refresh_table(t.consumer().select("custno", "fullname"), name)
    tables.truncate_and_insert(t.consumer().filter("age > 40").select("fullname", "custno"), name)
    return t.spark.table(name)


@query("SELECT category, 2 * count(*) AS n_rows FROM pos GROUP BY category")
def append_twice(t):
    name = f"{_database(t)}.pos"
    tables.create_table(t.spark, name, layers.POS_COLUMNS, "loaddt")
    for _ in range(2):
        tables.append_rows(t.pos(), name)
    return t.spark.table(name).groupBy("category").agg(F.count(F.lit(1)).alias("n_rows"))


def _reloaded(t, second: DataFrame, third: DataFrame) -> DataFrame:
    name = f"{_database(t)}.pos"
    tables.create_table(t.spark, name, "txnno DECIMAL(38,9), spendby STRING, loaddt DATE", "loaddt")
    tables.reload_partition(t.pos().select("txnno", "spendby"), name, "loaddt", D1)
    tables.reload_partition(second, name, "loaddt", D2)
    tables.reload_partition(third, name, "loaddt", D2)
    return t.spark.table(name)


@query(f"""SELECT txnno, spendby, '{DAY1}' AS loaddt FROM pos
           UNION ALL SELECT txnno, spendby, '{DAY2}' FROM pos WHERE spendby = 'credit'""")
def partition_reload(t):
    pos = t.pos().select("txnno", "spendby")
    return _reloaded(t, pos.filter("spendby = 'cash'"), pos.filter("spendby = 'credit'"))


@query(f"SELECT txnno, spendby, '{DAY1}' AS loaddt FROM pos")
def partition_reload_empty(t):
    pos = t.pos().select("txnno", "spendby")
    return _reloaded(t, pos, pos.filter("spendby = 'barter'"))


@query("SELECT txnno, CAST(dt AS VARCHAR) AS dt, '2023-06-30' AS ingest_dt FROM mobile")
def ingest_day_append(t):
    name = f"{_database(t)}.mobile"
    tables.append_by_ingest_day(t.mobile().select("txnno", "dt"), name, CLOCK.day)
    return t.spark.table(name)


@query("SELECT customerid, productname FROM online WHERE 1 = 2")
def schema_clone(t):
    name = f"{_database(t)}.empty_copy"
    tables.clone_schema(t.online().select("customerid", "productname"), name)
    return t.spark.table(name)


@query("SELECT customerid, productname, productcategory FROM online WHERE productcategory = 'Furniture'")
def subset_table(t):
    name = f"{_database(t)}.furniture"
    rows = t.online().select("customerid", "productname", "productcategory")
    tables.load_subset(rows, name, F.col("productcategory") == "Furniture")
    return t.spark.table(name)


@query("SELECT custno, txnno, amount FROM pos")
def clustered_layout(t):
    name = f"{_database(t)}.clustered"
    tables.refresh_table(tables.cluster_rows(t.pos().select("custno", "txnno", "amount"), "custno", "txnno"), name)
    return t.spark.table(name)


@query(CHANGED)
def scd1_upsert(t):
    name = f"{_database(t)}.cust_part_curated_merge"
    changes.apply_type1(curate_delta(t.delta_day1(), D1), name)
    changes.apply_type1(curate_delta(t.delta_day2(), D2), name)
    return t.spark.table(name)


@query(CHANGED)
def scd1_published(t):
    """The upsert into a versioned table: each load appears in one step, old versions are collected."""
    name = f"{_database(t)}.cust_part_curated_merge"
    versions.create_versioned(t.spark, name, changes.CHANGE_COLUMNS, "datadt")
    changes.apply_type1(curate_delta(t.delta_day1(), D1), name)
    changes.apply_type1(curate_delta(t.delta_day2(), D2), name)
    versions.collect_versions(t.spark, name)
    return t.spark.table(name)


@query(CHANGED)
def scd1_indexed(t):
    """The upsert that finds its partitions through the key index."""
    name = f"{_database(t)}.cust_part_curated_merge"
    changes.apply_indexed(curate_delta(t.delta_day1(), D1), name)
    changes.apply_indexed(curate_delta(t.delta_day2(), D2), name)
    return t.spark.table(name)


@query(CHANGED)
def scd1_late_day(t):
    """The first day comes last: its rows win only where no later day has the key."""
    name = f"{_database(t)}.cust_part_curated_merge"
    changes.apply_ordered(curate_delta(t.delta_day2(), D2), name)
    changes.apply_ordered(curate_delta(t.delta_day1(), D1), name)
    changes.apply_ordered(curate_delta(t.delta_day2(), D2), name)
    return t.spark.table(name)


@query("SELECT custno, profession, datadt FROM delta2")
def delete_published(t):
    """Deletes and a reloaded day in a versioned table."""
    name = f"{_database(t)}.customers"
    versions.create_versioned(t.spark, name, changes.CHANGE_COLUMNS, "datadt")
    changes.apply_type2(curate_delta(t.delta_day1(), D1), name, D1)
    changes.apply_type2(curate_delta(t.delta_day1(), D1).filter("profession IS NULL"), name, D2)
    tables.delete_where(t.spark, name, F.col("datadt") == F.lit(D1))
    changes.apply_type2(curate_delta(t.delta_day2(), D2), name, D2)
    return t.spark.table(name).select("custno", "profession", "datadt")


@query(f"""SELECT state, city, category, product, max(amount) AS max_amt, min(amount) AS min_amt, sum(amount) AS sum_amt,
                  count(*) FILTER (WHERE state IN ('Nevada', 'Texas', 'Oregon')) AS states_cnt,
                  count(*) FILTER (WHERE amount < 100) AS mid_amt_cnt, count(*) FILTER (WHERE amount >= 100) AS high_amt_cnt,
                  count(DISTINCT custno) AS customers, TRUE AS within
           FROM {KPI_ROWS} GROUP BY state, city, category, product""")
def kpi_by_load_day(t):
    """Partials of two load days, one of them loaded wrongly at first; the estimate is held against the exact count."""
    name, (one, two) = f"{_database(t)}.kpi_partials", (D1, D2)
    day = F.when(F.col("custno") % 2 == 0, F.lit(one)).otherwise(F.lit(two))
    sources = t.consumer(), t.pos().withColumn("loaddt", day), t.mobile_of(2023)
    partials = kpi_days.day_partials(*sources)
    kpi_days.load_days(partials, name, [one])
    kpi_days.load_days(partials.withColumn("sum_amt", F.lit(-1.0)), name, [two])
    kpi_days.load_days(partials, name, [two])
    exact = kpi_by_place(*sources, exact_customers=True).select(*kpi_days.PLACE, F.col("approx_cnt_cust").alias("customers"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in kpi_days.PLACE]
    joined = kpi_days.merged_kpi(t.spark, name).join(exact.withColumnsRenamed({c: f"_{c}" for c in kpi_days.PLACE}), same)
    within = F.abs(F.col("approx_cnt_cust") - F.col("customers")) <= 0.05 * F.col("customers") + 1
    return joined.withColumn("within", within).drop("approx_cnt_cust", *[f"_{c}" for c in kpi_days.PLACE])


@query(BOTH_DAYS)
def scd2_snapshot(t):
    name = f"{_database(t)}.cust_part_curated"
    changes.apply_type2(curate_delta(t.delta_day1(), D1), name, D1)
    for _ in range(2):
        changes.apply_type2(curate_delta(t.delta_day2(), D2), name, D2)
    return t.spark.table(name)


@query(f"SELECT datadt, count(*) AS n_rows FROM ({BOTH_DAYS}) GROUP BY datadt")
def rows_per_data_date(t):
    name = f"{_database(t)}.cust_part_curated"
    changes.apply_type2(curate_delta(t.delta_day1(), D1), name, D1)
    changes.apply_type2(curate_delta(t.delta_day2(), D2), name, D2)
    return changes.rows_per_day(t.spark, name)


@query(f"""SELECT custno, CASE WHEN profession = 'na' THEN 'unset' ELSE profession END AS profession, datadt
           FROM ({BOTH_DAYS})""")
def update_rows(t):
    name = f"{_database(t)}.customers"
    changes.apply_type2(curate_delta(t.delta_day1(), D1), name, D1)
    changes.apply_type2(curate_delta(t.delta_day2(), D2), name, D2)
    tables.update_where(t.spark, name, F.col("profession") == "na", {"profession": "unset"})
    return t.spark.table(name).select("custno", "profession", "datadt")


@query(f"SELECT custno, profession, datadt FROM ({BOTH_DAYS}) WHERE profession <> 'na'")
def delete_rows(t):
    name = f"{_database(t)}.customers"
    changes.apply_type2(curate_delta(t.delta_day1(), D1), name, D1)
    changes.apply_type2(curate_delta(t.delta_day2(), D2), name, D2)
    tables.delete_where(t.spark, name, F.col("profession") == "na")
    return t.spark.table(name).select("custno", "profession", "datadt")


@query("SELECT count(*) AS n_source, count(*) AS n_target FROM orders")
def reconcile_counts(t):
    rows, watch = counted(t.read("orders"))
    path = write_csv(rows, new_path(t.spark, "copy"))
    copied = t.spark.read.csv(path)
    reconcile(watch.get["n_rows"], copied)
    return copied.agg(F.lit(watch.get["n_rows"]).alias("n_source"), F.count(F.lit(1)).alias("n_target"))


@query("SELECT * FROM consumer_raw")
def csv_by_header(t):
    """Three files of one folder: columns in order, reversed, and with one more."""
    landing, rows = new_path(t.spark, "headers"), t.consumer_raw().select(*CONSUMER_NAMES)
    third = F.pmod(F.xxhash64("custid"), F.lit(3))
    parts = rows, rows.select(*reversed(CONSUMER_NAMES)), rows.select("profession", F.lit("x").alias("extra"), *CONSUMER_NAMES[:-1])
    for i, part in enumerate(parts):
        write_csv(part.filter(third == i), f"{landing}/part{i}", header=True)
    return files.read_by_header(t.spark, f"{landing}/*", CONSUMER)


@query("SELECT count(*) AS n_rows, sum(o_orderkey) AS keys FROM orders")
def reconcile_contents(t):
    """A written copy is accepted by its checksums, a changed one is refused."""
    rows, watch = checksummed(t.read("orders"))
    path = new_path(t.spark, "copy")
    rows.write.parquet(path)
    copied = t.spark.read.parquet(path)
    count = reconcile_content(watch, copied)
    try:
        reconcile_content(watch, copied.withColumn("o_orderstatus", F.lit("?")))
        raise AssertionError("a changed column was accepted")
    except ContentMismatch as error:
        assert "o_orderstatus" in str(error)
    return copied.agg(F.lit(count).alias("n_rows"), F.sum("o_orderkey").alias("keys"))


@query("""SELECT count(*) AS n_keys, 1 AS least, count(*) AS most, count(*) AS n_numbers, 0 AS moved
          FROM (SELECT DISTINCT orderId, p.productId AS productid FROM items) k""")
def dense_keys(t):
    """Order items numbered in two loads: dense, unique, and the first load's numbers stay."""
    name = f"{_database(t)}.item_keys"
    items = unnest_products(t.online_raw()).select("orderId", F.col("product.productId").alias("productid"))
    key_maps.extend_key_map(items.filter(F.pmod(F.xxhash64("orderId"), F.lit(3)) > 0), name, "orderId", "productid")
    first = pinned(t.spark.table(name), "first-keys")
    for _ in range(2):
        key_maps.extend_key_map(items, name, "orderId", "productid")
    same = [F.col("a.orderId").eqNullSafe(F.col("b.orderId")), F.col("a.productid").eqNullSafe(F.col("b.productid"))]
    return t.spark.table(name).alias("b").join(first.alias("a"), same, "left").agg(
        F.count(F.lit(1)).alias("n_keys"), F.min("b.sk").cast("int").alias("least"), F.max("b.sk").alias("most"),
        F.count_distinct("b.sk").alias("n_numbers"), F.count_if(F.col("a.sk") != F.col("b.sk")).cast("int").alias("moved"))


# -- procedures and stream --------------------------------------------------


@query(CHANGED)
def cust_etl_scd1(t):
    db = _database(t)
    for path in _delta_files(t)[1:]:
        changes.customer_etl(t.spark, path, "scd1", db)
    return t.spark.table(f"{db}.cust_part_curated_merge")


@query(BOTH_DAYS)
def cust_etl_scd2(t):
    db = _database(t)
    for path in _delta_files(t)[1:]:
        changes.customer_etl(t.spark, path, "scd2", db)
    return t.spark.table(f"{db}.cust_part_curated")


@query("""SELECT * FROM (VALUES
            ('read_delta', 'START', 'customer_change_load'),
            ('read_delta', 'SUCCESS', 'customer_change_load'),
            ('store_snapshot', 'START', 'customer_change_load'),
            ('store_snapshot', 'SUCCESS', 'customer_change_load')) v(processtype, errtype, jobname)""")
def audit_trail(t):
    db = _database(t)
    changes.customer_etl(t.spark, _delta_files(t)[1], "scd2", db)
    return t.spark.table(f"{db}.audit_tbl").select("processtype", "errtype", "jobname")


@query("""SELECT * FROM (VALUES
            ('read_delta', 'START'),
            ('read_delta', 'SUCCESS'),
            ('unknown_flag', 'SUCCESS')) v(processtype, errtype)""")
def cust_etl_bad_flag(t):
    db = _database(t)
    changes.customer_etl(t.spark, _delta_files(t)[1], "scd9", db)
    return t.spark.table(f"{db}.audit_tbl").select("processtype", "errtype")


@query(CHANGED)
def metadata_driven_scd1(t):
    """The file path comes from the metadata table, which is updated between the loads."""
    db = _database(t)
    _, first, second = _delta_files(t)
    meta, one, two = f"{db}.etl_meta", f"{db}.scd1_merge", f"{db}.scd2_append"
    tables.create_table(t.spark, meta, "id BIGINT, rulesql STRING")
    t.spark.sql(f"INSERT INTO {meta} VALUES (3, :path)", args={"path": first})
    changes.load_delta(t.spark, meta, 3, one, two, view="meta_ext")
    tables.update_where(t.spark, meta, F.col("id") == 3, {"rulesql": second})
    changes.load_delta(t.spark, meta, 3, one, two, view="meta_ext")
    return t.spark.table(one)


@query(CHANGED)
def incremental_scd1(t):
    """A file stream finds both days in one batch and applies them in date order."""
    name = f"{_database(t)}.cust_part_curated_merge"
    landing = _delta_files(t)[0]
    for _ in range(2):  # the second start finds nothing new
        pick_up_deltas(t.spark, landing, f"{landing}-checkpoint", type1_table=name).awaitTermination()
    return t.spark.table(name)


def _part_files(t) -> str:
    """Both deltas as dated folders of three part files; one part of the first day is held back outside."""
    landing = new_path(t.spark, "parts")
    for rows, day in ((t.delta_day1(), D1), (t.delta_day2(), D2)):
        for part in range(3):
            late = "late" if (day, part) == (D1, 2) else "landing"
            some = rows.filter(F.pmod(F.xxhash64("custno"), F.lit(3)) == part).coalesce(1)
            write_csv(some, f"{landing}/{part}-{late}/customers_{day:%Y%m%d}", header=True)
    return landing


def _picked_up(t, **target):
    """One file a batch; the late part lands after both days have been applied."""
    landing = _part_files(t)
    for pattern in ("*-landing/customers_*", "*-l*/customers_*"):
        pick_up_deltas(t.spark, landing, f"{landing}-checkpoint-{len(pattern)}", pattern=pattern, max_files=1,
                       landed=f"{landing}-landed", **target).awaitTermination()


@query(BOTH_DAYS)
def incremental_scd2_parts(t):
    name = f"{_database(t)}.cust_part_curated"
    _picked_up(t, type2_table=name)
    return t.spark.table(name)


@query(CHANGED)
def incremental_scd1_parts(t):
    name = f"{_database(t)}.cust_part_curated_merge"
    _picked_up(t, type1_table=name)
    return t.spark.table(name)


@query("""SELECT 'read_delta' AS processtype, 'FAILURE' AS errtype, 3 AS bad_rows, (SELECT count(*) FROM delta1) AS n_rows
          UNION ALL SELECT 'read_delta', 'START', 0, (SELECT count(*) FROM delta1)""")
def audit_failure(t):
    """Three spoiled rows, one more than allowed: START and FAILURE with the count, then nothing."""
    db = _database(t)
    day = t.delta_day1()
    worst = [r[0] for r in day.orderBy("custno").select("custno").limit(3).collect()]
    spoiled = day.withColumn("age", F.when(F.col("custno").isin(worst), "old").otherwise(F.col("age").cast("string")))
    path = write_csv(spoiled, f"{new_path(t.spark, 'bad')}/customers_{D1:%Y%m%d}", header=True)
    changes.customer_etl(t.spark, path, "scd1", db, swallow=True)
    bad = F.coalesce(F.expr("try_cast(regexp_extract(errormsg, '([0-9]+) malformed', 1) AS int)"), F.lit(0))
    return t.spark.table(f"{db}.audit_tbl").select(
        "processtype", "errtype", bad.alias("bad_rows"), F.lit(day.count()).alias("n_rows"))


@query("""SELECT 'rawload' AS proc_name, description, (SELECT count(*) FROM consumer_raw) AS consumers FROM (VALUES
            ('consumers read'), ('store transactions read'), ('online transactions read'), ('mobile transactions read'),
            ('raw layer complete')) v(description)""")
def progress_notes(t):
    names, _ = _layered(t)
    notes = t.spark.table(f"{names.raw}.audit_meta").select("proc_name", "description")
    return notes.withColumn("consumers", F.lit(t.spark.table(f"{names.raw}.consumer").count()))


@query("SELECT 'age=' || CAST(age AS VARCHAR) AS partition, count(*) AS n_rows FROM consumer GROUP BY age")
def partition_listing(t):
    """Partitions by name, each with the rows read back from it."""
    name = f"{_database(t)}.cust_info"
    tables.refresh_table(t.consumer().select("custno", "age"), name, partition_by="age")
    listed = t.spark.sql(f"SHOW PARTITIONS {name}")
    sizes = t.spark.table(name).groupBy(F.concat(F.lit("age="), F.col("age").cast("string")).alias("name")).count()
    return listed.join(sizes, F.col("partition") == F.col("name")).select("partition", F.col("count").alias("n_rows"))


@query(f"SELECT custno, '{CLOCK.suffix()}' AS stamp FROM consumer")
def run_stamp(t):
    return t.consumer().select("custno", F.lit(catalog.run_stamp(t.spark, CLOCK)).alias("stamp"))


@query("""SELECT orderId, customerId, p.productId AS productid, CAST(p.productPrice AS BIGINT) AS price FROM items""")
def json_inferred(t):
    """The nested schema is found in the data."""
    path = write_json(t.online_raw(), new_path(t.spark, "json"))
    return unnest_products(files.read_json_lines(t.spark, path)).select(
        "orderId", "customerId", F.col("product.productId").alias("productid"),
        F.col("product.productPrice").cast("bigint").alias("price"),
    )


@query("SELECT custno, age FROM consumer WHERE age > 40")
def truncate_insert_partitioned(t):
    """Rows of every old partition go, also when the session overwrites partitions dynamically."""
    name = f"{_database(t)}.cust_info"
    tables.refresh_table(t.consumer().select("custno", "age"), name, partition_by="age")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = t.spark.conf.get(key, "static")
    t.spark.conf.set(key, "dynamic")
    try:
        tables.truncate_and_insert(t.consumer().select("custno", "age").filter("age > 40"), name)
    finally:
        t.spark.conf.set(key, before)
    return t.spark.table(name)


def _layered(t):
    """Raw files from the tables, then all four layers."""
    db = [new_database(t.spark, n) for n in ("raw", "curated", "discovery")]
    landing = new_path(t.spark, "raw")
    sources = layers.SourceFiles(
        consumers=write_csv(t.consumer_raw().select(*CONSUMER_NAMES), f"{landing}/consumers", header=True),
        pos=write_csv(t.pos_raw(), f"{landing}/pos"),
        online=write_json(t.online_raw(), f"{landing}/online"),
        mobile=write_csv(t.mobile_raw(), f"{landing}/mobile", header=True),
    )
    names = layers.Layers(*db)
    return names, layers.run_all(t.spark, sources, CLOCK, f"{landing}/export", names)


@query("""SELECT state, city, category, product, max(amount) AS max_amt, min(amount) AS min_amt, sum(amount) AS sum_amt
          FROM (SELECT p.* FROM consumer c JOIN pos p ON c.custno = p.custno
                JOIN (SELECT * FROM mobile WHERE year(dt) = 2023) m ON p.txnno = m.txnno) j
          GROUP BY state, city, category, product""")
def layered_kpi(t):
    names, _ = _layered(t)
    return t.spark.table(f"{names.discovery}.trans_aggr").select(
        "state", "city", "category", "product", "max_amt", "min_amt", "sum_amt"
    )


@query(f"""SELECT custno, product AS productname, online_pos_category AS productcategory, trans_type, txnno,
                  online_pos_amount, activity, city FROM ({WIDE}) w""")
def layered_wide(t):
    names, _ = _layered(t)
    wide = t.spark.table(f"{names.discovery}.consumer_trans_pos_mob_online")
    return wide.select(
        "custno", F.col("product").alias("productname"), F.col("online_pos_category").alias("productcategory"),
        "trans_type", F.when(F.col("trans_day").isNotNull(), F.col("txnno")).alias("txnno"), "online_pos_amount",
        "activity", "city",
    )


@query(f"SELECT custno, txnno, outdoor_cat, category, rpad_cat, rownum_amt, cumedist_amt, prev_trans FROM ({REPORT}) r")
def outbound_export(t):
    """The report exported as CSV shards and read back; padding survives."""
    path = export_report(t.pos(), CLOCK, new_path(t.spark, "export"))
    schema = (
        "custno BIGINT, txnno DECIMAL(38,9), outdoor_cat BOOLEAN, category STRING, strpos_cat INT, rpad_cat STRING, "
        "rev_cat STRING, len_cat INT, amount DOUBLE, rownum_amt BIGINT, rnk_amt BIGINT, densernk_amt BIGINT, "
        "cumedist_amt DOUBLE, first_trans_amt DOUBLE, third_highest_trans DOUBLE, next_trans DOUBLE, prev_trans DOUBLE"
    )
    return files.read_typed(t.spark, path, schema, header=True).select(
        "custno", "txnno", "outdoor_cat", "category", "rpad_cat", "rownum_amt", "cumedist_amt", "prev_trans"
    )


# -- transfers ---------------------------------------------------------------


def _customer_files(t) -> str:
    return write_csv(t.consumer_raw().select(*CONSUMER_NAMES), new_path(t.spark, "custs"))


@query("""SELECT custid AS custno, firstname || ',' || CAST(CAST(lastname AS BIGINT) AS VARCHAR) AS name, age,
          coalesce(profession, 'unknown') AS profession FROM consumer_raw WHERE age > 30""")
def raw_curated_customers(t):
    """Files to a raw table with inferred types, then to a curated table."""
    db = _database(t)
    out = transfers.raw_and_curated_customers(t.spark, _customer_files(t), f"{db}.customer_raw", f"{db}.customer_curated")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("custno", "age")})


@query("SELECT CAST(custid AS VARCHAR) AS custid, firstname AS fname, lastname AS lname, CAST(age AS VARCHAR) AS age, profession FROM consumer_raw")
def files_to_table(t):
    """Files copied with a count check, loaded into a table; another table exported as JSON."""
    db, out = _database(t), new_path(t.spark, "transfer")
    tables.refresh_table(t.pos().select("txnno", "amount"), f"{db}.txnrecords")
    loaded = transfers.files_to_table_to_json(
        t.spark, _customer_files(t), f"{out}/custdata_", f"{db}.custs", f"{db}.txnrecords", f"{out}/txndata_json_", CLOCK
    )
    return loaded.toDF("custid", "fname", "lname", "age", "profession")


@query("SELECT custid AS id, firstname AS custfname, lastname AS custlname, age AS custage FROM consumer_raw")
def typed_age_partitions(t):
    """Typed files to a table partitioned by age, exported as JSON and as two CSV files; the JSON read back."""
    out = new_path(t.spark, "transfer")
    transfers.typed_files_to_partitions(
        t.spark, _customer_files(t), f"{_database(t)}.cust_info", f"{out}/cust_output_json_", f"{out}/cust_csv", CLOCK
    )
    rows = files.read_json_lines(t.spark, f"{out}/cust_output_json_{CLOCK.suffix()}", CONSUMER_SHORT)
    return rows.select(F.col("id").cast("bigint"), "custfname", "custlname", F.col("custage").cast("bigint"))


@query("SELECT custid, age, profession FROM consumer_raw")
def csv_header_inferred(t):
    """Column names from the header row, types by inference."""
    path = write_csv(t.consumer_raw(), new_path(t.spark, "csv"), header=True)
    rows = files.read_inferred(t.spark, path, header=True)
    return rows.select(F.col("custid").cast("bigint"), F.col("age").cast("bigint"), "profession")


@query(BOTH_DAYS)
def dated_delta_files(t):
    """Both days' files in one read, each row dated by its path."""
    landing = _delta_files(t)[0]
    return curate_delta(files.with_file_date(files.read_typed(t.spark, f"{landing}/customers_*", DELTA, header=True)))
