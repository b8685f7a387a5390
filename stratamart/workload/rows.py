"""Row-level queries: projection, filters, predicates, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.functions import dates, geo, text
from stratamart.operators import predicates
from stratamart.operators.dedup import distinct_rows
from stratamart.operators.joins import semi_join
from stratamart.plans import curation
from stratamart.plans.discovery import ACTIVITY_LABELS, KPI_STATES
from stratamart.sources.catalog import query_view
from stratamart.workload.adapters import CLOCK
from stratamart.workload.registry import query


@query("""SELECT custid AS custno, firstname || ',' || lastname AS name, age,
          coalesce(profession, 'unknown') AS profession FROM consumer_raw WHERE age > 30""")
def customers_over_30(t):
    return curation.customers_over(t.consumer_raw(), 30)


@query("""SELECT custid AS custno, firstname || ',' || lastname AS name, age,
          coalesce(profession, 'unknown') AS profession FROM consumer_raw WHERE age > 30""")
def view_query(t):
    """The same projection as SQL text over a registered view."""
    return query_view(
        t.spark, t.consumer_raw(), "raw_view",
        "SELECT custid AS custno, concat(firstname, ',', lastname) AS name, age, "
        "coalesce(profession, 'unknown') AS profession FROM raw_view WHERE age > 30",
    )


@query("SELECT custid, firstname || ' ' || lastname AS fullname, lastname IS NULL AS no_lastname FROM consumer_raw")
def full_name_null(t):
    return t.consumer_raw().select(
        "custid", text.full_name(F.col("firstname"), F.col("lastname")).alias("fullname"),
        F.col("lastname").isNull().alias("no_lastname"),
    )


@query("SELECT custid, coalesce(profession, coalesce(lastname, 'none')) AS label, coalesce(age, 0) AS age FROM consumer_raw")
def null_default(t):
    return t.consumer_raw().select(
        "custid", text.default_if_null(F.col("profession"), F.col("lastname"), "none").alias("label"),
        text.default_if_null(F.col("age"), 0).cast("bigint").alias("age"),
    )


@query("""SELECT txnno, CASE WHEN activity = 'STILL' THEN 'In Store Pickup' ELSE activity END AS activity
          FROM mobile_raw""")
def case_map(t):
    return t.mobile_raw().select("txnno", predicates.map_values(F.col("activity"), ACTIVITY_LABELS).alias("activity"))


@query("SELECT txnno, custno, category, city, state, spendby FROM pos_raw")
def except_columns(t):
    return t.pos_raw().drop("txndt", "amt", "product")


@query("""SELECT orderId, CAST(customerId AS BIGINT) AS customerid, CAST(p.productPrice AS BIGINT) AS price FROM items""")
def cast_strict(t):
    item = F.col("product")
    return curation.unnest_products(t.online_raw()).select(
        F.col("orderId"), F.col("customerId").cast("bigint").alias("customerid"),
        item["productPrice"].cast("bigint").alias("price"),
    )


@query("SELECT txnno, CAST(dt AS VARCHAR) AS dt, provider FROM mobile_raw WHERE year(dt) = 2022")
def year_filter(t):
    return predicates.of_year(t.mobile_raw(), 2022, "dt").select("txnno", "dt", "provider")


@query("SELECT txnno, custno, amount FROM pos WHERE txndt = DATE '2023-06-30'")
def today_partition(t):
    return predicates.of_run_day(t.pos(), CLOCK, "txndt").select("txnno", "custno", "amount")


@query("""SELECT txnno, CAST(CASE WHEN dt > DATE '2023-06-30' THEN DATE '2023-06-30' ELSE dt END AS VARCHAR) AS dt
          FROM mobile_raw""")
def clamp_future_dates(t):
    return t.mobile_raw().select("txnno", dates.clamp_future(F.col("dt"), CLOCK).alias("dt"))


@query("SELECT txnno, state, city FROM pos_raw WHERE state IN ('Nevada', 'Texas', 'Oregon')")
def in_list(t):
    return t.pos_raw().filter(predicates.member_of(F.col("state"), KPI_STATES)).select("txnno", "state", "city")


@query("SELECT txnno, txnno IS NULL AS no_txn, provider IS NOT NULL AS has_provider FROM mobile_raw")
def is_null_flag(t):
    return t.mobile_raw().select(
        "txnno", F.col("txnno").isNull().alias("no_txn"), F.col("provider").isNotNull().alias("has_provider")
    )


@query("""SELECT custid, '2023-06-30 08:04:11' AS loadts, '2023-06-30' AS loaddt FROM consumer_raw""")
def load_stamp(t):
    return t.consumer_raw().select("custid").withColumns(dates.load_stamps(CLOCK))


@query("""SELECT custid, age, profession FROM consumer_raw o WHERE EXISTS (
            SELECT 1 FROM consumer_raw i WHERE i.custid = o.custid AND i.age = o.age AND i.profession IS NULL)""")
def exists_semi(t):
    raw = t.consumer_raw().select("custid", "age", "profession")
    return semi_join(raw, t.consumer_raw().filter(F.col("profession").isNull()), ["custid", "age"])


@query("SELECT custid, age, (SELECT max(age) FROM consumer_raw) AS max_age FROM consumer_raw")
def scalar_max(t):
    return predicates.with_scalar(t.consumer_raw().select("custid", "age"), t.consumer_raw(), F.max("age"), "max_age")


@query("""SELECT txnno, city, category FROM pos_raw
          WHERE (city, category) IN (SELECT DISTINCT city, category FROM pos_raw WHERE amt >= 450)""")
def multi_col_in(t):
    pos = t.pos_raw()
    return semi_join(pos.select("txnno", "city", "category"), t.pos_raw().filter("amt >= 450"), ["city", "category"])


@query("SELECT DISTINCT firstname || ',' || profession AS pair FROM consumer_raw")
def distinct_keys(t):
    return distinct_rows(
        t.consumer_raw().select(text.full_name(F.col("firstname"), F.col("profession"), ",").alias("pair"))
    )


@query("""SELECT txnno, category, list_contains(string_split_regex(lower(category), '[^a-z0-9]+'), 'outdoor') AS outdoor_cat
          FROM pos_raw""")
def str_search(t):
    return t.pos_raw().select("txnno", "category", text.has_token(F.col("category"), "Outdoor").alias("outdoor_cat"))


@query("SELECT txnno, CAST(strpos(category, 'R') AS INTEGER) AS strpos_cat FROM pos_raw")
def str_pos(t):
    return t.pos_raw().select("txnno", text.position_of(F.col("category"), "R").alias("strpos_cat"))


@query("SELECT txnno, rpad(category, 30, ' ') AS rpad_cat, rpad(category, 5, ' ') AS cut_cat FROM pos_raw")
def str_rpad(t):
    return t.pos_raw().select(
        "txnno", text.pad_right(F.col("category"), 30).alias("rpad_cat"),
        text.pad_right(F.col("category"), 5).alias("cut_cat"),
    )


@query("SELECT txnno, reverse(category) AS rev_cat, CAST(length(category) AS INTEGER) AS len_cat FROM pos_raw")
def str_reverse_len(t):
    return t.pos_raw().select(
        "txnno", F.reverse("category").alias("rev_cat"), F.char_length("category").alias("len_cat")
    )


@query("""SELECT orderId, p.productId AS productid,
                 TRY_CAST(regexp_replace(p.productId, '[^0-9]', '', 'g') AS BIGINT) AS productidint,
                 coalesce(nullif(regexp_replace(lower(p.productId), '[^a-z]', '', 'g'), ''), 'na') AS prodidstr
          FROM items""")
def regex_split_id(t):
    item = F.col("product")
    return curation.unnest_products(t.online_raw()).select(
        "orderId", item["productId"].alias("productid"),
        text.id_number(item["productId"]).alias("productidint"), text.id_letters(item["productId"]).alias("prodidstr"),
    )


@query("""SELECT event_id, strftime(ts, '%Y%m%d') AS tail, strftime(ts, '%Y-%m-%d') AS datadt FROM events""")
def uri_date(t):
    uris = t.read("events").selectExpr(
        "event_id", "concat('/landing/customers_', replace(substring(CAST(ts AS STRING), 1, 10), '-', '')) AS uri"
    )
    return uris.select(
        "event_id", text.last_chars(F.col("uri"), 8).alias("tail"), dates.uri_date(F.col("uri")).alias("datadt")
    )


@query("SELECT txnno, CAST(CAST(strptime(txndt, '%m-%d-%Y') AS DATE) AS VARCHAR) AS txndt FROM pos_raw")
def date_parse(t):
    return t.pos_raw().select("txnno", dates.parse_pos_date(F.col("txndt")).alias("txndt"))


@query("SELECT txnno, CAST(dt AS VARCHAR) || ' ' || hour AS ts FROM mobile_raw")
def ts_merge(t):
    return t.mobile_raw().select("txnno", dates.merge_date_time(F.col("dt"), F.col("hour")).alias("ts"))


@query("SELECT custid, 2023 - age AS yearofbirth FROM consumer_raw")
def year_of_birth(t):
    return t.consumer_raw().select("custid", dates.year_of_birth(F.col("age"), CLOCK).alias("yearofbirth"))


@query("SELECT txnno, long AS lon, lat FROM mobile_raw")
def geo_point(t):
    return t.mobile_raw().select("txnno", geo.geo_point(F.col("long"), F.col("lat")).alias("g")).select("txnno", "g.lon", "g.lat")


@query("SELECT count(*) AS n_rows, count(*) AS n_keys, 0 AS n_negative FROM items")
def surrogate_unique(t):
    return t.online().agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("transsk").alias("n_keys"),
        F.count_if(F.col("transsk") < 0).alias("n_negative"),
    )


@query("""SELECT custid, firstname, regexp_replace(regexp_replace(regexp_replace(coalesce(profession, '?'),
            '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS profession FROM consumer_raw""")
def masked_view(t):
    from stratamart.sources.catalog import create_masked_view

    raw = t.consumer_raw().select("custid", "firstname", F.coalesce("profession", F.lit("?")).alias("profession"))
    create_masked_view(t.spark, raw, "consumer_masked", ["profession"])
    return t.spark.table("consumer_masked")
