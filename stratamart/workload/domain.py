"""The curated, discovery and outbound results as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.plans import curation, discovery, outbound
from stratamart.operators.skew import above_mean, find_hot_keys
from stratamart.workload.adapters import CLOCK
from stratamart.workload.registry import dates_as_text, query
from stratamart.workload.relations import PEERS, ROWS

STAMPS = "'2023-06-30 08:04:11' AS loadts, '2023-06-30' AS loaddt"


@query(f"SELECT *, {STAMPS} FROM consumer")
def curate_consumer(t):
    return t.consumer()


@query(f"SELECT *, {STAMPS} FROM online")
def curate_online(t):
    """The surrogate key is checked by ``surrogate_unique``."""
    return t.online().drop("transsk")


@query(f"SELECT txnno, CAST(txndt AS VARCHAR) AS txndt, custno, amount, category, product, city, state, spendby, {STAMPS} FROM pos")
def curate_pos(t):
    return t.pos()


@query(f"""SELECT txnno, CAST(dt AS VARCHAR) AS dt, ts, net, provider, activity, postal_code, town_name, {STAMPS}, lon, lat
           FROM mobile""")
def curate_mobile(t):
    return t.mobile().select("*", "geo_coordinate.lon", "geo_coordinate.lat").drop("geo_coordinate")


@query(f"""SELECT txnno, CAST(dt AS VARCHAR) AS dt, ts, town_name FROM mobile WHERE year(dt) = 2023""")
def curate_mobile_clamped(t):
    return t.mobile_of(2023).select("txnno", "dt", "ts", "town_name")


@query("SELECT * EXCLUDE (txndt), CAST(txndt AS VARCHAR) AS txndt FROM pos_mob")
def pos_mob_stitch(t):
    stamps = ("pos_loadts", "pos_loaddt", "mob_loadts", "mob_loaddt", "geo_coordinate")
    return discovery.stitch_pos_mobile(t.mobile(), t.pos()).select(
        "*", "geo_coordinate.lon", "geo_coordinate.lat"
    ).drop(*stamps)


@query("SELECT * FROM cust_online")
def cust_online_stitch(t):
    stamps = ("consumer_loadts", "consumer_loaddt", "online_trans_loadts", "online_trans_loaddt", "transsk")
    return discovery.stitch_consumer_online(t.consumer(), t.online()).drop(*stamps)


WIDE = f"""
SELECT coalesce(p.mob_txnno, p.pos_txnno) AS txnno,
       CAST(coalesce(p.txndt, CASE WHEN c.online_trans_type IS NOT NULL THEN DATE '2023-06-30' END) AS VARCHAR) AS txndt,
       c.custno, c.fullname, c.age, c.profession, p.trans_day, coalesce(c.online_trans_type, p.trans_type) AS trans_type,
       coalesce(p.net, 'na') AS net, coalesce(CAST(c.productprice AS DOUBLE), p.amount, 0.0) AS online_pos_amount,
       coalesce(p.provider, 'na') AS provider, coalesce(p.activity, 'na') AS activity, coalesce(p.spendby, 'na') AS spendby,
       coalesce(p.city, 'unknown') AS city, coalesce(p.state, 'unknown') AS state,
       coalesce(c.productcategory, p.category) AS online_pos_category, p.product, {STAMPS}, p.lon, p.lat
FROM cust_online c LEFT JOIN pos_mob p ON p.custno = c.custno
"""


@query(WIDE)
def consumer_wide(t):
    """Rows without a store or mobile side carry the online surrogate key, left out here."""
    wide = discovery.consumer_wide(t.consumer(), t.online(), t.mobile(), t.pos(), before_join=dates_as_text)
    return wide.select(
        F.when(F.col("trans_day").isNotNull(), F.col("txnno")).alias("txnno"),
        *[c for c in wide.columns if c not in ("txnno", "geo_coordinate")], "geo_coordinate.lon", "geo_coordinate.lat",
    )


@query(WIDE)
def consumer_wide_split(t):
    """The same fact with every key above the mean treated as heavy."""
    online, pos = t.online(), t.pos()
    hot_pos = {k: find_hot_keys(pos, k, min_rows=above_mean(pos, k)) for k in ("txnno", "custno")}
    hot_online = find_hot_keys(online, "customerid", min_rows=above_mean(online, "customerid"))
    wide = discovery.consumer_wide(t.consumer(), online, t.mobile(), pos, hot_online, hot_pos, dates_as_text)
    return wide.select(
        F.when(F.col("trans_day").isNotNull(), F.col("txnno")).alias("txnno"),
        *[c for c in wide.columns if c not in ("txnno", "geo_coordinate")], "geo_coordinate.lon", "geo_coordinate.lat",
    )


REPORT = f"""
SELECT custno, txnno, list_contains(string_split_regex(lower(category), '[^a-z0-9]+'), 'outdoor') AS outdoor_cat, category,
       CAST(strpos(category, 'R') AS INTEGER) AS strpos_cat, rpad(category, 30, ' ') AS rpad_cat,
       reverse(category) AS rev_cat, CAST(length(category) AS INTEGER) AS len_cat, amount,
       row_number() {ROWS} AS rownum_amt, rank() {PEERS} AS rnk_amt, dense_rank() {PEERS} AS densernk_amt,
       cume_dist() {PEERS} AS cumedist_amt, first_value(amount) {PEERS} AS first_trans_amt,
       nth_value(amount, 3) {PEERS} AS third_highest_trans, lead(amount) {ROWS} AS next_trans, lag(amount) {ROWS} AS prev_trans
FROM pos
"""


@query(REPORT)
def outbound_analytics(t):
    return outbound.transaction_report(t.pos(), CLOCK)


@query("SELECT txnno, txndt, custno, amt AS amount, coalesce(product, 'NA') AS category, category AS product FROM ("
       "SELECT txnno, CAST(CAST(strptime(txndt, '%m-%d-%Y') AS DATE) AS VARCHAR) AS txndt, custno, amt, category, product FROM pos_raw) x")
def pos_positional_swap(t):
    """What a positional insert of the POS select list stores."""
    swapped = curation.pos_in_select_order(t.pos())
    return swapped.toDF(*t.pos().columns).select("txnno", "txndt", "custno", "amount", "category", "product")
