"""Joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.operators.dedup import keep_highest
from stratamart.operators.joins import full_join, left_join
from stratamart.operators.ranking import rank_within
from stratamart.operators.skew import above_mean, find_all_hot_keys, find_hot_keys
from stratamart.operators.summaries import row_total, rows_per
from stratamart.plans import curation, discovery
from stratamart.workload.registry import query


@query("""SELECT m.txnno AS mob_txnno, p.txnno AS pos_txnno, m.provider, p.amount
          FROM mobile m FULL JOIN pos p ON m.txnno = p.txnno""")
def full_join_pos_mobile(t):
    mob = t.mobile().select(F.col("txnno").alias("mob_txnno"), "provider")
    pos = t.pos().select(F.col("txnno").alias("pos_txnno"), "amount")
    return full_join(
        mob, pos, "mob_txnno", "pos_txnno", find_hot_keys(mob, "mob_txnno"), find_hot_keys(pos, "pos_txnno")
    )


@query("""SELECT c.custno, o.productname, o.productprice FROM consumer c LEFT JOIN online o ON c.custno = o.customerid""")
def left_join_online(t):
    online = t.online().select("customerid", "productname", "productprice")
    hot = find_hot_keys(online, "customerid")
    return left_join(t.consumer().select("custno"), online, "custno", "customerid", hot_right=hot).drop("customerid")


@query("""SELECT c.custno, c.productname, p.trans_type, p.mob_txnno, p.pos_txnno
          FROM cust_online c LEFT JOIN pos_mob p ON p.custno = c.custno""")
def wide_join(t):
    pos, online = t.pos(), t.online()
    hot = find_all_hot_keys(pos, "txnno", "custno")
    hot_online = find_hot_keys(online, "customerid")
    left = discovery.stitch_consumer_online(t.consumer(), online, hot_online).select("custno", "productname")
    right = discovery.stitch_pos_mobile(t.mobile(), pos, hot_pos=hot["txnno"]).select(
        F.col("custno").alias("trans_custno"), "trans_type", "mob_txnno", "pos_txnno"
    ).filter("trans_custno IS NOT NULL")
    return left_join(left, right, "custno", "trans_custno", hot_online, hot["custno"]).drop("trans_custno")


@query("""SELECT p.txnno, c.custno, c.age, c.yearofbirth, c.profession, p.amount, p.category, p.product, p.city, p.state,
                 p.spendby, m.net, m.provider, m.activity, CAST(p.txndt AS VARCHAR) AS txndt
          FROM consumer c JOIN pos p ON c.custno = p.custno
          JOIN (SELECT * FROM mobile WHERE year(dt) = 2023) m ON p.txnno = m.txnno""")
def three_way_inner(t):
    return discovery.transactions_with_mobile(t.consumer(), t.pos(), t.mobile_of(2023))


@query("""SELECT orderId, storeLocation, customerId, p.productId AS productid, p.productCategory AS productcategory,
                 p.productName AS productname, p.productPrice AS productprice FROM items""")
def unnest_products(t):
    return curation.unnest_products(t.online_raw()).select(
        "orderId", "storeLocation", "customerId", F.col("product.productId").alias("productid"),
        F.col("product.productCategory").alias("productcategory"), F.col("product.productName").alias("productname"),
        F.col("product.productPrice").alias("productprice"),
    )


KPI_ROWS = """(SELECT p.* FROM consumer c JOIN pos p ON c.custno = p.custno
               JOIN (SELECT * FROM mobile WHERE year(dt) = 2023) m ON p.txnno = m.txnno) j"""


@query(f"""SELECT state, city, category, product, max(amount) AS max_amt, min(amount) AS min_amt, sum(amount) AS sum_amt,
                  count(*) FILTER (WHERE state IN ('Nevada', 'Texas', 'Oregon')) AS states_cnt,
                  count(*) FILTER (WHERE amount < 100) AS mid_amt_cnt, count(*) FILTER (WHERE amount >= 100) AS high_amt_cnt
           FROM {KPI_ROWS} GROUP BY state, city, category, product""")
def kpi_by_place(t):
    """The approximate customer count is checked by ``approx_distinct_bound``."""
    return discovery.kpi_by_place(t.consumer(), t.pos(), t.mobile_of(2023)).drop("approx_cnt_cust")


@query(f"""SELECT state, city, category, product, count(DISTINCT custno) AS customers, sum(amount) AS sum_amt
           FROM {KPI_ROWS} GROUP BY state, city, category, product""")
def kpi_exact_customers(t):
    return discovery.kpi_by_place(t.consumer(), t.pos(), t.mobile_of(2023), exact_customers=True).select(
        "state", "city", "category", "product", F.col("approx_cnt_cust").alias("customers"), "sum_amt"
    )


@query("""SELECT category, count(*) FILTER (WHERE state IN ('Nevada', 'Texas', 'Oregon')) AS states_cnt,
                 count(*) FILTER (WHERE spendby = 'cash') AS cash_cnt FROM pos GROUP BY category""")
def count_if(t):
    return t.pos().groupBy("category").agg(
        F.count_if(F.col("state").isin("Nevada", "Texas", "Oregon")).alias("states_cnt"),
        F.count_if(F.col("spendby") == "cash").alias("cash_cnt"),
    )


@query("SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS n_rows FROM mobile GROUP BY 1")
def group_count(t):
    return rows_per(t.mobile(), "dt")


@query("SELECT count(*) AS n_rows FROM lineitem")
def global_count(t):
    return row_total(t.read("lineitem"))


@query("SELECT max(amount) AS max_amt, min(amount) AS min_amt, (SELECT max(age) FROM consumer) AS max_age FROM pos")
def global_extremes(t):
    from stratamart.operators.predicates import with_scalar

    amounts = t.pos().agg(F.max("amount").alias("max_amt"), F.min("amount").alias("min_amt"))
    return with_scalar(amounts, t.consumer(), F.max("age"), "max_age")


@query("SELECT state, count(DISTINCT custno) AS customers, TRUE AS within FROM pos GROUP BY state")
def approx_distinct_bound(t):
    """The estimate lies within three standard errors (rsd 0.05) of the exact count, give or take one."""
    exact = F.col("customers")
    return (
        t.pos().groupBy("state")
        .agg(F.approx_count_distinct("custno").alias("estimate"), F.count_distinct("custno").alias("customers"))
        .select("state", "customers", (F.abs(F.col("estimate") - exact) <= 0.15 * exact + 1).alias("within"))
    )


RANKED = """SELECT custno, txnno, amount, {expr} FROM pos"""
PEERS = "OVER (PARTITION BY custno ORDER BY amount NULLS FIRST)"
ROWS = "OVER (PARTITION BY custno ORDER BY amount NULLS FIRST, txnno)"


def _ranked(t, *columns):
    pos = t.pos().select("custno", "txnno", "amount")
    return rank_within(pos, "custno", "amount", "txnno", hot=find_hot_keys(pos, "custno")).select(
        "custno", "txnno", "amount", *columns
    )


@query(RANKED.format(expr=f"row_number() {ROWS} AS rownum_amt"))
def win_row_number(t):
    return _ranked(t, "rownum_amt")


@query(RANKED.format(expr=f"rank() {PEERS} AS rnk_amt"))
def win_rank(t):
    return _ranked(t, "rnk_amt")


@query(RANKED.format(expr=f"dense_rank() {PEERS} AS densernk_amt"))
def win_dense_rank(t):
    return _ranked(t, "densernk_amt")


@query(RANKED.format(expr=f"cume_dist() {PEERS} AS cumedist_amt"))
def win_cume_dist(t):
    return _ranked(t, "cumedist_amt")


@query(RANKED.format(expr=f"first_value(amount) {PEERS} AS first_trans_amt"))
def win_first(t):
    return _ranked(t, "first_trans_amt")


@query(RANKED.format(expr=f"nth_value(amount, 3) {PEERS} AS third_highest_trans"))
def win_nth(t):
    return _ranked(t, "third_highest_trans")


@query(RANKED.format(expr=f"lead(amount) {ROWS} AS next_trans"))
def win_lead(t):
    return _ranked(t, "next_trans")


@query(RANKED.format(expr=f"lag(amount) {ROWS} AS prev_trans"))
def win_lag(t):
    return _ranked(t, "prev_trans")


ALL_RANKS = f"""SELECT custno, txnno, amount, row_number() {ROWS} AS rownum_amt, rank() {PEERS} AS rnk_amt,
  dense_rank() {PEERS} AS densernk_amt, cume_dist() {PEERS} AS cumedist_amt,
  first_value(amount) {PEERS} AS first_trans_amt, nth_value(amount, 3) {PEERS} AS third_highest_trans,
  lead(amount) {ROWS} AS next_trans, lag(amount) {ROWS} AS prev_trans FROM pos"""


@query(ALL_RANKS)
def win_by_ranges(t):
    """Customers with more than the mean number of rows go through the range-split ranking."""
    pos = t.pos().select("custno", "txnno", "amount")
    return rank_within(pos, "custno", "amount", "txnno", hot=find_hot_keys(pos, "custno", min_rows=above_mean(pos, "custno")))


@query("""SELECT m.userno, p.custno, count(*) AS n_rows, count(m.txnno) AS n_mob, sum(p.amount) AS sum_amt
          FROM (SELECT txnno, postal_code - 10000 AS userno FROM mobile) m FULL JOIN pos p ON m.userno = p.custno
          GROUP BY m.userno, p.custno""")
def full_join_split(t):
    """Many-to-many full join where keys above the mean are treated as heavy."""
    mob = t.mobile().select("txnno", (F.col("postal_code") - 10000).alias("userno"))
    pos = t.pos().select("custno", "amount")
    joined = full_join(
        mob, pos, "userno", "custno",
        find_hot_keys(mob, "userno", min_rows=above_mean(mob, "userno")),
        find_hot_keys(pos, "custno", min_rows=above_mean(pos, "custno")), salts=8,
    )
    return joined.groupBy("userno", "custno").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("txnno").alias("n_mob"), F.sum("amount").alias("sum_amt")
    )


@query("SELECT custid, firstname, lastname, age, profession FROM (SELECT *, row_number() OVER (PARTITION BY custid "
       "ORDER BY age DESC NULLS LAST, firstname DESC NULLS LAST, lastname DESC NULLS LAST, profession DESC NULLS LAST) "
       "AS rnk FROM consumer_raw) d WHERE rnk = 1")
def dedup_latest(t):
    return keep_highest(t.consumer_raw(), "custid", "age")


@query("SELECT txnno, CAST(dt AS VARCHAR) AS dt FROM mobile")
def union_years(t):
    return t.mobile_of(2021).unionByName(t.mobile_of(2022)).unionByName(t.mobile_of(2023)).select("txnno", "dt")


@query("SELECT town_name, provider FROM mobile WHERE year(dt) = 2021 UNION SELECT town_name, provider FROM mobile WHERE year(dt) = 2022")
def union_distinct(t):
    years = [t.mobile_of(y).select("town_name", "provider") for y in (2021, 2022)]
    return years[0].unionByName(years[1]).distinct()


@query("SELECT txnno, amount FROM pos ORDER BY amount DESC, txnno LIMIT 100")
def top_ordered(t):
    return t.pos().select("txnno", "amount").orderBy(F.col("amount").desc(), "txnno").limit(100)
