"""The given tables seen as retail sources, in Spark and as SQL.

Every adapter is a narrow projection of one table (POS joins the 25-row nation
table), so the work of a query is the operator's own and grows with the tables.
Nulls, ties, repeated consumers and unmatched keys are put in on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.clock import RunClock
from stratamart.plans import curation

AS_OF = "2023-06-30T08:04:11"
CLOCK = RunClock.at(AS_OF)
YEARS = range(2021, 2024)
DAY1, DAY2 = "2025-07-01", "2025-07-02"


class Tables:
    """Lazy frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- raw sources -------------------------------------------------------

    def consumer_raw(self) -> DataFrame:
        """Each customer twice, with different ages and professions; some parts null."""
        return self.read("customer").selectExpr(
            "c_custkey AS custid",
            "split_part(c_name, '#', 1) AS firstname",
            "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS lastname",
            "inline(array("
            " struct(nullif(21 + c_custkey % 55, 30) AS age, nullif(c_mktsegment, 'FURNITURE') AS profession),"
            " struct(nullif(21 + (c_custkey * 7) % 55, 30) AS age, c_mktsegment AS profession)))",
        )

    def pos_raw(self) -> DataFrame:
        return (
            self.read("orders").join(self.read("nation"), F.expr("o_custkey % 25 = n_nationkey"))
            .selectExpr(
                "CAST(o_orderkey AS DECIMAL(38,9)) AS txnno",
                "date_format(date_add(DATE'2021-01-01', CAST(o_orderkey % 1000 AS INT)), 'MM-dd-yyyy') AS txndt",
                "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS custno",
                "CAST(floor(o_totalprice / 1000) AS DOUBLE) AS amt",
                "CASE o_orderkey % 4 WHEN 0 THEN 'Outdoor Recreation' WHEN 1 THEN 'Team Sports' "
                "WHEN 2 THEN 'outdoor-play & Garden' ELSE o_orderpriority END AS category",
                "nullif(concat('Product ', CAST(o_orderkey % 40 AS STRING)), 'Product 7') AS product",
                "concat('City ', CAST(n_regionkey AS STRING), '-', CAST(n_nationkey AS STRING)) AS city",
                "CASE n_nationkey % 5 WHEN 0 THEN 'Texas' WHEN 1 THEN 'Nevada' ELSE n_name END AS state",
                "CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'credit' END AS spendby",
            )
        )

    def mobile_raw(self) -> DataFrame:
        return self.read("events").selectExpr(
            "CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id AS DECIMAL(38,9)) END AS txnno",
            "CASE WHEN event_id % 3 = 0 THEN date_add(DATE'2021-01-01', CAST(event_id % 1000 AS INT)) "
            "ELSE add_months(CAST(ts AS DATE), CAST(-12 * (event_id % 5) AS INT)) END AS dt",
            "substring(CAST(ts AS STRING), 12, 8) AS hour",
            "CAST(event_id * 7 % 3600 AS DOUBLE) / 10 - 180 AS long",
            "CAST(event_id * 3 % 1800 AS DOUBLE) / 10 - 90 AS lat",
            "CASE event_id % 3 WHEN 0 THEN 'wifi' WHEN 1 THEN '4g' END AS net",
            "CASE WHEN user_id % 10 <> 0 THEN concat('provider ', CAST(user_id % 7 AS STRING)) END AS provider",
            "CASE event_type WHEN 'view' THEN 'STILL' WHEN 'error' THEN NULL ELSE upper(event_type) END AS activity",
            "10000 + user_id AS postal_code",
            "concat('town ', CAST(user_id % 20 AS STRING)) AS town_name",
        )

    def online_raw(self) -> DataFrame:
        """Orders as nested documents of none to three products."""
        return self.read("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS orderId",
            "o_orderstatus AS storeLocation",
            "CAST(o_custkey AS STRING) AS customerId",
            "transform(slice(array(1, 2, 3), 1, CAST(o_orderkey % 4 AS INT)), i -> struct("
            " CASE (o_orderkey + i) % 4 WHEN 0 THEN CAST(o_orderkey % 900 + i AS STRING)"
            "  WHEN 1 THEN concat(CAST(o_orderkey % 900 + i AS STRING), 'P')"
            "  WHEN 2 THEN concat('A', CAST(o_orderkey % 900 + i AS STRING), 'b') ELSE 'X' END AS productId,"
            " CASE (o_orderkey + i) % 3 WHEN 0 THEN 'Furniture' WHEN 1 THEN 'Laptop' ELSE 'Mobile' END AS productCategory,"
            " concat('item ', CAST(o_orderkey % 100 AS STRING), '-', CAST(i AS STRING)) AS productName,"
            " CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) + i AS STRING) AS productPrice)) AS products",
        )

    def delta_day1(self) -> DataFrame:
        return self.read("customer").selectExpr(
            "c_custkey AS custno", "split_part(c_name, '#', 1) AS firstname", "split_part(c_name, '#', 2) AS lastname",
            "21 + c_custkey % 55 AS age", "nullif(c_mktsegment, 'FURNITURE') AS profession",
            "TIMESTAMP'2024-08-01 00:00:01' AS upd_ts",
        )

    def delta_day2(self) -> DataFrame:
        """Changed customers of one segment and, for another, customers with new keys."""
        return self.read("customer").filter("c_mktsegment IN ('BUILDING', 'MACHINERY')").selectExpr(
            "CASE c_mktsegment WHEN 'BUILDING' THEN c_custkey ELSE c_custkey + 1000000000 END AS custno",
            "split_part(c_name, '#', 1) AS firstname", "split_part(c_name, '#', 2) AS lastname",
            "22 + c_custkey % 55 AS age", "CASE c_mktsegment WHEN 'BUILDING' THEN 'Editor' END AS profession",
            "TIMESTAMP'2025-07-02 00:10:01' AS upd_ts",
        )

    # -- curated -----------------------------------------------------------

    def consumer(self) -> DataFrame:
        return curation.curate_consumers(self.consumer_raw(), CLOCK)

    def online(self) -> DataFrame:
        return curation.curate_online(self.online_raw(), CLOCK)

    def pos(self) -> DataFrame:
        return curation.curate_pos(self.pos_raw(), CLOCK)

    def mobile(self) -> DataFrame:
        return curation.curate_mobile_years(self.mobile_raw(), YEARS, CLOCK)

    def mobile_of(self, year: int) -> DataFrame:
        return curation.curate_mobile_year(self.mobile_raw(), year, CLOCK, clamp=year == 2023)


def _item_sql(i: int) -> str:
    return (
        f"{{'productId': CASE (o_orderkey + {i}) % 4 WHEN 0 THEN CAST(o_orderkey % 900 + {i} AS VARCHAR) "
        f"WHEN 1 THEN CAST(o_orderkey % 900 + {i} AS VARCHAR) || 'P' "
        f"WHEN 2 THEN 'A' || CAST(o_orderkey % 900 + {i} AS VARCHAR) || 'b' ELSE 'X' END, "
        f"'productCategory': CASE (o_orderkey + {i}) % 3 WHEN 0 THEN 'Furniture' WHEN 1 THEN 'Laptop' ELSE 'Mobile' END, "
        f"'productName': 'item ' || CAST(o_orderkey % 100 AS VARCHAR) || '-{i}', "
        f"'productPrice': CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) + {i} AS VARCHAR)}}"
    )


#: The same sources and curated tables as SQL; each oracle query selects from them.
SQL = f"""
WITH consumer_raw AS (
  SELECT c_custkey AS custid, split_part(c_name, '#', 1) AS firstname,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS lastname,
         nullif(21 + c_custkey % 55, 30) AS age, nullif(c_mktsegment, 'FURNITURE') AS profession
  FROM customer
  UNION ALL
  SELECT c_custkey, split_part(c_name, '#', 1),
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END,
         nullif(21 + (c_custkey * 7) % 55, 30), c_mktsegment
  FROM customer
), pos_raw AS (
  SELECT o_orderkey AS txnno,
         strftime(DATE '2021-01-01' + CAST(o_orderkey % 1000 AS INTEGER), '%m-%d-%Y') AS txndt,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS custno,
         CAST(floor(o_totalprice / 1000) AS DOUBLE) AS amt,
         CASE o_orderkey % 4 WHEN 0 THEN 'Outdoor Recreation' WHEN 1 THEN 'Team Sports'
           WHEN 2 THEN 'outdoor-play & Garden' ELSE o_orderpriority END AS category,
         nullif('Product ' || CAST(o_orderkey % 40 AS VARCHAR), 'Product 7') AS product,
         'City ' || CAST(n_regionkey AS VARCHAR) || '-' || CAST(n_nationkey AS VARCHAR) AS city,
         CASE n_nationkey % 5 WHEN 0 THEN 'Texas' WHEN 1 THEN 'Nevada' ELSE n_name END AS state,
         CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'credit' END AS spendby
  FROM orders JOIN nation ON o_custkey % 25 = n_nationkey
), mobile_raw AS (
  SELECT CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_id END AS txnno,
         CASE WHEN event_id % 3 = 0 THEN DATE '2021-01-01' + CAST(event_id % 1000 AS INTEGER)
           ELSE CAST(CAST(ts AS DATE) - to_years(CAST(event_id % 5 AS INTEGER)) AS DATE) END AS dt,
         strftime(ts, '%H:%M:%S') AS hour,
         CAST(event_id * 7 % 3600 AS DOUBLE) / 10 - 180 AS long,
         CAST(event_id * 3 % 1800 AS DOUBLE) / 10 - 90 AS lat,
         CASE event_id % 3 WHEN 0 THEN 'wifi' WHEN 1 THEN '4g' END AS net,
         CASE WHEN user_id % 10 <> 0 THEN 'provider ' || CAST(user_id % 7 AS VARCHAR) END AS provider,
         CASE event_type WHEN 'view' THEN 'STILL' WHEN 'error' THEN NULL ELSE upper(event_type) END AS activity,
         10000 + user_id AS postal_code, 'town ' || CAST(user_id % 20 AS VARCHAR) AS town_name
  FROM events
), online_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS orderId, o_orderstatus AS storeLocation, CAST(o_custkey AS VARCHAR) AS customerId,
         list_slice([{_item_sql(1)}, {_item_sql(2)}, {_item_sql(3)}], 1, CAST(o_orderkey % 4 AS BIGINT)) AS products
  FROM orders
), items AS (
  SELECT orderId, storeLocation, customerId, unnest(products) AS p FROM online_raw
), delta1 AS (
  SELECT c_custkey AS custno, split_part(c_name, '#', 1) || ',' || split_part(c_name, '#', 2) AS name,
         21 + c_custkey % 55 AS age, coalesce(nullif(c_mktsegment, 'FURNITURE'), 'na') AS profession,
         '{DAY1}' AS datadt, '2024-08-01 00:00:01' AS upd_ts
  FROM customer
), delta2 AS (
  SELECT CASE c_mktsegment WHEN 'BUILDING' THEN c_custkey ELSE c_custkey + 1000000000 END AS custno,
         split_part(c_name, '#', 1) || ',' || split_part(c_name, '#', 2) AS name, 22 + c_custkey % 55 AS age,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Editor' ELSE 'na' END AS profession,
         '{DAY2}' AS datadt, '2025-07-02 00:10:01' AS upd_ts
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
), consumer AS (
  SELECT custid AS custno, firstname || ' ' || lastname AS fullname, age, 2023 - age AS yearofbirth,
         coalesce(profession, 'not provided') AS profession
  FROM (SELECT *, row_number() OVER (PARTITION BY custid ORDER BY age DESC NULLS LAST, firstname DESC NULLS LAST,
                                     lastname DESC NULLS LAST, profession DESC NULLS LAST) AS rnk FROM consumer_raw) d
  WHERE rnk = 1
), online AS (
  SELECT CAST(customerId AS BIGINT) AS customerid, p.productName AS productname, p.productCategory AS productcategory,
         CAST(p.productPrice AS BIGINT) AS productprice,
         TRY_CAST(regexp_replace(p.productId, '[^0-9]', '', 'g') AS BIGINT) AS productidint,
         coalesce(nullif(regexp_replace(lower(p.productId), '[^a-z]', '', 'g'), ''), 'na') AS prodidstr
  FROM items
), pos AS (
  SELECT txnno, CAST(strptime(txndt, '%m-%d-%Y') AS DATE) AS txndt, custno, amt AS amount, category,
         coalesce(product, 'NA') AS product, city, state, spendby
  FROM pos_raw
), mobile_dated AS (
  SELECT *, CASE WHEN year(dt) IN (2021, 2022) THEN dt WHEN dt > DATE '2023-06-30' THEN DATE '2023-06-30' ELSE dt END AS day
  FROM mobile_raw
), mobile AS (
  SELECT txnno, day AS dt, CAST(day AS VARCHAR) || ' ' || hour AS ts, long AS lon, lat, net, provider, activity,
         postal_code, town_name
  FROM mobile_dated WHERE day >= DATE '2021-01-01' AND day < DATE '2024-01-01'
), pos_mob AS (
  SELECT m.txnno AS mob_txnno, p.txnno AS pos_txnno,
         CASE WHEN m.dt = p.txndt THEN 'Same Day Trans' ELSE 'Multi Day Trans' END AS trans_day,
         coalesce(m.dt, p.txndt) AS txndt,
         CASE WHEN m.txnno IS NULL THEN 'POS' WHEN p.txnno IS NULL THEN 'MOB' ELSE 'POS_MOB' END AS trans_type,
         m.net, p.amount, m.lon, m.lat, m.provider,
         CASE WHEN m.activity = 'STILL' THEN 'In Store Pickup' ELSE m.activity END AS activity,
         p.spendby, p.city, p.state, p.product, p.category, p.custno
  FROM mobile m FULL JOIN pos p ON m.txnno = p.txnno
), cust_online AS (
  SELECT c.*, o.productname, o.productcategory, o.productprice, o.productidint, o.prodidstr,
         CASE WHEN o.customerid IS NOT NULL THEN 'online' END AS online_trans_type
  FROM consumer c LEFT JOIN online o ON c.custno = o.customerid
)
"""
