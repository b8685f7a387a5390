"""Column names and types of the source files."""

CONSUMER_NAMES = ("custid", "firstname", "lastname", "age", "profession")
CONSUMER = "custid BIGINT, firstname STRING, lastname STRING, age BIGINT, profession STRING"
CONSUMER_SHORT = "id INT, custfname STRING, custlname STRING, custage SMALLINT, custprofession STRING"
POS = (
    "txnno DECIMAL(38,9), txndt STRING, custno BIGINT, amt DOUBLE, category STRING, "
    "product STRING, city STRING, state STRING, spendby STRING"
)
POS_TEXT = (
    "txnno INT, txndate STRING, custno INT, amount DOUBLE, category STRING, "
    "product STRING, city STRING, state STRING, spendby STRING"
)
ONLINE = (
    "orderId STRING, storeLocation STRING, customerId STRING, products ARRAY<STRUCT<"
    "productId: STRING, productCategory: STRING, productName: STRING, productPrice: STRING>>"
)
MOBILE = (
    "txnno DECIMAL(38,9), dt DATE, hour STRING, long DOUBLE, lat DOUBLE, net STRING, "
    "provider STRING, activity STRING, postal_code BIGINT, town_name STRING"
)
DELTA = "custno BIGINT, firstname STRING, lastname STRING, age BIGINT, profession STRING, upd_ts TIMESTAMP"
