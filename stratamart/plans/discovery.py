"""Curated to discovery: channels stitched into a wide fact, grouped KPIs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions.text import MISSING_PLACE, MISSING_TEXT, default_if_null
from stratamart.operators.joins import full_join, inner_join, left_join
from stratamart.operators.predicates import map_values, member_of
from stratamart.operators.skew import NO_HOT_KEYS, HotKeys, find_all_hot_keys, find_hot_keys
from stratamart.operators.summaries import multiplicity
from stratamart.session import pinned

# Labels of the wide fact and the states the KPI counts.
SAME_DAY, MULTI_DAY = "Same Day Trans", "Multi Day Trans"
POS_ONLY, MOBILE_ONLY, BOTH, ONLINE = "POS", "MOB", "POS_MOB", "online"
ACTIVITY_LABELS = {"STILL": "In Store Pickup"}
KPI_STATES = ("Nevada", "Texas", "Oregon")
HIGH_AMOUNT = 100


def stitch_pos_mobile(
    mobile: DataFrame, pos: DataFrame, hot_mobile: HotKeys | None = None, hot_pos: HotKeys | None = None,
) -> DataFrame:
    """POS and mobile rows of one transaction side by side, either alone when unmatched."""
    if hot_mobile is None:
        hot_mobile = find_hot_keys(mobile, "txnno")
    if hot_pos is None:
        hot_pos = find_hot_keys(pos, "txnno")
    mob = mobile.select(
        F.col("txnno").alias("mob_txnno"), F.col("dt").alias("mob_dt"), "net", "geo_coordinate", "provider",
        "activity", F.col("loadts").alias("mob_loadts"), F.col("loaddt").alias("mob_loaddt"),
    )
    till = pos.select(
        F.col("txnno").alias("pos_txnno"), F.col("txndt").alias("pos_txndt"), "custno", "amount", "spendby",
        "city", "state", "product", "category",
        F.col("loadts").alias("pos_loadts"), F.col("loaddt").alias("pos_loaddt"),
    )
    both = full_join(mob, till, "mob_txnno", "pos_txnno", hot_mobile, hot_pos)
    return both.select(
        "mob_txnno", "pos_txnno",
        F.when(F.col("mob_dt") == F.col("pos_txndt"), SAME_DAY).otherwise(MULTI_DAY).alias("trans_day"),
        F.coalesce("mob_dt", "pos_txndt").alias("txndt"),
        F.when(F.col("mob_txnno").isNull(), POS_ONLY)
        .when(F.col("pos_txnno").isNull(), MOBILE_ONLY)
        .otherwise(BOTH).alias("trans_type"),
        "net", "amount", "geo_coordinate", "provider",
        map_values(F.col("activity"), ACTIVITY_LABELS).alias("activity"),
        "spendby", "city", "state", "product", "category",
        "pos_loadts", "pos_loaddt", "mob_loadts", "mob_loaddt", "custno",
    )


def stitch_consumer_online(consumers: DataFrame, online: DataFrame, hot_online: HotKeys | None = None) -> DataFrame:
    """Every consumer with each online item, or alone; ``online`` marks the former."""
    if hot_online is None:
        hot_online = find_hot_keys(online, "customerid")
    cust = consumers.select(
        "custno", "fullname", "age", "yearofbirth", "profession",
        F.col("loadts").alias("consumer_loadts"), F.col("loaddt").alias("consumer_loaddt"),
    )
    items = online.select(
        "customerid", "transsk", "productname", "productcategory", "productprice", "productidint", "prodidstr",
        F.col("loadts").alias("online_trans_loadts"), F.col("loaddt").alias("online_trans_loaddt"),
    )
    return (
        left_join(cust, items, "custno", "customerid", hot_right=hot_online)
        .withColumn("online_trans_type", F.when(F.col("transsk").isNotNull(), ONLINE))
        .drop("customerid")
    )


def widen(
    cust_online: DataFrame, pos_mobile: DataFrame,
    hot_online: HotKeys = NO_HOT_KEYS, hot_pos: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """The 20-column fact: consumers with online items, left-joined to POS and mobile rows.

    A consumer with m online items and n POS rows gives max(1, m) * max(1, n) rows, so what needs
    one side only is computed before the join.
    Mobile-only rows have no consumer and match nobody, so they are not shuffled.
    """
    trans = pos_mobile.filter(F.col("custno").isNotNull()).select(
        F.col("custno").alias("trans_custno"), F.coalesce("mob_txnno", "pos_txnno").alias("trans_txnno"), "txndt", "trans_day",
        F.col("trans_type").alias("channel"), "net", "amount", "geo_coordinate", "provider", "activity", "spendby",
        "city", "state", "category", "product",
        F.coalesce("pos_loadts", "mob_loadts").alias("trans_loadts"), F.coalesce("pos_loaddt", "mob_loaddt").alias("trans_loaddt"),
    )
    cust = cust_online.select(
        "custno", "fullname", "age", "profession", "transsk", "productcategory", "online_trans_type", "online_trans_loaddt",
        F.col("productprice").cast("double").alias("price"), "consumer_loadts", "consumer_loaddt",
    )
    wide = left_join(cust, trans, "custno", "trans_custno", hot_left=hot_online, hot_right=hot_pos, fans_out=True)
    return wide.select(
        F.coalesce("trans_txnno", "transsk").alias("txnno"),
        F.coalesce("txndt", "online_trans_loaddt").alias("txndt"),
        "custno", "fullname", "age", "profession", "trans_day",
        F.coalesce("online_trans_type", "channel").alias("trans_type"),
        default_if_null(F.col("net"), MISSING_TEXT).alias("net"),
        F.coalesce(F.col("price"), F.col("amount"), F.lit(0.0)).alias("online_pos_amount"),
        "geo_coordinate",
        default_if_null(F.col("provider"), MISSING_TEXT).alias("provider"),
        default_if_null(F.col("activity"), MISSING_TEXT).alias("activity"),
        default_if_null(F.col("spendby"), MISSING_TEXT).alias("spendby"),
        default_if_null(F.col("city"), MISSING_PLACE).alias("city"),
        default_if_null(F.col("state"), MISSING_PLACE).alias("state"),
        F.coalesce("productcategory", "category").alias("online_pos_category"),
        "product",
        F.coalesce("trans_loadts", "consumer_loadts").alias("loadts"),
        F.coalesce("trans_loaddt", "consumer_loaddt").alias("loaddt"),
    )


def consumer_wide(
    consumers: DataFrame, online: DataFrame, mobile: DataFrame, pos: DataFrame,
    hot_online: HotKeys | None = None, hot_pos: dict[str, HotKeys] | None = None,
    before_join: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Wide fact from the four curated tables.

    ``before_join`` changes types of both stitched frames (say, dates to text), once for each of their
    rows instead of once for each of the many rows that the join makes of them.
    Heavy consumers are looked up in the base tables, never in a join's output. With
    any, the split join reads its inputs several times, so both stitched
    frames are written once before (until ``release_pinned``).
    """
    if hot_online is None:
        hot_online = find_hot_keys(online, "customerid")
    if hot_pos is None:
        hot_pos = find_all_hot_keys(pos, "txnno", "custno")
    cust_online = stitch_consumer_online(consumers, online, hot_online)
    pos_mobile = stitch_pos_mobile(mobile, pos, hot_pos=hot_pos["txnno"])
    if before_join:
        cust_online, pos_mobile = before_join(cust_online), before_join(pos_mobile)
    if hot_online or hot_pos["custno"]:
        cust_online, pos_mobile = pinned(cust_online, "consumer-online"), pinned(pos_mobile, "pos-mobile")
    return widen(cust_online, pos_mobile, hot_online, hot_pos["custno"])


def transactions_with_mobile(consumers: DataFrame, pos: DataFrame, mobile: DataFrame) -> DataFrame:
    """Rows of the three-way inner join: known consumers' POS rows that have a mobile row.

    Plain inner joins between two shuffles: AQE splits their heavy keys by itself.
    """
    cust = consumers.select(
        F.col("custno").alias("cust_custno"), "age", "yearofbirth", "profession",
    )
    mob = mobile.select(F.col("txnno").alias("mob_txnno"), "net", "provider", "activity")
    rows = inner_join(pos, mob, "txnno", "mob_txnno")
    rows = inner_join(rows, cust, "custno", "cust_custno")
    return rows.select(
        "txnno", "custno", "age", "yearofbirth", "profession", "amount", "category", "product",
        "city", "state", "spendby", "net", "provider", "activity", "txndt",
    )


def kpi_by_place(
    consumers: DataFrame, pos: DataFrame, mobile: DataFrame, states: Sequence[str] = KPI_STATES,
    threshold: float = HIGH_AMOUNT, exact_customers: bool = False, hot: dict[str, HotKeys] | None = None,
) -> DataFrame:
    """Amounts and counts per state, city, category and product.

    Defined on the three-way inner join of consumers, POS and mobile rows. Only
    POS columns are measured, so the other two sides shrink to rows-per-key
    before the joins: repeated transaction numbers do not fan out, and just one
    column of each travels. Sums and counts are weighted by what was collapsed.
    """
    cust = multiplicity(consumers, "custno", "_cust", "_cust_rows")
    mob = multiplicity(mobile, "txnno", "_txn", "_mob_rows")
    sales = pos.select("txnno", "custno", "amount", "state", "city", "category", "product")
    # The transaction join comes first: it removes the most rows.
    if hot is None:
        hot = find_all_hot_keys(pos, "txnno", "custno")
    joined = inner_join(sales, mob, "txnno", "_txn", hot["txnno"])
    joined = inner_join(joined, cust, "custno", "_cust", hot["custno"])
    weight = F.col("_cust_rows") * F.col("_mob_rows")

    def weighted(condition):
        return F.sum(F.when(condition, weight).otherwise(0))

    customers = F.count_distinct("custno") if exact_customers else F.approx_count_distinct("custno")
    return joined.groupBy("state", "city", "category", "product").agg(
        F.max("amount").alias("max_amt"),
        F.min("amount").alias("min_amt"),
        F.sum(F.col("amount") * weight).alias("sum_amt"),
        customers.alias("approx_cnt_cust"),
        weighted(member_of(F.col("state"), states)).alias("states_cnt"),
        weighted(F.col("amount") < threshold).alias("mid_amt_cnt"),
        weighted(F.col("amount") >= threshold).alias("high_amt_cnt"),
    )
