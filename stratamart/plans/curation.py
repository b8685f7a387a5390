"""Raw to curated: cleansing, defaults, enrichment, load stamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.clock import RunClock
from stratamart.functions import dates, geo, keys, text
from stratamart.functions.dates import clamps_into_year, in_year
from stratamart.operators.dedup import keep_highest
from stratamart.operators.predicates import older_than


def curate_consumers(raw: DataFrame, clock: RunClock, key: str = "custid") -> DataFrame:
    """One row per consumer (highest age), full name, year of birth, profession default."""
    best = keep_highest(raw.select(key, "firstname", "lastname", "age", "profession"), key, "age")
    return best.select(
        F.col(key).alias("custno"),
        text.full_name(F.col("firstname"), F.col("lastname")).alias("fullname"),
        "age",
        dates.year_of_birth(F.col("age"), clock).alias("yearofbirth"),
        text.default_if_null(F.col("profession"), text.MISSING_PROFESSION).alias("profession"),
        *[c.alias(n) for n, c in dates.load_stamps(clock).items()],
    )


def unnest_products(orders: DataFrame) -> DataFrame:
    """One row per ordered product; orders without products give no row."""
    return orders.select(
        "orderId", "storeLocation", "customerId", F.posexplode("products").alias("position", "product")
    )


def curate_online(orders: DataFrame, clock: RunClock, strict_ids: bool = False) -> DataFrame:
    """Unnested online items with a split product id, a surrogate key and load stamps.

    The key hashes order id and position, so a rerun or a retried task gives the
    same key; ``duplicate_keys`` finds collisions.
    """
    item = F.col("product")
    return unnest_products(orders).select(
        keys.surrogate_key(F.col("orderId"), F.col("position")).cast("decimal(38,9)").alias("transsk"),
        F.col("customerId").cast("bigint").alias("customerid"),
        item["productName"].alias("productname"),
        item["productCategory"].alias("productcategory"),
        item["productPrice"].cast("bigint").alias("productprice"),
        text.id_number(item["productId"], strict_ids).alias("productidint"),
        text.id_letters(item["productId"]).alias("prodidstr"),
        *[c.alias(n) for n, c in dates.load_stamps(clock).items()],
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def curate_pos(raw: DataFrame, clock: RunClock, strict_dates: bool = True) -> DataFrame:
    """POS rows with a parsed date, a product default and load stamps, in table order."""
    return raw.select(
        "txnno",
        dates.parse_pos_date(F.col("txndt"), strict_dates).alias("txndt"),
        "custno",
        F.col("amt").alias("amount"),
        "category",
        text.default_if_null(F.col("product"), text.MISSING_PRODUCT).alias("product"),
        "city", "state", "spendby",
        *[c.alias(n) for n, c in dates.load_stamps(clock).items()],
    )


def pos_in_select_order(curated: DataFrame) -> DataFrame:
    """The same rows with product before category.

    Appending this by position puts products into ``category`` and categories
    into ``product``; only for reproducing tables that were loaded that way.
    """
    return curated.select(
        "txnno", "txndt", "custno", "amount", "product", "category", "city", "state", "spendby", "loadts", "loaddt"
    )


def curate_mobile(raw: DataFrame, clock: RunClock, clamp: bool = False) -> DataFrame:
    """Mobile rows with date and time merged, a point and load stamps.

    ``clamp`` moves future dates to the run date before anything is derived from them.
    """
    day = F.col("dt").cast("date")
    if clamp:
        day = dates.clamp_future(day, clock)
    return raw.withColumn("dt", day).select(
        "txnno", "dt",
        dates.merge_date_time(F.col("dt"), F.col("hour")).alias("ts"),
        geo.geo_point(F.col("long"), F.col("lat")).alias("geo_coordinate"),
        "net", "provider", "activity",
        F.col("postal_code").cast("bigint").alias("postal_code"),
        "town_name",
        *[c.alias(n) for n, c in dates.load_stamps(clock).items()],
    )


def curate_mobile_year(raw: DataFrame, year: int, clock: RunClock, clamp: bool = False) -> DataFrame:
    """Rows of one year; with ``clamp``, after future dates moved to the run date."""
    day = F.col("dt").cast("date")
    rows = raw.filter(clamps_into_year(day, year, clock) if clamp else in_year(day, year))
    return curate_mobile(rows, clock, clamp)


def curate_mobile_of(raw: DataFrame, years: Sequence[int], clamped_year: int, clock: RunClock) -> DataFrame:
    """Rows of some years in one pass; only what belongs to ``clamped_year`` has future dates clamped."""
    years = sorted(years)
    if years == list(range(years[0], years[-1] + 1)) and clamped_year == years[-1]:
        return curate_mobile_years(raw, range(years[0], years[-1] + 1), clock)
    out = [curate_mobile_year(raw, year, clock, clamp=year == clamped_year) for year in years]
    return reduce(DataFrame.unionByName, out)


def curate_mobile_years(raw: DataFrame, years: range, clock: RunClock) -> DataFrame:
    """Rows of consecutive years in one pass, future dates clamped into the last of them.

    Equals the union of ``curate_mobile_year`` over the years, with the clamp for
    the last year alone.
    """
    day = F.col("dt").cast("date")
    last = years[-1]
    earlier = (day >= F.lit(date(years[0], 1, 1))) & (day < F.lit(date(last, 1, 1)))
    if clock.day.year == last:  # both conditions together are one lower bound
        return curate_mobile(raw.filter(day >= F.lit(date(years[0], 1, 1))), clock, clamp=True)
    return curate_mobile(raw.filter(earlier | clamps_into_year(day, last, clock)), clock)


def customers_over(raw: DataFrame, age: int = 30) -> DataFrame:
    """Customers above an age, named ``first,last``, unknown professions marked."""
    return older_than(raw, age).select(
        F.col("custid").alias("custno") if "custid" in raw.columns else F.col("custno"),
        text.full_name(F.col("firstname"), F.col("lastname"), ",").alias("name"),
        "age",
        text.default_if_null(F.col("profession"), text.MISSING_RAW_PROFESSION).alias("profession"),
    )


def curate_delta(raw: DataFrame, day: date | None = None) -> DataFrame:
    """Rows of a dated delta file in the change tables' shape.

    Without ``day`` the frame must carry a ``datadt`` column of its own.
    """
    return raw.select(
        "custno",
        text.full_name(F.col("firstname"), F.col("lastname"), ",").alias("name"),
        "age",
        text.default_if_null(F.col("profession"), text.MISSING_DELTA_PROFESSION).alias("profession"),
        F.col("datadt") if day is None else F.lit(day).alias("datadt"),
        "upd_ts",
    )
