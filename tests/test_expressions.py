from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stratamart.clock import RunClock
from stratamart.functions import dates, geo, keys, text
from stratamart.operators import predicates
from stratamart.plans import curation


def one(spark, column, **values):
    types = {str: "string", int: "bigint", float: "double", date: "date"}
    ddl = ", ".join(f"{k} {types[type(v)] if v is not None else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given, number, letters", [
    ("4B2A", 42, "ba"), ("34P", 34, "p"), ("1234", 1234, "na"), ("ABC", None, "abc"), ("", None, "na"), (None, None, "na"),
])
def test_id_split(spark, given, number, letters):
    assert one(spark, text.id_number(F.col("v")), v=given) == number
    assert one(spark, text.id_letters(F.col("v")), v=given) == letters


def test_strict_id_without_digits_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, text.id_number(F.col("v"), strict=True), v="ABC")


def test_full_name_is_null_when_a_part_is_null(spark):
    assert one(spark, text.full_name(F.col("a"), F.col("b")), a="Sandy", b="Raynor") == "Sandy Raynor"
    assert one(spark, text.full_name(F.col("a"), F.col("b")), a="Sandy", b=None) is None


@pytest.mark.parametrize("category, found", [
    ("Outdoor Recreation", True), ("play-OUTDOOR", True), ("Outdoors", False), ("Games", False), (None, None),
])
def test_token_search(spark, category, found):
    assert one(spark, text.has_token(F.col("v"), "Outdoor"), v=category) is found


def test_text_views(spark):
    views = text.text_profile(F.col("v"), "Outdoor", "R", 5)
    assert one(spark, views["position"], v="Outdoor Recreation") == 9
    assert one(spark, views["position"], v="outdoor") == 0
    assert one(spark, views["padded"], v="ab") == "ab   "
    assert one(spark, views["padded"], v="abcdefg") == "abcde"
    assert one(spark, views["reversed"], v="abc") == "cba"
    assert one(spark, views["n_chars"], v="été") == 3


def test_dates(spark):
    assert one(spark, dates.parse_pos_date(F.col("v")), v="07-21-2025") == date(2025, 7, 21)
    assert one(spark, dates.parse_pos_date(F.col("v")), v="7-1-2025") == date(2025, 7, 1)
    assert one(spark, dates.parse_pos_date(F.col("v"), strict=False), v="2025/07/21") is None
    with pytest.raises(Exception, match="CANNOT_PARSE"):
        one(spark, dates.parse_pos_date(F.col("v")), v="2025/07/21")
    assert one(spark, dates.merge_date_time(F.col("v"), F.lit("10:30:00")), v=date(2025, 7, 21)) == datetime(2025, 7, 21, 10, 30)
    assert one(spark, dates.merge_date_time(F.col("v"), F.lit("23")), v=date(2025, 7, 21)) == datetime(2025, 7, 21, 23)
    assert one(spark, dates.uri_date(F.col("v")), v="gs://b/customers_20250701") == date(2025, 7, 1)
    assert dates.uri_day("/data/customers_20250702") == date(2025, 7, 2)
    with pytest.raises(ValueError):
        dates.uri_day("/data/customers_2025")


def test_clamp_and_birth_year(spark):
    clock = RunClock.at("2023-06-30T00:00:00")
    assert one(spark, dates.clamp_future(F.col("v"), clock), v=date(2026, 1, 1)) == date(2023, 6, 30)
    assert one(spark, dates.clamp_future(F.col("v"), clock), v=date(2023, 1, 1)) == date(2023, 1, 1)
    assert one(spark, dates.clamp_future(F.col("v").cast("date"), clock), v=None) is None
    assert one(spark, dates.year_of_birth(F.col("v"), clock), v=47) == 1976


def test_geo_point(spark):
    p = one(spark, geo.geo_point(F.col("lon"), F.col("lat")), lon=-74.006, lat=40.7128)
    assert (p.lon, p.lat) == (-74.006, 40.7128)
    assert one(spark, geo.geo_point(F.col("lon"), F.col("lat")), lon=190.0, lat=0.0).lon == -170.0
    assert one(spark, geo.geo_point(F.col("lon"), F.col("lat").cast("double")), lon=1.0, lat=None) is None
    with pytest.raises(Exception, match="latitude out of range"):
        one(spark, geo.geo_point(F.col("lon"), F.col("lat")), lon=0.0, lat=91.0)


def test_surrogate_key_is_stable_and_not_negative(spark):
    df = spark.range(20000).select(keys.surrogate_key(F.col("id").cast("string"), F.lit(0)).alias("k"))
    assert df.filter("k < 0").count() == 0
    assert df.distinct().count() == 20000
    a = one(spark, keys.surrogate_key(F.col("v"), F.lit(1)), v="7")
    assert a == one(spark, keys.surrogate_key(F.col("v"), F.lit(1)), v="7")
    assert one(spark, keys.surrogate_key(F.col("v")), v=None) != one(spark, keys.surrogate_key(F.col("v")), v="")


def test_case_mapping_and_scalar(spark):
    df = spark.createDataFrame([("STILL",), ("WALK",), (None,)], "a string")
    got = df.select(predicates.map_values(F.col("a"), {"STILL": "In Store Pickup"}).alias("a")).collect()
    assert [r.a for r in got] == ["In Store Pickup", "WALK", None]
    ages = spark.createDataFrame([(1, 20), (2, 70)], "id int, age int")
    assert [tuple(r) for r in predicates.with_scalar(ages, ages, F.max("age"), "m").orderBy("id").collect()] == [(1, 20, 70), (2, 70, 70)]


def test_run_clock_suffix():
    assert RunClock.at("2025-07-21T03:04:05.678").suffix() == "20250721030405"


@pytest.mark.parametrize("as_of", ["2022-06-30", "2023-06-30", "2024-06-30"])
def test_mobile_years_with_clamp(spark, as_of):
    """Pruned filters keep the rows that clamping first and filtering later keeps."""
    clock = RunClock.at(f"{as_of}T00:00:00")
    days = [None] + [date(y, m, 15) for y in range(2019, 2027) for m in (1, 6, 7, 12)]
    raw = spark.createDataFrame(
        [(i, d, "10:00:00", 1.0, 2.0, "n", "p", "a", 5, "t") for i, d in enumerate(days)],
        "txnno bigint, dt date, hour string, long double, lat double, net string, provider string, activity string, "
        "postal_code bigint, town_name string",
    )

    def kept(df):
        return sorted((r.txnno, r.dt) for r in df.collect())

    limit, expected = clock.day, {}
    for year in (2021, 2022, 2023):
        moved = [(i, min(d, limit) if year == 2023 else d) for i, d in enumerate(days) if d]
        expected[year] = sorted((i, d) for i, d in moved if d.year == year)
        assert kept(curation.curate_mobile_year(raw, year, clock, clamp=year == 2023)) == expected[year]
    assert kept(curation.curate_mobile_years(raw, range(2021, 2024), clock)) == sorted(sum(expected.values(), []))
