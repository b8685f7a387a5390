"""All four layers, end to end, on small files of our own."""

from datetime import date

import pytest

from stratamart.clock import RunClock
from stratamart.plans import curation, discovery, layers, outbound
from stratamart.session import new_database
from stratamart.sinks import tables
from stratamart.sources import files as src
from stratamart.sources.schemas import ONLINE
from tests.conftest import rows

CONSUMERS = """custid,firstname,lastname,age,profession
11,Ines,Okafor,47,Therapist
11,Ines,Okafor,47,Therapist
11,Ines,Okafor,46,Nurse
12,Tomas,Lindqvist,26,
13,Petra,,41,Carpenter
14,No,Age,,Cook
"""
POS = """1,06-29-2023,11,50.0,Outdoor Recreation,Tent,Reno,Nevada,credit
2,06-30-2023,11,150.0,Outdoor Recreation,,Reno,Nevada,cash
3,01-15-2022,12,99.5,Games,Dice,Salem,Oregon,cash
9,01-15-2022,99,10.0,Games,Dice,Salem,Oregon,cash
"""
ONLINE_ROWS = """{"orderId":"1","storeLocation":"Oslo","customerId":"11","products":[{"productId":"7081","productCategory":"Garden","productName":"Rake","productPrice":"23"},{"productId":"5Q","productCategory":"Furniture","productName":"Bench","productPrice":"310"}]}
{"orderId":"2","storeLocation":"Oslo","customerId":"13","products":[{"productId":"K","productCategory":"Furniture","productName":"Stool","productPrice":"75"}]}
{"orderId":"3","storeLocation":"Oslo","customerId":"14","products":[]}
"""
MOBILE = """txnno,dt,hour,long,lat,net,provider,activity,postal_code,town_name
1,2023-06-29,10:30:00,10.5,59.9,wifi,Tele,STILL,123,Oslo
2,2026-01-01,11:00:00,10.5,59.9,,Tele,WALK,123,Oslo
3,2022-01-16,12:00:00,10.5,59.9,lte,,RUN,124,Bergen
50,2021-05-05,13:00:00,10.5,59.9,lte,Tele,RUN,124,Bergen
60,2019-05-05,13:00:00,10.5,59.9,lte,Tele,RUN,124,Bergen
"""


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    paths = {}
    for name, text in (("consumers", CONSUMERS), ("pos", POS), ("online", ONLINE_ROWS), ("mobile", MOBILE)):
        (root / name).write_text(text)
        paths[name] = str(root / name)
    dbs = layers.Layers(*(new_database(spark, n) for n in ("raw", "cur", "dis")))
    clock = RunClock.at("2023-06-30T08:04:11")
    out = layers.run_all(spark, layers.SourceFiles(**paths), clock, str(root / "out"), dbs)
    yield dbs, clock, out
    for name in (dbs.raw, dbs.curated, dbs.discovery):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_consumers(spark, world):
    dbs, _, _ = world
    got = rows(spark.table(f"{dbs.curated}.consumer_full_load").select("custno", "fullname", "age", "yearofbirth", "profession"))
    assert got == [
        (11, "Ines Okafor", 47, 1976, "Therapist"), (12, "Tomas Lindqvist", 26, 1997, "not provided"),
        (13, None, 41, 1982, "Carpenter"), (14, "No Age", None, None, "Cook"),
    ]


def test_online(spark, world):
    dbs, _, _ = world
    items = spark.table(f"{dbs.curated}.trans_online_part")
    assert rows(items.select("customerid", "productprice", "productidint", "prodidstr")) == [
        (11, 23, 7081, "na"), (11, 310, 5, "q"), (13, 75, None, "k"),
    ]
    assert curation.duplicate_keys(items, "transsk").count() == 0
    assert spark.table(f"{dbs.curated}.trans_online_part_furniture").count() == 2


def test_pos_and_mobile(spark, world):
    dbs, _, _ = world
    pos = spark.table(f"{dbs.curated}.trans_pos_part_cluster")
    assert {(int(r.txnno), r.txndt, r.product) for r in pos.collect()} == {
        (1, date(2023, 6, 29), "Tent"), (2, date(2023, 6, 30), "NA"), (3, date(2022, 1, 15), "Dice"), (9, date(2022, 1, 15), "Dice"),
    }
    m23 = spark.table(f"{dbs.curated}.trans_mobile_autopart_2023")
    assert {(int(r.txnno), r.dt, str(r.ts)) for r in m23.collect()} == {
        (1, date(2023, 6, 29), "2023-06-29 10:30:00"), (2, date(2023, 6, 30), "2023-06-30 11:00:00"),
    }
    assert [spark.table(f"{dbs.curated}.trans_mobile_autopart_{y}").count() for y in (2021, 2022)] == [1, 1]


def test_wide_fact(spark, world):
    dbs, _, _ = world
    wide = spark.table(f"{dbs.discovery}.consumer_trans_pos_mob_online")
    assert len(wide.columns) == 20
    # customer 11: 2 online x 2 POS; 12: 1 POS; 13: 1 online; 14: alone
    assert {r.custno: r["count"] for r in wide.groupBy("custno").count().collect()} == {11: 4, 12: 1, 13: 1, 14: 1}
    by = {(r.custno, int(r.txnno) if r.custno != 13 else None): r for r in wide.filter("custno in (12, 13)").collect()}
    twelve, thirteen = by[(12, 3)], by[(13, None)]
    assert (twelve.trans_day, twelve.trans_type, twelve.provider, twelve.activity) == ("Multi Day Trans", "POS_MOB", "na", "RUN")
    assert twelve.online_pos_amount == 99.5 and twelve.online_pos_category == "Games"
    assert (thirteen.trans_day, thirteen.trans_type, thirteen.city) == (None, "online", "unknown")
    assert thirteen.online_pos_amount == 75.0 and thirteen.txndt == date(2023, 6, 30)
    eleven = wide.filter("custno = 11").collect()
    assert {r.trans_type for r in eleven} == {"online"} and {r.trans_day for r in eleven} == {"Same Day Trans"}
    assert "In Store Pickup" in {r.activity for r in eleven}
    alone = wide.filter("custno = 14").first()
    assert alone.txnno is None and alone.online_pos_amount == 0.0 and alone.trans_type is None


def test_kpi(spark, world):
    dbs, _, _ = world
    kpi = spark.table(f"{dbs.discovery}.trans_aggr")
    assert rows(kpi) == [
        ("Nevada", "Reno", "Outdoor Recreation", "NA", 150.0, 150.0, 150.0, 1, 1, 0, 1),
        ("Nevada", "Reno", "Outdoor Recreation", "Tent", 50.0, 50.0, 50.0, 1, 1, 1, 0),
    ]


def test_kpi_counts_repeated_rows_as_the_join_does(spark, world):
    dbs, _, _ = world
    cur = dbs.curated
    consumers, pos = spark.table(f"{cur}.consumer_full_load"), spark.table(f"{cur}.trans_pos_part_cluster")
    mobile = spark.table(f"{cur}.trans_mobile_autopart_2023")
    mobile2, cust2 = mobile.union(mobile).union(mobile.filter("txnno = 1")), consumers.union(consumers)
    joined = discovery.transactions_with_mobile(cust2, pos, mobile2)
    assert joined.count() == 2 * 5
    plain = joined.groupBy("state", "city", "category", "product").agg({"amount": "sum", "*": "count"})
    got = discovery.kpi_by_place(cust2, pos, mobile2)
    assert {(r["product"], r["sum(amount)"], r["count(1)"]) for r in plain.collect()} == {
        (r["product"], r.sum_amt, r.states_cnt) for r in got.collect()
    }


def test_export(spark, world):
    _, _, out = world
    back = spark.read.csv(out, header=True, inferSchema=True, ignoreTrailingWhiteSpace=False)
    assert back.count() == 4 and back.columns[:3] == ["custno", "txnno", "outdoor_cat"]
    first = back.filter("txnno = 1").first()
    assert first.outdoor_cat is True and first.strpos_cat == 9 and len(first.rpad_cat) == 30


def test_rerun_is_idempotent_and_append_is_not(spark, world):
    dbs, clock, _ = world
    pos, mobile = f"{dbs.curated}.trans_pos_part_cluster", f"{dbs.curated}.trans_mobile_autopart_2023"
    layers.load_curated(spark, clock, dbs)
    assert (spark.table(pos).count(), spark.table(mobile).count()) == (4, 2)
    before = rows(spark.table(f"{dbs.discovery}.consumer_trans_pos_mob_online"))
    layers.load_discovery(spark, clock, dbs)
    assert rows(spark.table(f"{dbs.discovery}.consumer_trans_pos_mob_online")) == before
    later = RunClock.at("2023-07-01T00:00:00")
    layers.load_curated(spark, later, dbs)
    assert spark.table(pos).count() == 8
    layers.load_curated(spark, later, dbs, append=True)
    assert (spark.table(pos).count(), spark.table(mobile).count()) == (12, 2 + 2 + 2)
    assert outbound.transaction_report(spark.table(pos), clock).count() == 4


def test_positional_append_swaps_category_and_product(spark, world, db):
    dbs, clock, _ = world
    name = f"{db}.pos"
    tables.create_table(spark, name, layers.POS_COLUMNS, "loaddt")
    curated = curation.curate_pos(spark.table(f"{dbs.raw}.trans_pos"), clock)
    tables.append_rows(curation.pos_in_select_order(curated), name, by_position=True)
    assert "Tent" in {r.category for r in spark.table(name).collect()}


def test_unnest_drops_empty_orders(spark, tmp_path):
    (tmp_path / "o").write_text(ONLINE_ROWS + '{"orderId":"4","customerId":"1","products":null}\n')
    assert curation.unnest_products(src.read_json_lines(spark, str(tmp_path / "o"), ONLINE)).count() == 3
