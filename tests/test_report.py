from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotflow.functions import scalars as S
from lotflow.operators import report as R
from lotflow.plans.jobs import run_stock

AS_OF = datetime(2020, 6, 15, 9, 0)


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "date,as_of,days,bucket",
    [
        ("20200606", datetime(2020, 6, 15, 11, 59, 59), 9, "015"),
        ("20200606", datetime(2020, 6, 15, 12, 0, 0), 10, "015"),
        ("20200616", datetime(2020, 6, 15, 9), -1, "007"),
        ("20200608", datetime(2020, 6, 15, 9), 7, "007"),
        ("20200607", datetime(2020, 6, 15, 9), 8, "015"),
        ("20190621", datetime(2020, 6, 15, 9), 360, "360"),
        ("20190620", datetime(2020, 6, 15, 9), 361, "360+"),
        (None, datetime(2020, 6, 15, 9), None, "360+"),
        (" ", datetime(2020, 6, 15, 9), None, "360+"),
    ],
)
def test_age_counts_the_time_of_day(spark, date, as_of, days, bucket):
    age = S.age_days(F.col("d"), as_of)
    assert one(spark, age, d=date) == days
    assert one(spark, S.age_bucket(age), d=date) == bucket


@pytest.mark.parametrize(
    "qty,value,valuated,rate,amount",
    [
        ("17.000", "32533.00", "17.000", "20.41500", "664161.20"),
        ("1.000", "10.00", "3.000", "1.00000", "3.33"),
        ("5.000", "10.00", "0.000", "1.00000", "0.00"),
        ("0.000", "10.00", "4.000", "6.20510", "0.00"),
    ],
)
def test_valuation_rounds_once(spark, qty, value, valuated, rate, amount):
    typed = [F.col(c).cast(t) for c, t in zip("qvlr", ("decimal(13,3)", "decimal(15,2)", "decimal(13,3)", "decimal(13,5)"))]
    assert one(spark, S.stock_amount(*typed), q=qty, v=value, l=valuated, r=rate) == Decimal(amount)


@pytest.mark.parametrize(
    "plant,location,group,order,label",
    [
        ("701A", "LD01", "X", "88", "1. LED"),
        ("481A", "X", "OL1", " ", "1. LED"),
        ("101A", "RM01", "OL1", "88", "1. LED"),
        ("101A", "X1", "OL1", "8800", S.CATEGORY_PURCHASING),
        ("701A", "X1", "OL1", "8700", S.CATEGORY_SALES),
        ("701A", "X1", "OL1", "4500", "4. MRP"),
        ("701A", "X1", "OL1", None, "4. MRP"),
    ],
)
def test_category(spark, plant, location, group, order, label):
    column = S.stock_category(F.col("w"), F.col("l"), F.col("g"), F.col("o"))
    assert one(spark, column, w=plant, l=location, g=group, o=order) == label


def test_text_helpers_keep_null_and_blank_apart(spark):
    none = dict(a=None, b=None, c=None)
    assert one(spark, S.document_ref(F.col("a"), F.col("b"), F.col("c")), **none) == ".."
    assert one(spark, S.purchase_ref(F.col("a"), F.col("b")), **none) == " "
    assert one(spark, S.purchase_ref(F.col("a"), F.col("b")), a=" ", b="1") == " "
    assert one(spark, S.purchase_ref(F.col("a"), F.col("b")), a="45", b="1") == "45.1"
    assert one(spark, S.person_name(F.col("a"), F.col("b")), a=None, b="x") == "x"
    assert one(spark, S.person_name(F.col("a"), F.col("b")), a=None, b=None) is None
    assert one(spark, S.material_type(F.col("a"), F.col("b")), a="ST", b="HALB") == "ZROH"
    assert one(spark, S.resolve_owner(F.col("a"), F.col("b"), F.col("c")), a=None, b="e", c="m") == "e"
    assert one(spark, S.present(F.col("a")), a=" ") is False


def test_partner_pivot_takes_the_least_name_per_role(table, rows):
    partners = table(
        "knvp", dict(kunnr="K", parvw="YA", pernr="1"), dict(kunnr="K", parvw="YB", pernr="2"),
        dict(kunnr="K", parvw="ZZ", pernr="1"), dict(kunnr="L", parvw="Y2", pernr="9"), dict(kunnr="O", parvw="YA", pernr="3"),
    )
    people = table(
        "pa0002", dict(pernr="1", nchmc="b", vnamc="x"), dict(pernr="1", nchmc="a", vnamc="z"),
        dict(pernr="2", nchmc=None, vnamc="q"), dict(pernr="3", nchmc=None, vnamc=None),
    )
    assert rows(R.partner_pivot(partners, people), "kunnr", "armgr", "srep2", "acc_sup_1", "acc_sup_2") == [
        ("K", "az", None, "q", None), ("O", None, None, None, None),
    ]


def test_rates(table, rows):
    plants = table("t001w", *[dict(werks=w, bwkey=w) for w in ("JP", "TW", "HK", "US", "NO")])
    areas = table("t001k", *[dict(bwkey=w, bukrs=w) for w in ("JP", "TW", "HK", "US")])
    companies = table("t001", *[dict(bukrs=w, waers=c) for w, c in (("JP", "JPY"), ("TW", "TWD"), ("HK", "HKD"), ("US", "USD"))])
    rates = table(
        "tcurrx", dict(kurst="C", fcurr="JPY", tcurr="RMB", ukurs="0.05"), dict(kurst="C", fcurr="USD", tcurr="RMB", ukurs="6.2"),
        dict(kurst="M", fcurr="HKD", tcurr="RMB", ukurs="9"), dict(kurst="C", fcurr="HKD", tcurr="USD", ukurs="9"),
    )
    # no rate: 1, or 100 for a currency quoted per hundred; the label is the report currency anyway
    assert rows(R.plant_currency_rate(plants, areas, companies, rates), "werks", "tcurr", "ukurs") == [
        ("HK", "RMB", Decimal("1.00000")), ("JP", "RMB", Decimal("5.00000")), ("TW", "RMB", Decimal("100.00000")),
        ("US", "RMB", Decimal("6.20000")),
    ]


def test_open_purchases_and_customer_parts_of_stocked_materials(table, rows):
    stock = table("mchbx", dict(matnr="M", werks="W"), dict(matnr="M", werks="W"))
    plan = table(
        "zsd0012", dict(matnr="M", werks="W", delkz="BE", mng01=1), dict(matnr="M", werks="W", delkz="LA", mng01=2),
        dict(matnr="M", werks="W", delkz="VC", mng01=9), dict(matnr="M", werks="V", delkz="BE", mng01=9),
    )
    assert rows(R.open_purchase_qty(plan, stock)) == [("M", "W", Decimal("3.000"))]
    parts = table(
        "knmt", dict(matnr="M", vtweg="PH", kunnr="1", erdat="20200101"), dict(matnr="M", vtweg="PH", kunnr="2", erdat="20200201"),
        dict(matnr="M", vtweg="PH", kunnr="3", erdat="20200201"), dict(matnr="M", vtweg="00", kunnr="9", erdat="20210101"),
        dict(matnr="X", vtweg="PH", kunnr="9", erdat="20210101"),
    )
    assert rows(R.latest_customer_part(parts, stock)) == [("M", "PH", "3")]


@pytest.fixture
def world(table):
    """Two lots of material M in one batch, one of N; material P has no text and drops out."""
    lot = dict(matnr="M", charg="C", werks="481A", lgort="X", budat="20200601", lbkum=10, salk3="100.00")
    erp = {
        "mchbx": table(
            "mchbx", {**lot, "uuid": "1", "bal_qty": 4}, {**lot, "uuid": "2", "bal_qty": 6, "werks": "701A"},
            {**lot, "uuid": "3", "bal_qty": 5, "matnr": "N"}, {**lot, "uuid": "4", "bal_qty": 5, "matnr": "P"},
        ),
        "mseg": table("mseg"),
        "zsd0012": table("zsd0012", dict(matnr="M", werks="481A", delkz="VC", plumi="-", kunnr="K", mng01=4)),
        "mara": table("mara", *[dict(matnr=m, meins="ST", matkl="G", mtart="HALB") for m in "MNP"]),
        "makt": table("makt", dict(matnr="M", spras="M", maktx="text"), dict(matnr="M", spras="E", maktx="no"), dict(matnr="N", spras="M", maktx="n")),
        "marc": table("marc", *[dict(matnr=m, werks=w, prctr="P", plifz=3, bstrf=7) for m in "MNP" for w in ("481A", "701A")]),
        "lfa1": table("lfa1", dict(lifnr="V", sortl="vendor")),
        "cepct": table("cepct", dict(spras="M", prctr="P", datbi="99991231", kokrs="3058", ktext="center"),
                       dict(spras="M", prctr="P", datbi="20001231", kokrs="3058", ktext="old")),
        "kna1": table("kna1", dict(kunnr="K1", sortl="s", name1="n")),
        "knvp": table("knvp", dict(kunnr="K1", parvw="Y2", pernr="1")),
        "pa0002": table("pa0002", dict(pernr="1", nchmc="a", vnamc="b")),
        "t001w": table("t001w", dict(werks="481A", bwkey="B"), dict(werks="701A", bwkey="B")),
        "t001k": table("t001k", dict(bwkey="B", bukrs="L")),
        "t001": table("t001", dict(bukrs="L", waers="USD")),
        "knmt": table("knmt", dict(matnr="M", vtweg="DT", kunnr="K1", erdat="20200101")),
        "marax": table("marax", dict(matnr="N", kunnr="K2")),
        "tcurrx": table("tcurrx", dict(kurst="C", fcurr="USD", tcurr="RMB", ukurs="6.5")),
        "knvvx": table("knvvx", dict(kunnr="K1", sr="AS", vkgrp="7")),
    }
    index = table("mch1x", dict(matnr="M", charg="C", mjahr="2020", mblnr="D", zeile="1", lifnr="V", ebeln="8700", ebelp="10"))
    return erp, index


def test_report_of_a_small_world(spark, world, table, rows, tmp_path):
    erp, index = world
    work = str(tmp_path)
    index.write.parquet(f"{work}/mch1x")
    report = run_stock(spark, work, erp, AS_OF)
    assert len(report.columns) == 48
    got = {(r["matnr"], r["werks"]): r for r in report.collect()}
    assert set(got) == {("M", "481A"), ("M", "701A"), ("N", "481A")}
    a = got["M", "481A"]
    assert (a["fl"], a["pl"], a["sr"], a["customer"], a["acc_rep"]) == ("DT", "center", "AS", "K1", "ab")
    assert (a["stk_qty"], a["alc_qty"], a["idle_qty"]) == (4, 4, 0)
    assert (a["stk_amt"], a["idle_amt"]) == (Decimal("260.00"), Decimal("0.00"))
    assert (a["mb51"], a["po"], a["sup_name"], a["stk_day"]) == ("2020.D.1", "8700.10", "vendor", 14)
    n = got["N", "481A"]
    # no receipt, no customer record: references are dots and a blank, the sales region is OT
    assert (n["mb51"], n["po"], n["customer"], n["cust_name"], n["sr"]) == ("..", " ", "K2", None, "OT")

    # idle: M in 701A and N; a second run lists nothing twice and its report keeps one row per lot
    idle = spark.read.parquet(f"{work}/stk_idle")
    assert rows(idle, "matnr", "charg", "werks", "reason") == [("M", "C", "701A", None), ("N", "C", "481A", None)]
    again = run_stock(spark, work, erp, AS_OF)
    assert again.count() == 3
    assert rows(spark.read.parquet(f"{work}/stk_idle"), "matnr", "werks") == [("M", "701A"), ("N", "481A")]
    assert {r["z_datecode"] for r in again.collect()} == {AS_OF}


def test_a_batch_listed_twice_fans_out_only_when_asked(world, table):
    erp, index = world
    stock = erp["mchbx"].withColumn("vtweg", F.lit("DT"))
    listed = dict(matnr="M", charg="C", moq_resp="q", created_at=AS_OF)
    idle = table("stk_idle", {**listed, "werks": "481A"}, {**listed, "werks": "701A", "created_at": datetime(2020, 1, 1)})
    once = R.stock_report(stock, index, idle, erp, AS_OF)
    assert once.count() == 3
    assert once.where("matnr = 'M'").select("z_datecode").distinct().collect()[0][0] == datetime(2020, 1, 1)
    assert R.stock_report(stock, index, idle, erp, AS_OF, faithful=True).count() == 5


def test_new_idle_rows_list_each_plant_and_skip_listed_batches(world, table, rows):
    erp, index = world
    stock = erp["mchbx"].withColumn("vtweg", F.lit("DT"))
    idle = table("stk_idle", dict(matnr="N", charg="C"))
    report = R.stock_report(stock, index, idle, erp, AS_OF)
    assert rows(R.new_idle_rows(report, idle), "matnr", "werks") == [("M", "481A"), ("M", "701A")]
