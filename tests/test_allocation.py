"""Allocation against a plain loop over lots and demand, and case by case."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotflow.functions.ids import assign_row_id
from lotflow.operators import allocation as A
from lotflow.operators.routes import ROUTES, Routes, candidate_sources, sourcing_routes
from lotflow.plans.jobs import run_allocation

LOT = "matnr string, werks string, lgort string, charg string, budat string, uuid string, bal_qty decimal(13,3), alc_qty decimal(13,3)"
DEMAND = (
    "matnr string, werks string, lgort string, dat00 string, delnr string, del12 string, delps string, delet string, "
    "delkz string, kunnr string, mng01 decimal(13,3), uuid string, bal_qty decimal(13,3), alc_qty decimal(13,3)"
)
PLACES = ["RM01", "RM03", "RM03A", "RM04", "RM05", "PHTX", "PHDT", "X1", "X2"]


def lot(uuid, werks, lgort="X1", qty=10, budat="20200101", charg="C", matnr="M"):
    return (matnr, werks, lgort, charg, budat, uuid, Decimal(qty), Decimal(0))


def need(uuid, werks, lgort="X1", qty=10, dat00="20200101", matnr="M", delnr="N"):
    return (matnr, werks, lgort, dat00, delnr, " ", "1", "1", "VC", "K", Decimal(qty), uuid, Decimal(qty), Decimal(0))


def expected_pairs(lots, demand, routes=ROUTES):
    """Every line in turn takes what it can get: the meaning of the operator, one step at a time."""
    special = {s for text in routes.values() for s in text.split() if "." in s}
    stock = {}
    for m, w, l, c, b, u, q, _ in sorted(lots, key=lambda r: (r[4], r[3], r[2], r[5])):
        place = l if f"{w}.{l}" in special else "****"
        stock.setdefault((m, w, place), []).append([u, q])
    ordered = sorted(demand, key=lambda d: (d[3], d[4], d[5], d[6], d[7], d[8], d[2], d[9], d[10], d[11]))
    first = {}
    for i, d in enumerate(ordered):
        first.setdefault((d[0], d[1]), i)
    pairs = []
    for d in sorted(ordered, key=lambda d: first[d[0], d[1]]):
        open_qty = d[12]
        for source in routes.get(d[1], "").split():
            plant, _, place = source.partition(".")
            own = f"{source}.{d[2]}" in special
            for held in stock.get((d[0], plant, d[2] if own else place[:4] or "****"), []):
                taken = min(held[1], open_qty)
                if taken > 0:
                    held[1] -= taken
                    open_qty -= taken
                    pairs.append((held[0], d[11], taken))
    return sorted(pairs)


def allocate(spark, lots, demand, **options):
    result = A.waterfall_allocate(spark.createDataFrame(lots, LOT), spark.createDataFrame(demand, DEMAND), **options)
    return sorted(map(tuple, result.pairs.collect())), result


def random_case(seed, materials, n_lots, n_demand):
    rnd = random.Random(seed)
    plants = [*ROUTES, "999A"]
    lots = [
        lot(f"L{i:04}", rnd.choice(["101A"] * 6 + plants), rnd.choice(PLACES), Decimal(rnd.randrange(9000)) / 1000,
            f"2020010{rnd.randrange(1, 9)}", f"C{rnd.randrange(9)}", f"M{rnd.randrange(materials)}")
        for i in range(n_lots)
    ]
    demand = [
        need(f"D{i:04}", rnd.choice(["101A", "921A"] * 5 + plants), rnd.choice(PLACES), Decimal(rnd.randrange(9000)) / 1000,
             f"2020010{rnd.randrange(1, 9)}", f"M{rnd.randrange(materials)}", f"N{rnd.randrange(20)}")
        for i in range(n_demand)
    ]
    return lots, demand


@pytest.mark.parametrize(
    "seed,materials,n_lots,n_demand,hot", [(1, 20, 500, 500, None), (2, 2, 400, 400, 20), (3, 1, 300, 900, 40)]
)
def test_matches_the_loop(spark, seed, materials, n_lots, n_demand, hot):
    lots, demand = random_case(seed, materials, n_lots, n_demand)
    got, result = allocate(spark, lots, demand, min_hot_rows=hot)
    assert got == expected_pairs(lots, demand)
    assert result.unrouted.count() == sum(d[1] not in ROUTES for d in demand)


def test_invariants_hold(spark):
    lots, demand = random_case(4, 5, 300, 300)
    pairs, _ = allocate(spark, lots, demand)
    frame = spark.createDataFrame(pairs, "lot_id string, demand_id string, alc_qty decimal(13,3)")
    stock = A.lot_balances(spark.createDataFrame(lots, LOT), frame)
    left = A.demand_balances(spark.createDataFrame(demand, DEMAND), frame)
    start = {r[5]: r[6] for r in lots}
    assert all(r["bal_qty"] + r["alc_qty"] == start[r["uuid"]] and r["bal_qty"] >= 0 for r in stock.collect())
    assert all(r["bal_qty"] + r["alc_qty"] == r["mng01"] and r["bal_qty"] >= 0 for r in left.collect())
    assert "lgort" not in left.columns
    total = sum(q for _, _, q in pairs)
    assert all(q > 0 for _, _, q in pairs)
    assert stock.agg(F.sum("alc_qty")).first()[0] == left.agg(F.sum("alc_qty")).first()[0] == total


def test_result_does_not_depend_on_partitions(spark):
    lots, demand = random_case(5, 3, 200, 200)
    one = A.waterfall_allocate(
        spark.createDataFrame(lots, LOT).repartition(1), spark.createDataFrame(demand, DEMAND).repartition(1)
    )
    many = A.waterfall_allocate(
        spark.createDataFrame(lots, LOT).repartition(13), spark.createDataFrame(demand, DEMAND).repartition(7)
    )
    assert sorted(map(tuple, one.pairs.collect())) == sorted(map(tuple, many.pairs.collect()))


def test_one_lot_over_two_lines_and_one_line_over_two_lots(spark):
    lots = [lot("L1", "112A", qty=10), lot("L2", "112A", qty=10, budat="20200102")]
    demand = [need("D1", "112A", qty=4), need("D2", "112A", qty=11, dat00="20200102")]
    got, _ = allocate(spark, lots, demand)
    assert got == [("L1", "D1", 4), ("L1", "D2", 6), ("L2", "D2", 5)]


def test_the_first_seen_plant_is_served_whole_before_the_next(spark):
    lots = [lot("L1", "701A", qty=10)]
    demand = [
        need("A1", "701A", qty=2, dat00="20200101"),
        need("B1", "381A", qty=6, dat00="20200102"),
        need("A2", "701A", qty=9, dat00="20200103"),
    ]
    got, _ = allocate(spark, lots, demand)
    assert got == [("L1", "A1", 2), ("L1", "A2", 8)]


def test_own_location_replaces_the_bare_source(spark):
    lots = [lot("free", "101A", "X1"), lot("rm01", "101A", "RM01", qty=3)]
    got, _ = allocate(spark, lots, [need("D1", "101A", "RM01", qty=10)])
    assert got == [("rm01", "D1", 3)]


def test_a_special_location_is_reached_by_its_route_only(spark):
    lots = [lot("rm01", "101A", "RM01"), lot("free", "101A", "X1")]
    got, _ = allocate(spark, lots, [need("D1", "481A", qty=30)])
    assert got == [("rm01", "D1", 10)]


def test_the_long_location_code_of_the_route_reaches_nothing(spark):
    lots = [lot("rm03", "101A", "RM03"), lot("rm03a", "101A", "RM03A")]
    got, _ = allocate(spark, lots, [need("D1", "381A", qty=30)])
    assert got == []
    # the same stock is there for a line of the hub: RM03 in the common bucket, RM03A as own location
    got, _ = allocate(spark, lots, [need("D1", "101A", "X1", qty=30), need("D2", "101A", "RM03A", qty=30)])
    assert got == [("rm03", "D1", 10), ("rm03a", "D2", 10)]


def test_shared_source_before_own_locations(spark):
    # 921A serves its own stock first: how it is spread decides what each location still needs
    lots = [lot("own", "921A", qty=5), lot("rm01", "101A", "RM01", qty=3), lot("free", "101A", "X1", qty=4)]
    demand = [
        need("D1", "921A", "RM01", qty=4, dat00="20200101"),
        need("D2", "921A", "X1", qty=4, dat00="20200102"),
        need("D3", "921A", "RM01", qty=4, dat00="20200103"),
        need("D4", "101A", "X1", qty=9, dat00="20200104"),
    ]
    got, _ = allocate(spark, lots, demand)
    assert got == [("free", "D2", 3), ("free", "D4", 1), ("own", "D1", 4), ("own", "D2", 1), ("rm01", "D3", 3)]


def test_a_plant_without_route_stays_open(spark):
    got, result = allocate(spark, [lot("L1", "999A")], [need("D1", "999A")])
    assert got == []
    assert [(r["uuid"], r["reason"]) for r in result.unrouted.collect()] == [("D1", "no_route")]


def test_other_routes_and_routes_that_cannot_be_followed(spark):
    routes = {"A001": "B001.L001 A001", "B001": "A001 B001"}
    lots = [lot("a", "A001", qty=3), lot("b1", "B001", "L001", qty=2), lot("b", "B001", qty=9)]
    demand = [need("D1", "A001", qty=4), need("D2", "B001", "L001", qty=9, dat00="20200102")]
    got, _ = allocate(spark, lots, demand, routes=Routes(routes))
    assert got == expected_pairs(lots, demand, routes)
    with pytest.raises(ValueError):
        Routes({"A001": "B001 C001.L001 B001.L001"})


@pytest.mark.parametrize("hot", [None, 30])
def test_fifo_matches_the_one_route_case(spark, hot):
    lots, demand = random_case(6, 3, 200, 250)
    lots = [(*x[:1], "112A", "X1", *x[3:]) for x in lots]
    demand = [(d[0], "112A", "X1", *d[3:]) for d in demand]
    got = A.fifo_allocate(
        spark.createDataFrame(lots, LOT), spark.createDataFrame(demand, DEMAND), ["matnr"], A.LOT_ORDER, A.DEMAND_ORDER, hot
    )
    assert sorted(map(tuple, got.drop("matnr").collect())) == expected_pairs(lots, demand)


def test_channel_rules(table, rows):
    # (plant, location, plant of the first receipt) -> channel; the receipt plant wins over the location
    cases = {
        ("101A", "RM01", "111A"): "PH", ("101A", "L106", "481A"): "DT", ("101A", "L127", None): "DT",
        ("101A", "L106", None): "PH", ("101A", "X1", "701A"): "TX", ("101A", "X1", None): "TX",
        ("282A", "X1", None): "PH", ("282A", "X1", "481A"): "PH", ("482A", "X1", None): "DT", ("701A", "X1", "111A"): "TX",
    }
    lots, index, lines = [], [], []
    for i, (plant, place, made) in enumerate(cases):
        lots.append(dict(matnr="M", charg=f"C{i}", werks=plant, lgort=place, uuid=f"{i}"))
        if made:
            index.append(dict(matnr="M", charg=f"C{i}", mjahr="2020", mblnr="D", zeile=f"{i}"))
            lines.append(dict(mjahr="2020", mblnr="D", zeile=f"{i}", werks=made))
    got = A.stock_lots(table("mchbx", *lots), table("mch1x", *index), table("mseg", *lines))
    assert rows(got, "uuid", "vtweg") == [(f"{i}", v) for i, v in enumerate(cases.values())]


def test_demand_filters(table, rows):
    keep = dict(matnr="M", werks="101A", delkz="VC", plumi="-", kunnr="K", mng01=1)
    got = A.demand_lines(
        table(
            "zsd0012", keep, {**keep, "delkz": "U2"}, {**keep, "kunnr": "L700"}, {**keep, "mng01": 0}, {**keep, "plumi": "+"},
            {**keep, "kunnr": None}, {**keep, "kunnr": " "},
        )
    )
    # an unknown customer fails the exclusion test, a blank one passes
    assert rows(got, "kunnr") == [(" ",), ("K",)]
    assert got.select("uuid").distinct().count() == 2


def test_routes_are_ordered_and_cut_to_plant_and_location(spark, rows):
    got = sourcing_routes(spark)
    assert (got.count(), got.select("demand_plant").distinct().count()) == (33, 11)
    assert rows(got.where("demand_plant = '381A' and priority in (1, 3, 7)"), "priority", "supply_plant", "supply_location") == [
        (1, "381A", "****"), (3, "101A", "RM03"), (7, "101A", "PHTX"),
    ]


def test_candidates_keep_unrouted_lines(spark, rows):
    demand = spark.createDataFrame([need("D1", "482A"), need("D2", "999A"), need("D3", "921A", "RM04")], DEMAND)
    assert rows(candidate_sources(demand), "uuid", "priority", "supply_plant", "supply_location") == [
        ("D1", 1, "482A", "****"), ("D1", 2, "101A", "RM02"), ("D2", None, None, None), ("D3", 1, "921A", "****"),
        ("D3", 2, "101A", "RM04"), ("D3", 3, "481A", "****"), ("D3", 4, "701A", "****"), ("D3", 5, "381A", "****"),
    ]


def test_row_ids_are_stable_and_fill_blanks_only(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", " ", " "), ("a", "b", None)], "k string, l string, uuid string")
    first = [r["uuid"] for r in assign_row_id(df, ["k", "l"]).orderBy("l").collect()]
    assert "x" in first and len(set(first)) == 3
    assert first == [r["uuid"] for r in assign_row_id(df.repartition(3), ["k", "l"]).orderBy("l").collect()]


def test_row_ids_of_different_keys_differ(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("\\N", "c"), (None, "c"), ("-", "c"), ("1:a", ""), ("", "1:a")], "k string, l string")
    assert assign_row_id(df, ["k", "l"]).select("uuid").distinct().count() == 7


def test_equal_demand_lines_are_served_apart(spark, table, rows, tmp_path):
    line = dict(matnr="M", werks="112A", delkz="VC", plumi="-", kunnr="K", mng01=4)
    erp = {
        "mchbx": table("mchbx", dict(matnr="M", werks="112A", uuid="L1", bal_qty=10)),
        "mseg": table("mseg"),
        "zsd0012": table("zsd0012", line, line, dict(line, werks="999X")),
    }
    _, demand, _ = run_allocation(spark, str(tmp_path), erp, datetime(2020, 1, 2, 8))
    assert rows(demand, "werks", "bal_qty", "alc_qty") == [("112A", 0, 4), ("112A", 0, 4), ("999X", 4, 0)]
    assert demand.select("uuid").distinct().count() == 3
    assert [r.reason for r in spark.read.parquet(f"{tmp_path}/stk_open").collect()] == ["no_route"]


def test_job_stores_three_tables_per_day(spark, table, rows, tmp_path):
    erp = {
        "mchbx": table("mchbx", dict(matnr="M", werks="112A", uuid="L1", bal_qty=5)),
        "mseg": table("mseg"),
        "zsd0012": table("zsd0012", dict(matnr="M", werks="112A", delkz="VC", plumi="-", kunnr="K", mng01=2)),
    }
    day = datetime(2020, 1, 2, 8)
    lots, demand, pairs = run_allocation(spark, str(tmp_path), erp, day)
    assert rows(lots, "uuid", "bal_qty", "alc_qty") == [("L1", 3, 2)]
    assert rows(demand, "bal_qty", "alc_qty") == [(0, 2)]
    assert rows(pairs, "stk_mchb_id", "alc_qty") == [("L1", 2)]
    first = [rows(x) for x in (lots, demand, pairs)]
    assert [rows(x) for x in run_allocation(spark, str(tmp_path), erp, day)] == first
