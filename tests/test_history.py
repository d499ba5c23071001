"""Daily snapshots as intervals, and allocation of what changed only."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotflow.operators import allocation as A
from lotflow.operators import history as H
from lotflow.plans import jobs
from lotflow.sources import tables

from test_allocation import DEMAND, LOT, PLACES, ROUTES, lot, need

ROW = "k string, v int"
INTERVAL = f"{ROW}, copies bigint, valid_from string, valid_to string"


def _merge(spark, days):
    running = ended = spark.createDataFrame([], INTERVAL)
    for day, rows in days:
        now, over = H.merge_day(running, ended, spark.createDataFrame(rows, ROW), day)
        kept = [tuple(r) for r in ended.where(F.col("valid_to") != day).collect()]
        ended = spark.createDataFrame(kept + [tuple(r) for r in over.collect()], INTERVAL)
        running = spark.createDataFrame([tuple(r) for r in now.collect()], INTERVAL)
    return running.unionByName(ended)


def test_every_day_is_restored_row_by_row_and_unchanged_rows_are_stored_once(spark, rows):
    rng = random.Random(4)
    days = [(f"2020010{d}", [(rng.choice("abc") if rng.random() < 0.8 else None, rng.randint(0, 2)) for _ in range(rng.randint(0, 9))] + [("same", 1)]) for d in range(1, 8)]
    held = _merge(spark, days)
    for day, expected in days:
        assert rows(H.as_of(held, day)) == sorted(expected, key=str)
    assert held.where("k = 'same'").count() == 1
    assert H.as_of(held, "20191231").isEmpty()
    assert rows(H.as_of(held, "20210101")) == sorted(days[-1][1], key=str)


def test_a_day_may_come_again_but_no_earlier_one(spark, rows):
    days = [("1", [("a", 1), ("b", 1)]), ("2", [("a", 2)]), ("2", [("a", 1), ("c", 1)])]
    held = _merge(spark, days)
    assert rows(H.as_of(held, "1")) == [("a", 1), ("b", 1)]
    assert rows(H.as_of(held, "2")) == [("a", 1), ("c", 1)]
    assert rows(held) == [("a", 1, 1, "1", None), ("b", 1, 1, "1", "2"), ("c", 1, 1, "2", None)]
    with pytest.raises(ValueError):
        _merge(spark, [("2", [("a", 1)]), ("1", [("a", 1)])])


def test_as_of_join_takes_the_row_of_the_day(spark, rows):
    held = _merge(spark, [("2", [("a", 1), ("b", 1)]), ("4", [("a", 2)])])
    events = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "3"), ("a", "9"), ("b", "3"), ("b", "4"), (None, "3")], "k string, valid_from string")
    got = H.as_of_join(events, held, ["k"], "valid_from")
    assert rows(got) == sorted([("a", "1", None), ("a", "2", 1), ("a", "3", 1), ("a", "9", 2), ("b", "3", 1), ("b", "4", None), (None, "3", None)], key=str)


def test_allocation_again_equals_a_full_run_and_folds_changed_materials_only(spark):
    rng = random.Random(6)
    plants = sorted(ROUTES)
    lots = [lot(f"L{i}", rng.choice(plants), rng.choice(PLACES), rng.randint(1, 9), f"2020010{rng.randint(1, 9)}", f"C{i % 3}", f"M{i % 12}") for i in range(150)]
    lines = [need(f"D{i}", rng.choice(plants), rng.choice(PLACES), rng.randint(1, 9), f"2020010{rng.randint(1, 9)}", f"M{i % 12}", f"N{i}") for i in range(150)]
    new_lots = [r[:6] + (r[6] + 5, r[7]) if r[0] == "M1" else r for r in lots if r[5] != "L2"] + [lot("L999", plants[0], matnr="M77")]
    new_lines = [r for r in lines if r[11] != "D3"]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    pairs = lambda x: sorted(map(tuple, x.pairs.collect()))
    first = A.waterfall_allocate(frame(lots, LOT), frame(lines, DEMAND))
    before = A.Before(frame(lots, LOT), frame(lines, DEMAND), first.pairs)
    changed = A.dirty_materials(before, frame(new_lots, LOT), frame(new_lines, DEMAND))
    assert sorted(r.matnr for r in changed.collect()) == ["M1", "M2", "M3", "M77"]
    full = pairs(A.waterfall_allocate(frame(new_lots, LOT), frame(new_lines, DEMAND)))
    assert pairs(A.reallocate(before, frame(new_lots, LOT), frame(new_lines, DEMAND))) == full != pairs(first)
    assert pairs(A.reallocate(before, frame(lots, LOT), frame(lines, DEMAND))) == pairs(first)


def test_jobs_allocate_since_a_day_and_keep_its_history(spark, table, rows, tmp_path):
    def erp(qty, mng):
        return {
            "mchbx": table("mchbx", dict(matnr="M", werks="112A", uuid="L1", bal_qty=qty), dict(matnr="N", werks="112A", uuid="L2", bal_qty=7)),
            "mseg": table("mseg"),
            "zsd0012": table(
                "zsd0012", dict(matnr="M", werks="112A", delkz="VC", plumi="-", kunnr="K", mng01=mng),
                dict(matnr="N", werks="112A", delkz="VC", plumi="-", kunnr="K", mng01=3),
            ),
        }

    once, again = str(tmp_path / "once"), str(tmp_path / "again")
    days = [datetime(2020, 1, d, 8) for d in (2, 3)]
    jobs.run_allocation(spark, again, erp(5, 2), days[0])
    jobs.run_history(spark, again, "20200102")
    full = jobs.run_allocation(spark, once, erp(5, 4), days[1])
    since = jobs.run_allocation(spark, again, erp(5, 4), days[1], since="20200102")
    assert [rows(x) for x in since] == [rows(x) for x in full]
    assert rows(since[0], "uuid", "bal_qty", "alc_qty") == [("L1", Decimal(1), Decimal(4)), ("L2", Decimal(4), Decimal(3))]
    for _ in range(2):  # a day may be merged again
        held = jobs.run_history(spark, again, "20200103")
        assert rows(held, "uuid", "bal_qty", "valid_from", "valid_to") == [
            ("L1", Decimal(1), "20200103", None), ("L1", Decimal(3), "20200102", "20200103"), ("L2", Decimal(4), "20200102", None),
        ]
    for day in ("20200102", "20200103"):
        stored = tables.current_snapshot(spark, f"{again}/stk_mchb", day).drop("created_at")
        assert rows(H.as_of(jobs.lot_history(spark, again), day).select(*stored.columns)) == rows(stored)
