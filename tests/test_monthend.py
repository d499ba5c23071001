import pytest
from pyspark.sql import functions as F

from lotflow.operators import monthend as M
from lotflow.plans.jobs import run_month_end


@pytest.fixture
def erp(table):
    line = dict(paledger="01", vrgar="F", vtweg="DT", perio="2020001", artnr="M", vvr10=5)
    orders = ("A", "B", "C")
    return {
        "ce13058": table(
            "ce13058", {**line, "rbeln": "1", "rposn": "1", "belnr": "1"}, {**line, "rbeln": "1", "rposn": "2", "belnr": "2"},
            {**line, "rbeln": "2", "rposn": "1", "belnr": "3", "perio": "2020002"},
            {**line, "rbeln": "1", "rposn": "1", "belnr": "4", "versi": "1"},
            {**line, "rbeln": "1", "rposn": "1", "belnr": "5", "vrgar": "A"},
        ),
        "vbrp": table(
            "vbrp", dict(vbeln="1", posnr="1", charg="CA", shkzg="X", fkimg=3), dict(vbeln="1", posnr="2", charg="CB", fkimg=4),
            dict(vbeln="2", posnr="1", charg="NONE", fkimg=1),
        ),
        "aufk": table("aufk", *[dict(aufnr=o, objnr=f"OR{o}") for o in orders]),
        "jest": table(
            "jest", dict(objnr="ORA", stat="I0045", chgnr="1"), dict(objnr="ORA", stat="I0046", chgnr="2"),
            dict(objnr="ORB", stat="I0046", inact="X"),
        ),
    }


@pytest.fixture
def index(table):
    return table("mch1x", dict(matnr="M", charg="CA", budat="20191201", aufnr="A"), dict(matnr="M", charg="CB", aufnr="B"))


def test_a_return_changes_the_quantity_not_the_revenue(erp, index, rows):
    got = M.billing_trace(erp["ce13058"], erp["vbrp"], index, "DT", "2020001")
    assert rows(got, "posnr", "fkimg", "vvr10", "mfgdt", "aufnr") == [("1", -3, 5, "20191201", "A"), ("2", 4, 5, " ", "B")]
    assert got.columns == M.TRACE_COLUMNS
    assert got.select("rid").distinct().count() == 2
    everything = M.billing_trace(erp["ce13058"], erp["vbrp"], index)
    assert rows(everything.where("perio = '2020002'"), "posnr", "mfgdt", "aufnr") == [("1", None, None)]


def test_release_guard_ignores_blank_and_unknown_dates(table):
    slice_ = dict(perio="2020001", vtweg="DT")
    assert not M.period_released(table("ke30x", {**slice_, "rldat": " "}, {**slice_, "rldat": None}), "DT", "2020001")
    assert M.period_released(table("ke30x", {**slice_, "rldat": "20200202"}), "DT", "2020001")
    assert not M.period_released(table("ke30x", {**slice_, "rldat": "20200202"}), "TX", "2020001")


def test_closing_status_is_the_higher_active_one(erp, rows):
    assert rows(M.closing_status(erp["jest"])) == [("ORA", "I0046", "2")]


def test_orders_behind_open_lines_are_queued_once(erp, table, rows):
    lines = table("ke30x", dict(aufnr="A", rldat=" "), dict(aufnr="A", rldat=" "), dict(aufnr="B", rldat=" "), dict(aufnr="C", rldat="20200101"))
    queued = M.enqueue_orders(erp["aufk"], erp["jest"], table("aufkx", dict(aufnr="X")), lines)
    assert rows(queued, "aufnr", "stat", "xstat", "remark") == [("A", "I0046", " ", "KE30"), ("B", None, " ", "KE30")]
    assert M.enqueue_orders(erp["aufk"], erp["jest"], table("aufkx", dict(aufnr="A"), dict(aufnr="B")), lines).isEmpty()


def test_job_replaces_open_slices_and_leaves_released_ones(spark, erp, index, table, rows, tmp_path):
    work = str(tmp_path)
    index.write.parquet(f"{work}/mch1x")
    table(
        "ke30x", dict(perio="2020001", vtweg="DT", rldat=" ", belnr="old"), dict(perio="2020002", vtweg="DT", rldat="20200301", belnr="old"),
        dict(perio="2020003", vtweg="TX", rldat=" ", belnr="old"),
    ).write.partitionBy("perio", "vtweg").parquet(f"{work}/ke30x")
    stored = lambda: rows(spark.read.schema("belnr string, perio string, vtweg string").parquet(f"{work}/ke30x"))

    assert rows(run_month_end(spark, work, erp, "DT", "2020001"), "aufnr") == [("A",), ("B",)]
    first = [("1", "2020001", "DT"), ("2", "2020001", "DT"), ("old", "2020002", "DT"), ("old", "2020003", "TX")]
    assert stored() == first
    # a rerun changes nothing, a released slice neither; an open slice without lines is emptied
    assert run_month_end(spark, work, erp, "DT", "2020001").isEmpty()
    assert run_month_end(spark, work, erp, "DT", "2020002").isEmpty()
    assert stored() == first
    run_month_end(spark, work, erp)
    assert stored() == first[:3]
    assert rows(spark.read.parquet(f"{work}/aufkx"), "aufnr") == [("A",), ("B",)]


def test_both_sides_of_the_items_are_gone_when_lines_meet_their_batch(spark, erp, index):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.billing_trace(erp["ce13058"], erp["vbrp"], index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(artnr" in plan and "hashpartitioning(rbeln" not in plan


def test_a_correction_shuffles_no_id_that_follows_from_its_line(spark, erp, index, table, rows):
    stored = M.billing_trace(erp["ce13058"], erp["vbrp"], index)
    given = F.when(F.col("posnr") == "2", "own").when(F.col("vbeln") == "1", F.col("rid"))
    stored = stored.withColumn("rid", given)
    want = rows(stored.where("perio = '2020001'"), "posnr", "rid")
    changed = table("mch1x", dict(matnr="M", charg="CA", budat="20180101", aufnr="C"))
    got = M.correct_trace(stored, changed)
    # a given id stays, also a missing one
    assert rows(got, "posnr", "rid") == want and ("2", "own") in want
    assert rows(M.correct_trace(stored.withColumn("rid", F.lit(None).cast("string")), changed), "rid") == [(None,), (None,)]
    assert {r.aufnr for r in got.collect()} == {"C", "B"} and got.columns == M.TRACE_COLUMNS
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter", 1)[1].splitlines()[1]
    assert "_rid#" in plan and " rid#" not in plan.split("AS _rid#")[1]
