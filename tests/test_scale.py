"""What is written and moved grows with what changes, not with everything at every step."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotflow.bindings import queries
from lotflow.bindings.tables import view
from lotflow.operators import explosion, orders
from lotflow.operators.monthend import replace_period
from lotflow.session import materialize

ORDERS = 12


@pytest.fixture
def few(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_peeling_writes_every_order_a_few_times_only(spark, few, monkeypatch):
    links = [(f"{i:02d}", f"{j:02d}") for i in range(ORDERS) for j in (i + 1, i + 3) if j < ORDERS]
    written = []

    def counted(write):
        def call(df, *args, **more):
            out = write(df, *args, **more)
            written.append((out[0] if isinstance(out, tuple) else out).count())
            return out

        return call

    monkeypatch.setattr(orders, "stored", counted(orders.stored))
    monkeypatch.setattr(orders, "materialize", counted(orders.materialize))
    entries = spark.createDataFrame([("00", 0)], "aufnr string, w long")
    done, left, deep = orders._peeled(entries, spark.createDataFrame(links, "aufnr string, submo string"))
    assert {r.aufnr: r.w for r in done.collect()} == {f"{i:02d}": i for i in range(ORDERS)}
    assert left.isEmpty() and not deep
    assert sum(written) <= 3 * (ORDERS + len(links))


def test_peeling_adds_up_what_many_rounds_pass_on(spark, few, monkeypatch):
    monkeypatch.setattr(orders, "MERGE_AFTER", 2)
    # each order is needed by all before it; 6 and 7 lie on a cycle
    links = [(str(i), str(j)) for i in range(6) for j in range(i + 1, 7)] + [("6", "7"), ("7", "6"), ("7", "8")]
    entries = spark.createDataFrame([("0", 0), ("3", 5)], "aufnr string, w long")
    frame = spark.createDataFrame(links, "aufnr string, submo string")
    done, left, deep = orders._peeled(entries, frame)
    assert {r.aufnr: r.w for r in done.collect()} == {"0": 0, "1": 1, "2": 2, "3": 5, "4": 6, "5": 7}
    assert {r.aufnr: r.w for r in left.collect()} == {"6": 8, "7": None, "8": None} and not deep
    done, left, deep = orders._peeled(entries, frame, rounds=2)
    assert {r.aufnr for r in done.collect()} == {"0", "1"} and deep
    assert {r.aufnr: r.w for r in left.collect()}["3"] == 5


def test_walk_that_stops_returns_what_is_not_followed(spark, few):
    needed = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "y")], "aufnr string, waufnr string")
    held = spark.createDataFrame([("a",)], "aufnr string")
    found, rest = explosion._walked_consumers(held, needed, 2)
    assert {r.aufnr for r in found.collect()} == {"a", "b", "c"} and [r.aufnr for r in rest.collect()] == ["c"]
    found, rest = explosion._walked_consumers(held, needed)
    assert {r.aufnr for r in found.collect()} == {"a", "b", "c", "d"} and rest is None


@pytest.mark.parametrize("rounds", [0, 1, 32])
def test_totals_climb_and_go_on_by_coefficients(spark, few, rounds):
    wip = spark.createDataFrame([("c", "b", 2.0), ("b", "a", 3.0), ("c", "a", 0.5)], "aufnr string, waufnr string, wfactor double")
    own = spark.createDataFrame([("a", "M", "C", "ST", 1, 1, 10.0, 4.0)], "aufnr string, matnr string, charg string, meins string, menge int, dmbtr int, qty double, amt double")
    tracked = spark.createDataFrame([(o,) for o in "abc"], "aufnr string")
    got = explosion.material_totals(tracked, wip, own, rounds=rounds).collect()
    assert {r.aufnr: (r.qty, r.amt) for r in got} == {"a": (10.0, 4.0), "b": (30.0, 12.0), "c": (65.0, 26.0)}


def test_slices_go_to_the_lines(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(4).select(F.lit("1").alias("perio"), F.col("id").cast("string").alias("vtweg"))
        plan = replace_period(lines, lines.where("vtweg = '1'"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_shuffle_files_go_with_their_action(spark):
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_larger_input_is_read_as_it_is(spark, tmp_path, monkeypatch):
    at = "timestamp'1998-01-01'"
    for name, sql in (
        ("lineitem", f"select id l_orderkey, id l_partkey, id l_suppkey, 1 l_linenumber, 1d l_quantity, 1d l_extendedprice, 0d l_discount, 0d l_tax, 'N' l_returnflag, 'O' l_linestatus, {at} l_shipdate from range(0, 9, 1, 9)"),
    ):
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    t = queries.Tables(spark, str(tmp_path))
    monkeypatch.setattr(queries.Tables, "_small", False)
    assert all("lineitem.parquet" in f for f in t["mseg"].inputFiles()) and t["mseg"].count() == 9


def test_work_tables_are_written_small(spark, tmp_path):
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def edge_inputs(spark, table):
    aufm = table("aufm", *[dict(aufnr=a, matnr=m, charg="1") for a, m in (("a", "M1"), ("a", "M1"), ("a", "M2"), ("b", "M2"), ("c", "M1"), ("a", "M3"))])
    made = spark.createDataFrame([("M1", "1", "b"), ("M2", "1", "b"), ("M3", "1", " ")], "matnr string, charg string, aufnr string")
    jest = table("jest", *[dict(objnr=o, stat="I0045", chgnr="7") for o in ("ORa", "ORb", "XXc")])
    return aufm, jest, made


def test_edges_pass_two_shuffles_of_postings(spark, table, rows):
    edges = orders.order_edges(*edge_inputs(spark, table))
    assert rows(edges) == [("a", "I0045", "7", "b"), ("a", "I0045", "7", None), ("b", "I0045", "7", None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = orders.order_edges(*edge_inputs(spark, table))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 5  # two of the postings, one of the index, two of the states; postings and edges were made distinct by two more


def test_links_are_read_from_the_edges(spark, monkeypatch):
    written = []
    monkeypatch.setattr(orders, "materialize", lambda df, name, write=orders.materialize: written.append(name) or write(df, name))
    edges = spark.createDataFrame([("a", "I", "1", "b"), ("a", "I", "1", "b"), ("b", "I", "1", "c"), ("a", "I", "1", "c")], "aufnr string, stat string, chgnr string, submo string")
    levels, _ = orders.order_levels(spark.createDataFrame([("a",)], "aufnr string"), edges)
    assert {r.aufnr: r.bomlv for r in levels.collect()} == {"a": 1, "b": 2, "c": 3}
    assert "links" not in written


def test_totals_take_what_the_rows_hold(spark):
    n = Decimal
    split = spark.createDataFrame(
        [("a", "M", "C", "ST", n(2), n(4), " ", None, False), ("a", "W", "C", "ST", n(6), n(8), "ZIEBP023", None, True), ("a", "V", "C", "ST", n(6), n(8), "b", n(3), True)],
        "aufnr string, matnr string, charg string, meins string, menge decimal(13,3), dmbtr decimal(15,2), waufnr string, wmoqty decimal(23,3), is_wip boolean",
    )
    bom = spark.createDataFrame([("2300", "L400", "E23070000001", "W", "C", "P", n(5))], "bnarea string, bukrs string, connr string, matnr string, charg string, idnrk string, menge decimal(13,3)")
    wip = explosion.wip_postings(split)
    key = ["aufnr", "matnr", "charg", "meins", "qty", "amt"]
    wide = split.withColumns({c: F.lit("1") for c in ("rsnum", "rspos", *explosion.POSTING[1:])})
    want = explosion.bonded_bom_rows(explosion.wip_postings(wide), bom).unionByName(explosion.pure_material_rows(wide))
    assert sorted(explosion.own_use(split, wip, bom).select(key).collect()) == sorted(want.select(key).collect())


def test_open_demand_is_made_once(spark, monkeypatch):
    t = queries.Tables(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries.Tables, "_small", False)
    monkeypatch.setattr(queries, "_EXTRACTS", {})
    assert t.demand.inputFiles() == t.demand.inputFiles() and all("/demand-" in f for f in t.demand.inputFiles())
    assert any("lineitem" in f for f in t["zsd0012"].inputFiles())


def test_corrections_take_the_index_from_the_first_load(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries.receipts, "first_receipt", lambda *args, make=queries.receipts.first_receipt: made.append(1) or make(*args))
    queries.QUERIES["corrected_lots"](spark, "/root/testdata/sf0.001")
    assert not made


def test_what_is_large_in_memory_is_not_sent_to_all_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4m")
    try:
        orders_of = lambda n: materialize(spark.range(n).select(F.format_string("0010%08d", "id").alias("aufnr")), "orders")
        many, few = orders_of(200_000), orders_of(100)
        plans = [many.join(side, "aufnr", "left_semi")._jdf.queryExecution().executedPlan().toString() for side in (orders_of(200_000), few)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # some 20 MB as a table in memory, in files of a few hundred kB
    assert "BroadcastExchange" not in plans[0] and "BroadcastExchange" in plans[1]


def test_postings_meet_the_index_without_sorts_by_expressions(spark, tmp_path):
    line = "1L AS l_orderkey, 2L AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber, 4D AS l_quantity, 5D AS l_extendedprice, 0D AS l_discount"
    lines = spark.sql(f"SELECT {line}, timestamp_ntz'2020-01-02 00:00:00' AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    index = spark.createDataFrame([("0000000001", "01-00000002-000003-4-500-20200102"), ("0000000002", None)], "mblnr string, zeile string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        posted = view(spark, str(tmp_path), "aufm", mch1x=index)
        plan = posted._jdf.queryExecution().executedPlan().toString()
        assert [(r.rspos, r.bwart) for r in posted.collect()] == [("0000", "101")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "Sort " not in plan
