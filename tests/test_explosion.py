"""Explosion against a recursive model, and case by case."""

import random
from datetime import datetime

import pytest

from lotflow.operators import explosion as X
from lotflow.plans.jobs import run_explosion
from lotflow.sources import tables

AS_OF = datetime(2020, 1, 2, 3, 4, 5)


class World:
    """Orders that put out one batch each (named after the order) and consume others."""

    def __init__(self):
        self.postings, self.items, self.batches, self.bom, self.orders = [], [], [], [], {}

    def order(self, name, plant="481A", output=10, state="B", level=1, made_by=None):
        self.orders[name] = (state, level)
        self.items.append(dict(aufnr=name, posnr="0001", pwerk=plant))
        self.batches.append(dict(matnr=f"M{name}", charg=name, aufnr=made_by or name))
        if output is not None:
            self._post(name, "0000", f"M{name}", name, output, "S", 0)
        return self

    def purchased(self, name, made_by=" "):
        self.batches.append(dict(matnr=f"M{name}", charg=name, aufnr=made_by))
        return self

    def consume(self, order, batch, qty, amount=0, sign="H"):
        self._post(order, "0001", f"M{batch}", batch, qty, sign, amount)
        return self

    def _post(self, order, rspos, matnr, charg, qty, sign, amount):
        n = f"{len(self.postings):04}"
        self.postings.append(
            dict(aufnr=order, rsnum=f"R{n}", rspos=rspos, mjahr="2020", mblnr=n, zeile="1", matnr=matnr, charg=charg,
                 werks="W", shkzg=sign, menge=qty, dmbtr=amount, budat="20200101")
        )

    def run(self, table, stored=None):
        orders = table("aufkx", *[dict(aufnr=k, xstat=s, bomlv=l) for k, (s, l) in self.orders.items()])
        return X.explode_orders(
            orders, table("aufm", *self.postings), table("mch1x", *self.batches), table("afpo", *self.items),
            table("ziebp023", *self.bom), stored, AS_OF,
        )


def states(result):
    return {r["aufnr"]: (r["xstat"], r["remark"]) for r in result.orders.collect()}


def test_three_levels_scale_bottom_up(table, rows):
    w = World().order("c", output=4).order("b", output=10).order("a").purchased("raw")
    w.consume("c", "raw", 3, 30).consume("b", "c", 2).consume("a", "b", 5, 7, "S")
    result = w.run(table)
    assert states(result) == {"a": ("X", " "), "b": ("X", " "), "c": ("X", " ")}
    got = rows(result.rows.where("matnr = 'Mraw'"), "aufnr", "wip", "menge", "qty", "dmbtr", "amt", "waufnr")
    # the reversed posting of a counts negative; menge and dmbtr are copied, qty and amt scaled
    assert got == [
        ("a", "S", 3.0, 3.0 * 0.5 * -0.5, 30, 30.0 * 0.5 * -0.5, "b"), ("b", "S", 3.0, 1.5, 30, 15.0, "c"),
        ("c", "M", 3.0, 3.0, 30, 30.0, " "),
    ]
    lineage = rows(result.rows.where("aufnr = 'a' and matnr = 'Mraw'"), "rsnum", "wrsnum", "orsnum", "mblnr", "wmblnr")
    assert lineage == [("R0005", "R0004", "R0003", "0005", "0004")]
    # markers: own ones W with nothing in them, inherited ones S
    assert rows(result.rows.where("matnr = 'Mc'"), "aufnr", "wip", "qty") == [("a", "S", -0.0), ("b", "W", 0.0)]
    assert result.rows.count() == result.rows.select("uuid").distinct().count() == 6


def test_what_counts_as_wip(table, rows):
    w = World().order("a").order("k482", "482A").order("k111", "111A").order("0014x").purchased("buy").purchased("mark", "ZIEBP023")
    for batch in ("k482", "k111", "0014x", "buy", "mark"):
        w.consume("a", batch, 1)
    w.consume("a", "unknown", 1)
    w.items.append(dict(aufnr="k482", posnr="0002", pwerk="111A"))
    split = X.split_consumption(
        table("aufm", *w.postings), table("mch1x", *w.batches), X.producers(table("aufm", *w.postings), table("afpo", *w.items))
    )
    assert rows(split, "charg", "is_wip", "waufnr") == [
        ("0014x", False, "0014x"), ("buy", False, " "), ("k111", False, "k111"), ("k482", True, "k482"),
        ("mark", True, "ZIEBP023"), ("unknown", False, " "),
    ]


def test_blocked_orders_block_their_consumers_and_have_no_rows(table):
    w = World().order("open", state=" ").order("b").order("a").order("free").purchased("raw")
    w.consume("b", "open", 1).consume("a", "b", 1).consume("free", "raw", 1)
    result = w.run(table)
    assert states(result) == {"open": (" ", " "), "b": ("E", "open"), "a": ("E", "b"), "free": ("X", " ")}
    assert {r["aufnr"] for r in result.rows.collect()} == {"free"}
    stamped = {r["aufnr"]: (r["xdate"], r["xtime"]) for r in result.orders.collect()}
    assert stamped["a"] == ("20200102", "030405") and stamped["open"] == (" ", " ")


def test_untracked_producer_self_consumption_and_missing_output(table):
    w = World().order("s").order("n").order("z").order("o1", output=None).order("o2", output=0)
    w.purchased("lost", "gone")
    w.items.append(dict(aufnr="gone", posnr="0001", pwerk="482A"))
    w.consume("s", "s", 1).consume("n", "lost", 1).consume("z", "o2", 1).consume("z", "o1", 1).consume("z", "o1", 2)
    assert states(w.run(table)) == {
        "s": ("E", "s"), "n": ("E", "gone"), "z": ("E", "no output:o1,o2"), "o1": ("X", " "), "o2": ("X", " "),
    }


def test_the_remark_lists_distinct_producers(table):
    w = World().order("p2", state=" ").order("p1", state=" ").order("a")
    w.consume("a", "p2", 1).consume("a", "p1", 1).consume("a", "p2", 1)
    assert states(w.run(table))["a"] == ("E", "p1,p2")


def test_marker_needs_no_producer_and_takes_the_contract_bom(table, rows):
    w = World().order("a").purchased("m1", "ZIEBP023").purchased("m2", "ZIEBP023")
    contract = dict(bnarea="2300", bukrs="L400", connr="E23070000001", matnr="Mm1", charg="m1")
    w.bom = [{**contract, "idnrk": "C1", "menge": "0.5"}, {**contract, "idnrk": "C2", "menge": 2}, {**contract, "idnrk": "C3", "menge": 9, "connr": "other"}]
    w.consume("a", "m1", 6).consume("a", "m2", 1)
    result = w.run(table)
    assert states(result)["a"] == ("X", " ")
    got = rows(result.rows, "wip", "matnr", "charg", "werks", "menge", "qty", "wfactor", "orsnum", "orspos")
    assert got == [
        ("S", "C1", " ", "481A", 3.0, 3.0, 6.0, "P023", "9999"), ("S", "C2", " ", "481A", 12.0, 12.0, 6.0, "P023", "9999"),
        ("W", "Mm1", "m1", "W", 0.0, 0.0, 6.0, "R0001", "0001"), ("W", "Mm2", "m2", "W", 0.0, 0.0, 1.0, "R0002", "0001"),
    ]


def test_orders_that_turn_cyclic_lose_their_rows_and_are_stamped(table, rows):
    w = World().order("a").order("z").purchased("raw")
    w.consume("a", "raw", 8).consume("z", "raw", 1)
    stored = w.run(table).rows
    w.orders["a"], w.orders["z"] = ("E", 0), ("X", 1)
    result = w.run(table, stored)
    assert rows(result.rows, "aufnr") == [("z",)]
    assert rows(result.orders, "aufnr", "xstat", "xdate")[0] == ("a", "E", AS_OF.strftime("%Y%m%d"))


def test_cyclic_orders_that_were_not_levelled_are_refused(table):
    w = World().order("a").order("b").purchased("raw")
    w.consume("a", "b", 1).consume("b", "a", 1).consume("a", "raw", 1)
    with pytest.raises(ValueError, match="cycle"):
        w.run(table)


def test_rows_of_orders_done_earlier_are_kept_and_inherited(spark, table, rows):
    w = World().order("old", state="X", output=2).purchased("raw")
    w.consume("old", "raw", 8)
    w.orders["old"] = ("B", 1)
    stored = w.run(table).rows
    w.orders["old"] = ("X", 1)
    w.order("a").consume("a", "old", 1)
    w.orders["failed"] = ("X", 1)
    result = w.run(table, stored)
    assert rows(result.rows.where("matnr = 'Mraw'"), "aufnr", "wip", "qty") == [("a", "S", 4.0), ("old", "M", 8.0)]
    # redone: the stored rows of an order that starts over are replaced, not added to
    w.orders["old"] = ("B", 2)
    assert w.run(table, stored).rows.count() == result.rows.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_a_recursive_model(table, seed):
    rnd = random.Random(seed)
    w, uses = World(), []
    w.purchased("r0").purchased("r1")
    for i in range(14):
        w.order(f"n{i:02}", plant=rnd.choice(["481A", "482A", "111A"]), output=rnd.choice([1, 3, 7, 10]), level=14 - i,
                state=rnd.choice(["B"] * 9 + [" "]))
        for _ in range(rnd.randrange(4)):
            batch = rnd.choice(["r0", "r1"] + [f"n{j:02}" for j in range(i)])
            use = (f"n{i:02}", batch, rnd.randrange(1, 20), rnd.randrange(100), rnd.choice("HS"))
            uses.append((*use, f"{len(w.postings):04}"))
            w.consume(*use)
    plant = {r["aufnr"]: r["pwerk"] for r in w.items}
    output = {p["aufnr"]: float(p["menge"]) for p in w.postings if p["rspos"] == "0000"}
    done, out = {}, {}
    for name, (state, _) in w.orders.items():  # producers come before consumers
        mine = [u for u in uses if u[0] == name]
        wip = [u for u in mine if plant.get(u[1]) in ("481A", "482A")]
        done[name] = state == "B" and all(done[u[1]] for u in wip)
        if not done[name]:
            continue
        out[name] = []
        for _, batch, qty, amount, sign, mblnr in mine:
            signed, money = (qty, amount) if sign == "H" else (-qty, -amount)
            if plant.get(batch) not in ("481A", "482A"):
                out[name].append((mblnr, "M", f"M{batch}", float(signed), float(money)))
                continue
            factor = float(signed) / output[batch]
            out[name].append((mblnr, "W", f"M{batch}", 0.0, 0.0))
            out[name] += [(mblnr, "S", m, q * factor, a * factor) for _, _, m, q, a in out[batch]]
    result = w.run(table)
    got = [(r["aufnr"], r["mblnr"], r["wip"], r["matnr"], r["qty"], r["amt"]) for r in result.rows.collect()]
    assert sorted(got) == sorted((n, *r) for n, rs in out.items() for r in rs)
    assert {n for n, s in states(result).items() if s[0] == "X"} == {n for n, ok in done.items() if ok}


def test_job_is_repeatable(spark, table, rows, tmp_path):
    w = World().order("c", output=4).order("b").order("a").purchased("raw")
    w.consume("c", "raw", 3).consume("b", "c", 2).consume("a", "b", 5).consume("a", "raw", 1)
    work = str(tmp_path)
    table("mch1x", *w.batches).write.parquet(f"{work}/mch1x")
    table("aufkx", dict(aufnr="a", xstat=" ")).write.parquet(f"{work}/aufkx")
    erp = {
        "aufm": table("aufm", *w.postings), "afpo": table("afpo", *w.items), "ziebp023": table("ziebp023"),
        "jest": table("jest", *[dict(objnr=f"OR{o}", stat="I0045", chgnr="1") for o in "abc"]),
    }
    orders = rows(run_explosion(spark, work, erp, AS_OF), "aufnr", "bomlv", "xstat")
    assert orders == [("a", 1, "X"), ("b", 2, "X"), ("c", 3, "X")]
    exploded = rows(tables.read_work(spark, work, "aufmx"))
    # everything is done: nothing is seeded, the stored rows stay as they are
    assert rows(run_explosion(spark, work, erp, AS_OF), "aufnr", "bomlv", "xstat") == orders
    assert rows(tables.read_work(spark, work, "aufmx")) == exploded
    # started over, the order and what it reaches come out the same
    tables.publish(spark, work, {"aufkx": table("aufkx", dict(aufnr="a", xstat="E"), dict(aufnr="c", xstat="X"))})
    assert rows(run_explosion(spark, work, erp, AS_OF), "aufnr", "bomlv", "xstat") == orders
    assert rows(tables.read_work(spark, work, "aufmx")) == exploded
