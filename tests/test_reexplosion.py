"""Re-explosion of what changed against a full run, and totals by coefficients against the exploded rows."""

import random
from collections import defaultdict
from datetime import datetime

import pytest

from lotflow.operators import explosion as X

AS_OF, LATER = datetime(2020, 1, 1), datetime(2020, 2, 1)


def postings(seed, count=10):
    """Order i makes batch i; orders post batches of later ones, and purchased ones."""
    rnd = random.Random(seed)
    rows = []
    for i in range(count):
        order = f"0010{i:02}"
        rows.append(dict(aufnr=order, mblnr=f"O{i}", rspos="0000", shkzg="S", menge=rnd.randint(5, 20), mjahr="2020", zeile="1"))
        used = rnd.sample(range(i + 1, count), min(2, count - i - 1)) + [99]
        for z, b in enumerate(used):
            rows.append(dict(aufnr=order, mblnr=f"D{i}", zeile=str(z), rspos=f"000{z + 1}", rsnum="R", shkzg="H", menge=rnd.randint(1, 9),
                             dmbtr=rnd.randint(1, 90), matnr="M", charg=str(b), mjahr="2020", meins="PC"))
    return rows


@pytest.fixture
def sources(table):
    index = table("mch1x", *[dict(matnr="M", charg=str(i), aufnr=f"0010{i:02}") for i in range(10)])
    return index, table("afpo", *[dict(aufnr=f"0010{i:02}", posnr="1", pwerk="481A") for i in range(10)]), table("ziebp023")


def orders_of(table):
    return table("aufkx", *[dict(aufnr=f"0010{i:02}", xstat="B", bomlv=1) for i in range(10)])


def by_order(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.aufnr].append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_only_orders_above_a_change_are_exploded_again(spark, table, sources):
    rows = postings(4)
    before = table("aufm", *rows)
    first = X.explode_orders(orders_of(table), before, *sources, None, AS_OF)
    stored, orders = X.materialize(first.rows, "stored"), X.materialize(first.orders, "orders")
    # one consumed quantity and one output change, of orders in the middle; the last order posts one line more
    edited = [dict(r, menge=r["menge"] + 1) if (r["aufnr"], r["mblnr"], r["zeile"]) in (("001006", "D6", "0"), ("001007", "O7", "1")) else r for r in rows]
    after = table("aufm", *edited)
    changed = X.changed_orders(before, after)
    assert {r.aufnr for r in changed.collect()} == {"001006", "001007"}
    delta = X.reexplode_orders(orders, changed, after, *sources, stored, LATER)
    redone = {r.aufnr for r in delta.redone.collect()}

    used = defaultdict(set)
    for r in rows:
        if r.get("charg", "99") != "99":
            used[r["aufnr"]].add(f"0010{int(r['charg']):02}")
    above = {"001006", "001007"}
    while more := {a for a, makers in used.items() if makers & above} - above:
        above |= more
    assert redone == above and len(redone) < 10
    assert {r.aufnr for r in delta.rows.select("aufnr").distinct().collect()} <= redone

    full = X.explode_orders(orders_of(table), after, *sources, None, LATER)
    assert by_order(X.apply_delta(stored, delta)) == by_order(full.rows)
    stamps = {r.aufnr: r.xdate for r in delta.orders.collect()}
    assert stamps == {f"0010{i:02}": "20200201" if f"0010{i:02}" in redone else "20200101" for i in range(10)}
    assert {r.xstat for r in delta.orders.collect()} == {"X"}


def test_an_order_that_waited_for_output_is_done_when_it_comes(spark, table, sources):
    rows = postings(4)
    # order 9 has no output yet, so nothing above it can be exploded
    missing = [r for r in rows if r["mblnr"] != "O9"]
    before = table("aufm", *missing)
    first = X.explode_orders(orders_of(table), before, *sources, None, AS_OF)
    stored, orders = X.materialize(first.rows, "stored"), X.materialize(first.orders, "orders")
    assert any(r.xstat == "E" for r in orders.collect())
    after = table("aufm", *rows)
    delta = X.reexplode_orders(orders, X.changed_orders(before, after), after, *sources, stored, LATER)
    full = X.explode_orders(orders_of(table), after, *sources, None, LATER)
    assert by_order(X.apply_delta(stored, delta)) == by_order(full.rows)
    assert {r.xstat for r in delta.orders.collect()} == {"X"}
    # nothing changed: nothing is redone
    again = X.reexplode_orders(delta.orders, X.changed_orders(after, after), after, *sources, stored, LATER)
    assert again.redone.count() == 0 and again.rows.count() == 0


def test_totals_by_coefficients_equal_the_sums_of_the_rows(spark, table, sources):
    aufm = table("aufm", *postings(5))
    rows = X.explode_orders(orders_of(table), aufm, *sources, None, AS_OF).rows
    split = X.materialize(X.split_consumption(aufm, sources[0], X.producers(aufm, sources[1])), "split")
    wip = X.materialize(X.wip_postings(split), "wip")
    got = {(r.aufnr, r.charg): (r.qty, r.amt) for r in X.material_totals(orders_of(table), wip, X.pure_material_rows(split)).collect()}
    want = defaultdict(lambda: [0.0, 0.0])
    for r in rows.where("menge <> 0 OR dmbtr <> 0").collect():
        want[r.aufnr, r.charg][0] += r.qty
        want[r.aufnr, r.charg][1] += r.amt
    assert got.keys() == want.keys()
    assert all(got[k] == (pytest.approx(want[k][0]), pytest.approx(want[k][1])) for k in got)
