import random

import pytest

from lotflow.operators import orders as O


@pytest.fixture
def graph(spark, table):
    """Edges and the order table from a list of (consumer, producer) pairs."""

    def build(links, closed=None, tracked=None):
        nodes = sorted({x for pair in links for x in pair if x})
        closed = nodes if closed is None else closed
        rows = [(a, "I0045", "1", b) for a, b in links if a in closed]
        have = {r[0] for r in rows}
        rows += [(n, "I0045", "1", None) for n in closed if n not in have]
        edges = spark.createDataFrame(rows, "aufnr string, stat string, chgnr string, submo string")
        return edges, table("aufkx", *[dict(aufnr=a, xstat=x) for a, x in (tracked or {nodes[0]: " "}).items()])

    return build


def levels(edges, seeds, **more):
    found, _ = O.order_levels(seeds, edges, **more)
    return {r["aufnr"]: "cyclic" if r["cyclic"] else r["bomlv"] for r in found.collect()}


def test_a_diamond_takes_the_longest_path(graph):
    edges, tracked = graph([("a", "b"), ("a", "d"), ("b", "c"), ("c", "d")])
    assert levels(edges, tracked) == {"a": 1, "b": 2, "c": 3, "d": 4}


def test_a_producer_is_deeper_than_every_consumer(graph):
    rnd = random.Random(3)
    links = sorted({(f"n{a:02}", f"n{b:02}") for a, b in ((rnd.randrange(30), rnd.randrange(30)) for _ in range(80)) if a < b})
    edges, tracked = graph(links, tracked={"n00": " ", "n01": " ", "n07": " "})
    got = levels(edges, tracked)
    longest = {n: 1 for n in ("n00", "n01", "n07")}
    for a, b in links:  # sorted by consumer, so a consumer is final before it is used
        if a in longest:
            longest[b] = max(longest.get(b, 0), longest[a] + 1)
    assert got == longest


@pytest.mark.parametrize("rounds, most", [(0, 1), (0, None), (1, 3), (2, 7), (32, None)])
def test_cycles_end_and_are_reported(graph, rounds, most):
    # a -> b -> c -> b is a cycle, d lies behind it, e and f beside it
    edges, tracked = graph([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("a", "e"), ("e", "f")])
    got = levels(edges, tracked, rounds=rounds, most=most)
    assert got == {"a": 1, "b": "cyclic", "c": "cyclic", "d": "cyclic", "e": 2, "f": 3}


def test_deep_chains_beyond_the_limit_of_pairs(graph):
    edges, tracked = graph([(f"n{i:02}", f"n{i + 1:02}") for i in range(9)])
    assert levels(edges, tracked, rounds=3, most=12)["n09"] == 10


def test_states_after_levelling(graph, rows):
    # u is not closed, x was done and is reached again, y was done and is not reached, e failed before
    edges, tracked = graph(
        [("a", "u"), ("a", "x"), ("e", "x")], closed=["a", "x", "e"], tracked={"a": " ", "x": "X", "y": "X", "e": "E"}
    )
    got = O.level_orders(tracked, edges)
    assert rows(got, "aufnr", "bomlv", "xstat", "stat") == [
        ("a", 1, "B", "I0045"), ("e", 1, "B", "I0045"), ("u", 0, " ", " "), ("x", 2, "B", "I0045"), ("y", None, "X", " "),
    ]


def test_cyclic_orders_end_in_error(graph, rows):
    edges, tracked = graph([("a", "b"), ("b", "a")])
    got = O.level_orders(tracked, edges, rounds=2)
    assert rows(got, "aufnr", "xstat", "remark") == [("a", "E", "cyclic"), ("b", "E", "cyclic")]


def test_edges_need_an_active_closing_status_and_drop_self(table, rows):
    postings = table(
        "aufm", dict(aufnr="A", matnr="M", charg="1"), dict(aufnr="A", matnr="M", charg="1", zeile="2"),
        dict(aufnr="A", matnr="M", charg="2"), dict(aufnr="A", matnr="M", charg="3"), dict(aufnr="A", matnr="M", charg="9"),
        dict(aufnr="P", matnr="M", charg="1"), dict(aufnr="O", matnr="M", charg="1"),
    )
    status = table(
        "jest", dict(objnr="ORA", stat="I0045", chgnr="1"), dict(objnr="ORA", stat="I0046", chgnr="2"),
        dict(objnr="ORP", stat="I0045", inact="X"), dict(objnr="ORO", stat="I0002"),
    )
    index = table(
        "mch1x", dict(matnr="M", charg="1", aufnr="B"), dict(matnr="M", charg="2", aufnr="A"), dict(matnr="M", charg="3", aufnr=" ")
    )
    # own batch, purchased batch and unknown batch all leave the order without a producer on that edge
    assert rows(O.order_edges(postings, status, index)) == [("A", "I0046", "2", "B"), ("A", "I0046", "2", None)]


def test_register_keeps_tracked_orders(table, rows):
    found = table("aufkx", dict(aufnr="a"), dict(aufnr="b"), dict(aufnr="b"))
    got = O.register_suborders(table("aufkx", dict(aufnr="a", xstat="X")), found)
    assert rows(got, "aufnr", "xstat", "bomlv") == [("a", "X", None), ("b", " ", 0)]
