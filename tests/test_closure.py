"""Doubling of paths against plain walks."""

import random
from collections import defaultdict

import pytest

from lotflow.operators import closure
from lotflow.operators.closure import ENDLESS, coefficients, longest_paths
from lotflow.operators.orders import order_levels


def plain(links):
    """Longest path of every pair with a path, ENDLESS through cycles."""
    after = defaultdict(set)
    for u, v in links:
        after[u].add(v)

    def reach(u):
        seen, todo = set(), list(after[u])
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += after[n]
        return seen

    below = {u: reach(u) for u in {n for pair in links for n in pair}}
    on_cycle = {u for u in below if u in below[u]}
    longest = {}

    def length(u, v):
        if (u, v) not in longest:
            longest[u, v] = max(1 + (length(n, v) if n != v else 0) for n in after[u] if n == v or v in below[n])
        return longest[u, v]

    out = {}
    for u in below:
        for v in below[u]:
            endless = any(c in (u, v) or (c in below[u] and v in below[c]) for c in on_cycle)
            out[u, v] = ENDLESS if endless else length(u, v)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_longest_paths_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    pairs = {(rnd.randrange(25), rnd.randrange(25)) for _ in range(40)}
    links = [(f"n{a}", f"n{b}") for a, b in pairs if a < b or rnd.random() < 0.15] * 2
    paths, wide = longest_paths(spark.createDataFrame(links, "u string, v string"))
    assert {(r.u, r.v): r.w for r in paths.collect()} == plain(links) and wide is None


def test_beyond_the_limit_wide_nodes_are_left_out_whole(spark):
    """A cycle of 12 behind a chain of 5, a tail behind it, and a chain beside it."""
    links = [(f"a{i}", f"a{i + 1}") for i in range(5)] + [("a5", "c0")] + [(f"c{i}", f"c{(i + 1) % 12}") for i in range(12)]
    links += [("c3", "t0"), ("t0", "t1"), ("x0", "x1"), ("x1", "x2"), ("x2", "t1")]
    paths, wide = longest_paths(spark.createDataFrame(links, "u string, v string"), most=100)
    left = {r.v for r in wide.collect()}
    assert left >= {f"c{i}" for i in range(12)} | {"t0", "t1"} and not left & {"x1", "x2", "a1"}
    assert {(r.u, r.v): r.w for r in paths.collect()} == {p: w for p, w in plain(links).items() if p[1] not in left}


@pytest.mark.parametrize("rounds, most", [(32, None), (0, None), (0, 1)])
def test_levels_of_a_cycle_that_no_seed_reaches(spark, rounds, most):
    """d lies behind a cycle, but not on a way from the seed."""
    links = [("a", "d"), ("d", "e"), ("x", "y"), ("y", "x"), ("y", "d"), ("a", "b"), ("b", "c"), ("c", "b"), ("c", "f")]
    edges = spark.createDataFrame([(a, "I0045", "1", b) for a, b in links], "aufnr string, stat string, chgnr string, submo string")
    found, _ = order_levels(spark.createDataFrame([("a",)], "aufnr string"), edges, rounds=rounds, most=most)
    got = {r.aufnr: "cyclic" if r.cyclic else r.bomlv for r in found.collect()}
    assert got == {"a": 1, "d": 2, "e": 3, "b": "cyclic", "c": "cyclic", "f": "cyclic"}


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(closure, "materialize", lambda df, name, write=closure.materialize: written.append(name) or write(df, name))
    chain = [(f"n{i:04}", "I0045", "1", f"n{i + 1:04}") for i in range(250)]
    edges = spark.createDataFrame(chain, "aufnr string, stat string, chgnr string, submo string")
    found, _ = order_levels(spark.createDataFrame([("n0000",)], "aufnr string"), edges, rounds=4)
    assert {r.aufnr: r.bomlv for r in found.collect()} == {f"n{i:04}": i + 1 for i in range(251)}
    assert written.count("paths") <= 10 and len(written) <= 16


def test_coefficients_sum_products_over_all_paths(spark):
    rnd = random.Random(8)
    factors = [(a, b, rnd.random()) for a in range(14) for b in range(a + 1, 14) if rnd.random() < 0.35]
    factors += factors[:3]
    got = {(r.u, r.v): r.c for r in coefficients(spark.createDataFrame(factors, "u int, v int, f double")).collect()}
    want = defaultdict(float)

    def follow(begin, at, product):
        for a, b, f in factors:
            if a == at:
                want[begin, b] += product * f
                follow(begin, b, product * f)

    for n in range(14):
        follow(n, n, 1.0)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_coefficients_refuse_cycles(spark):
    with pytest.raises(ValueError, match="cycle"):
        coefficients(spark.createDataFrame([("a", "b", 0.5), ("b", "a", 0.5)], "u string, v string, f double"))
    assert coefficients(spark.createDataFrame([], "u string, v string, f double")).collect() == []
