"""Near-duplicate texts and vectors, components and decontamination against brute force."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import ODD, sorted_rows
from lotflow.llm import neardup
from lotflow.llm.components import components
from lotflow.llm.decontaminate import drop_contaminated, find_contamination
from lotflow.llm.neardup import keep_one, near_duplicates
from lotflow.llm.vectors import link_vectors


def roots_of(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def groups(docs, size, percent=80):
    sets = [(i, shingles(t, size)) for i, t in docs]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if a is not None and b is not None and x and 100 * len(x & y) >= percent * len(x | y)]
    return roots_of(links, [i for i, _ in sets if i is not None]), dict(sets)


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    links = [e for e in edges if e[0] != e[1]]
    want = roots_of(links, {n for e in links for n in e})
    got = dict((r.node, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def variants(seed, groups_of, words=60):
    """Texts in groups of copies changed a little, with a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randint(0, 4000)
    passage, docs = [word() for _ in range(45)], []
    for copies in groups_of:
        base = [word() for _ in range(words)]
        if rng.random() < 0.5:
            base = base[:20] + passage
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = word()
            docs.append((len(docs) * 3 + 5, " ".join(own)))
    rng.shuffle(docs)
    return docs


def test_near_duplicates_equal_brute_force(spark):
    docs = variants(3, [1] * 30 + [2] * 10 + [5] * 4 + [120])
    want, sets = groups(docs, 4)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4)
    assert sorted_rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted([(i, len(sets[i]), want[i], want[i] == i) for i, _ in docs], key=str)


def test_near_duplicates_of_odd_rows(odd, none):
    got = sorted_rows(near_duplicates(odd, size=5), "doc_id", "component_id", "kept")
    want, _ = groups([r[:2] for r in ODD], 5)
    known = [(i, want[i], want[i] == i) for i, *_ in ODD if i is not None]
    # The row without an id belongs to the group of 5.
    assert got == sorted([*known, (None, 5, False)], key=str)
    assert want[8] == 7
    assert near_duplicates(none).count() == 0
    kept = keep_one(odd)
    # One row of each group: of 5 its two rows and the one without an id, and of 7 and 8.
    assert kept.columns == odd.columns and sorted_rows(kept, "doc_id") == [(i,) for i in range(1, 8)]


def test_texts_with_one_id_are_apart(spark):
    text = lambda name, last: " ".join(f"{name}{i}" for i in range(60)) + f" {last}"
    texts = [text(name, last) for name, last in (("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("c", "x"), ("c", "y"), ("c", "z"))]
    frame = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (2, texts[3]), (1, texts[4]), (5, texts[5]), (None, texts[6])], "doc_id long, text string")
    for rows in (frame, frame.repartition(3)):
        assert sorted_rows(near_duplicates(rows, size=4), "doc_id", "component_id") == sorted([(1, 1), (2, 1), (2, 2), (1, 1), (5, 1), (None, 1)], key=str)
        assert sorted(r.text for r in keep_one(rows, size=4).collect()) == sorted([texts[0], texts[3], texts[4]])
    # Two texts of one group with its smallest id: one is kept.
    pair = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[2])], "doc_id long, text string")
    assert keep_one(pair, size=4).count() == 1 and near_duplicates(pair, size=4).where("kept").count() == 1


def test_rows_without_ids_are_kept_once_a_group(spark):
    text = lambda name, last: " ".join(f"{name}{i}" for i in range(60)) + f" {last}"
    rows = [(None, text(f"n{i}", last), "en") for i in range(150) for last in ("x", "x", "y")] + [(7, text("n0", "z"), "de"), (7, text("n0", "z"), "en"), (7, text("m", "x"), "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    kept = [tuple(r) for r in keep_one(docs, size=4).collect()]
    assert len(kept) == 151 and len({t.split()[0] for _, t, _ in kept}) == 151 and set(kept) <= set(rows)
    assert [(i, t) for i, t, _ in kept if t.startswith("n00 ")] == [(7, text("n0", "z"))]
    got = sorted_rows(near_duplicates(docs, size=4), "doc_id", "component_id")
    assert got == sorted([(None, 7)] * 3 + [(None, None)] * 447 + [(7, 7)] * 3, key=str)
    assert keep_one(docs.where("doc_id IS NULL AND text LIKE 'n10 %'"), size=4).count() == 1


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_long_lists_are_compared_in_pieces(spark, monkeypatch, percent):
    """All pairs of a hot list against brute force, with pieces of a few classes and no pass before."""
    monkeypatch.setattr(neardup, "LIST", 5)
    monkeypatch.setattr(neardup, "FIRST", 0)
    rng = np.random.default_rng(percent)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(80):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            words[at] = f"x{rng.integers(1 << 30)}"
        docs.append((i, " ".join(words)))
    want, _ = groups(docs, 4, percent)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4, percent=percent)
    assert sorted_rows(got, "doc_id", "component_id") == sorted(want.items(), key=str)


def test_filters_by_similarity():
    assert neardup.least_match(80) == 10 and neardup.least_match(60) == 4
    bits = neardup.BITS
    for percent in (50, 60, 80, 95):
        p, most = Fraction(100 - percent, 200), neardup.most_unlike(percent)
        chance = lambda i: math.comb(bits, i) * p**i * (1 - p) ** (bits - i)  # noqa: E731, B023
        # Terms fall off by more than a half from here on.
        tail = sum(chance(i) for i in range(most + 1, most + 120))
        assert tail < Fraction(1, 10**6) <= tail + chance(most)
    assert neardup.most_unlike(100) == 0 and neardup.least_match(100) == 24
    with pytest.raises(ValueError):
        neardup.least_match(10)


def test_vectors_with_one_id_are_apart(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [1.0, 0.1, 0.0]), (1, [0.0, 0.0, 1.0]), (2, [0.0, 0.1, 1.0]), (2, [0.0, 1.0, 0.0])]
    got = sorted_rows(link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "vec_id", "n_links", "component_id")
    assert got == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 0, 2), (2, 1, 1)]
    kept = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("kept")
    assert sorted_rows(kept, "vec_id", "n_links") == [(1, 1), (1, 1), (2, 0)]


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [rng.standard_normal(24) for _ in range(150)]
    for size in (2, 3, 40):
        base = rng.standard_normal(24)
        rows += [base + 0.12 * rng.standard_normal(24) for _ in range(size)]
    rows += [rows[0], rows[0] * 3, rows[7]]
    data = [(i * 2 + 1, [float(v) for v in x], 0) for i, x in enumerate(rows)]
    odd = [(1001, None), (1002, []), (1003, [0.0] * 24), (1004, [1.0, None]), (1005, [float("nan")] * 24), (1006, [float("inf"), 1.0]), (1007, [1.0, 2.0]), (1008, [2.0, 4.0]), (1, data[0][1])]
    data += [(i, x, 0) for i, x in odd]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, c int").withColumn("x", F.lit(1))
    usable = {k: np.array(x) for k, (_, x, _) in enumerate(data) if x and all(v is not None and np.isfinite(v) for v in x) and any(x)}
    links = [(a, b) for a in usable for b in usable if a < b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] / np.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b])) >= 0.9]
    root = roots_of(links, range(len(data)))
    least = {}
    for k, r in root.items():
        least[r] = min(least.get(r, 1 << 60), data[k][0])
    want = sorted([(data[k][0], sum(k in e for e in links), least[r], data[k][0] == least[r]) for k, r in root.items()], key=str)
    assert sorted_rows(link_vectors(df)) == want
    assert link_vectors(df.where("false")).count() == 0


def test_linked_groups_of_nearer_copies_are_one(spark):
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v)
    rows = [rng.standard_normal(64) for _ in range(100)]
    for inside, across in ((0.99, 0.95), (0.985, 0.96), (0.99, 0.8)):
        p = unit(rng.standard_normal(64))
        noise = rng.standard_normal(64)
        q = across * p + np.sqrt(1 - across**2) * unit(noise - noise @ p * p)
        rows += [np.sqrt(inside) * base + np.sqrt(1 - inside) * unit(rng.standard_normal(64)) for base in (p, q) for _ in range(30)]
    cosines = (lambda m: m @ m.T)(np.array([unit(x) for x in rows]))
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(cosines >= 0.9, 1)))]
    root = roots_of(links, range(len(rows)))
    assert root[100] == root[159] and root[220] != root[279]
    want = sorted([(i, sum(i in e for e in links), root[i], i == root[i]) for i in range(len(rows))], key=str)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(rows)], "vec_id long, embedding array<double>")
    assert sorted_rows(link_vectors(df)) == want
    # A recall that no graph reaches: all cells are compared.
    assert sorted_rows(link_vectors(df, recall=2.0, turns=1)) == want


def hits(text, items, window=13):
    import re

    cut = lambda t: [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())]
    words, covered, found = cut(text), set(), set()
    for key, item in items:
        own = cut(item)
        n = min(window, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                covered |= set(range(i, i + n))
                found.add(key)
    return len(words), len(covered), sorted(k for k in found if k is not None)


def test_contamination_by_look_up_and_by_joins_equals_brute_force(spark, odd, none):
    rng = random.Random(9)
    word = lambda: "t%d" % rng.randint(0, 30)
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 12, 13, 14, 40])))) for i in range(25)]
    items += [(90, items[3][1]), (91, None), (92, "!!"), (None, "t1 t2"), (93, "the river, runs over The Old stones and under the bridge of the town")]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 50))) + " " + " ".join(items[rng.randrange(25)][1].split()[: rng.randint(0, 40)])) for i in range(120)]
    docs += [r[:2] for r in ODD]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted([(i, *hits(t, items)) for i, t in docs], key=str)
    for limit in (10_000, 0):
        got = find_contamination(frame, bench, broadcast_windows=limit).select("row.doc_id", "out.n_words", "out.n_hit", "out.items", "out.spans").collect()
        assert sorted([(r[0], r[1], r[2], list(r[3])) for r in got], key=str) == want
        assert all(sum(s.end - s.begin for s in r.spans) == r.n_hit for r in got)
    assert drop_contaminated(odd, bench).columns == odd.columns
    assert drop_contaminated(none, bench).count() == 0
    assert drop_contaminated(odd, bench.where("false")).count() == len(ODD)
