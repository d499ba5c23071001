"""Pairs of near copies below the similarity are told apart before their sets are compared."""

import random

import numpy as np

from lotflow.llm import neardup


def test_parities_never_differ_in_more_cells_than_shingles():
    rng = np.random.default_rng(4)
    for n, apart in ((1, 1), (40, 9), (200, 44), (3000, 700), (50000, 9000)):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        other = base.copy()
        other[: apart // 2] = rng.integers(0, 1 << 63, apart // 2, dtype=np.uint64)
        one, two = neardup.odd_sketch(np.unique(base)), neardup.odd_sketch(np.unique(other))
        differ = int(np.unpackbits((one ^ two).view(np.uint8)).sum())
        really = len(np.setxor1d(base, other))
        assert differ <= really and (really > 60 or differ >= 0.8 * really)


def test_a_large_group_just_below_the_similarity_makes_few_pairs(spark, monkeypatch):
    random.seed(8)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        # a place of its own changes four shingles, so most pairs share some 250 of 340
        for place in random.sample(range(4, 296, 4), 6):
            words[place] = f"x{i}_{place}"
        rows.append((i, " ".join(words)))
    # copies of the last one with one other word
    rows += [(100 + i, rows[-1][1].replace("w297", f"y{i}")) for i in range(5)]
    made = []
    plain = neardup.open_pairs

    def counted(*args):
        pairs = plain(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(neardup, "open_pairs", counted)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()}
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(297)} for i, t in rows}
    want = {i: min(j for j in sets if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])) for i in sets}
    assert got == want
    assert made and sum(made) <= 120
