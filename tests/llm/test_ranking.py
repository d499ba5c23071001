"""Ranked search against plain scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from samples import sorted_rows

from lotflow.llm import ranking
from lotflow.llm.ranking import Block, gain, search, terms

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, queries, k=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    count, length = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for name, text in queries:
        scores = []
        for i, c in held:
            n = sum(c.values())
            score = 0
            for w, times in Counter(words(text)).items():
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1)))
                    score += times * weight * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * (25 + 75 * n * count // length)))
            if score:
                scores.append((-score, i is None, i or 0))
        out += [(name, rank + 1, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def corpus(seed, size):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["ÄRGER", "Ünder", "Éa1"]
    return [(i, " ".join(random.choices(vocabulary, [1 / (j + 1) for j in range(63)], k=random.choice([0, 1, 5, 40, 300])))) for i in range(size)]


@pytest.fixture(scope="module")
def docs():
    rows = corpus(1, 900)
    # Copies tie; one row has no id, two rows share one.
    return rows + [(2000 + i, t) for i, t in rows[:80]] + [(None, "w40 w41 w42"), (None, "w40 w41 w42"), (5, "w40 w41 w42"), (7, None), (8, ""), (9, "!!")]


QUERIES = [(1, "w40 w41 w42 w42 ärger"), (2, "W1, w2; w3 w50!"), (2, "Ünder ünder w59"), (None, "w60 éA1"), (3, None), (4, ""), (5, "nowhere"), (6, "w0")]


def frames(spark, docs):
    return (
        spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(5),
        spark.createDataFrame([(*q, "x") for q in QUERIES], "item_id long, text string, rank string"),
    )


def test_search_equals_plain_scores(spark, docs):
    got = sorted_rows(search(*frames(spark, docs)), "item_id", "rank", "doc_id", "score")
    assert got == plain(docs, QUERIES)


def test_many_queries_take_several_passes_and_all_postings(spark, docs, monkeypatch):
    monkeypatch.setattr(ranking, "VOCABULARY", 3)
    monkeypatch.setattr(ranking, "PASS_TERMS", 6)
    got = sorted_rows(search(*frames(spark, docs), k=3), "item_id", "rank", "doc_id", "score")
    assert got == plain(docs, QUERIES, 3)


def test_empty_tables(spark, docs):
    documents, queries = frames(spark, docs)
    assert search(documents.where("false"), queries).collect() == []
    assert search(documents, queries.where("false")).collect() == []


def test_bounds_are_never_below_scores():
    random.seed(3)
    nnz = 5000
    pairs = sorted({(random.randrange(400), random.randrange(200)) for _ in range(nnz)})
    term, doc = (np.array(x) for x in zip(*pairs))
    tf = np.array([random.choice([1, 1, 2, 3, 7, 8, 40, 5000]) for _ in pairs])
    block = Block(term, doc, tf, np.array([random.randrange(25, 400) for _ in range(200)]))
    for _ in range(50):
        asked = np.array(sorted(random.sample(range(420), 30)))
        weight = np.array([random.randrange(0, 20_000) for _ in asked])
        bounds, scores = block.bounds(asked, weight), block.scores(asked, weight, np.arange(200))
        assert (bounds >= scores).all() and (bounds == 0).sum() <= (scores == 0).sum()
        exact = {(t, d): n for (t, d), n in zip(pairs, tf)}
        want = [sum(int(w) * int(gain(np.int64(exact.get((t, d), 0)), block.ms[d])) for t, w in zip(asked, weight)) for d in range(200)]
        assert scores.tolist() == want


def test_terms_fold_ascii_only():
    text = "Ab9_c-ÄÖ x É Zİ"
    assert [t.decode() for t in terms(text.encode())] == words(text)
