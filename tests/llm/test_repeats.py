"""Repeated strings against brute force, and the suffix array against sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import ODD, sorted_rows

from lotflow.llm import repeats
from lotflow.llm.repeats import contexts, remove_repeats
from lotflow.llm.suffixes import longest_matches, suffix_array

WIDTH = 200


def plain(docs, width=WIDTH):
    raws = [(t or "").encode() for _, t in docs]
    counts = Counter(r[i : i + width] for r in raws for i in range(len(r) - width + 1))
    out = []
    for (doc, _), raw in zip(docs, raws):
        gone = np.zeros(len(raw) + 2, bool)
        for i in range(len(raw) - width + 1):
            if counts[raw[i : i + width]] > 1:
                gone[i + 1 : i + width + 1] = True
        kept = bytes(b for b, g in zip(raw, gone[1:]) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def noise(n, letters="abcdefghij klmnopqé"):
    return "".join(random.choices(letters, k=n))


def corpus():
    random.seed(5)
    passage, other = noise(700), noise(230)
    docs = [(i, noise(random.choice([10, 250, 600, 1500]))) for i in range(60)]
    # A passage in many texts, once and twice; its parts around the width; near copies; copies; periods.
    docs += [(100 + i, noise(i) + passage + noise(40)) for i in range(40)]
    docs += [(200, passage + noise(5) + passage), (201, other + "!"), (202, "?" + other)]
    docs += [(210 + n, noise(30) + passage[50 : 50 + n].encode()[:n].decode("utf-8", "ignore") + noise(30)) for n in (198, 199, 200, 201, 202)]
    base = noise(3000)
    docs += [(300 + i, base[: 400 * i] + "#" + base[400 * i + random.randrange(3) :]) for i in range(1, 7)]
    docs += [(400, base), (401, base), (402, base[:200]), (403, base[:200])]
    docs += [(500, "a" * 900), (501, "ab" * 99 + "a"), (502, "ab" * 100), (503, "xyz" * 300), (504, "a" * 199 + "b"), (505, "é" * 300)]
    return docs


@pytest.fixture(scope="module")
def docs():
    return corpus()


@pytest.mark.parametrize("limit", [4096, 3])
def test_repeats_equal_brute_force(spark, docs, limit):
    """Also with so low a limit that common anchors are cut down to single windows."""
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, spans string").repartition(4)
    got = remove_repeats(frame, limit=limit)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted_rows(got, *columns) == plain(docs)
    for r in got.collect():
        assert sum(s.z - s.a for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_another_width(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted_rows(remove_repeats(frame, width=333).drop("spans")) == plain(docs, 333)


def test_odd_rows(odd):
    got = remove_repeats(odd)
    rows = [(r[0], (r[1] or "").encode()) for r in ODD]
    assert sorted((r.doc_id, r.n_bytes) for r in got.where("doc_id IS NOT NULL").collect()) == sorted((i, len(t)) for i, t in rows if i is not None)
    # 60,000 words of 700 in turn: all but the head occurs twice, the blank before the first word included.
    long = next(r for r in got.collect() if r.doc_id == 4)
    assert long.n_spans == 1 and long.n_removed == long.n_bytes - len("Ünder wave".encode())


def test_empty_table(none):
    assert remove_repeats(none).collect() == []


def test_windows_choose_by_their_bytes_only(monkeypatch):
    """Contexts cover every window once, in any chunks, and equal windows choose equal anchors."""
    random.seed(9)
    raw = (noise(500) + "a" * 400 + noise(300)).encode()
    raw = raw + raw[100:1000]
    seen = {}
    for chunk in (1 << 20, 37):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        first, count, anchor, h = contexts(raw, WIDTH)
        assert [w for a, n in zip(first, count) for w in range(a, a + n)] == list(range(len(raw) - WIDTH + 1))
        for a, n, p, x in zip(first, count, anchor, h):
            for w in range(a, a + n):
                assert seen.setdefault(raw[w : w + WIDTH], (p - w, x)) == (p - w, x)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array_equals_sorting(symbols):
    text = [*symbols, 0]
    order = suffix_array(text, 4)
    assert order == sorted(range(len(text)), key=lambda i: text[i:])

    def shared(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    matches = longest_matches(text, order)
    assert all(matches[i] == max(shared(i, j) for j in range(len(text)) if j != i) for i in range(len(symbols)))
