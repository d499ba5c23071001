from __future__ import annotations

import itertools
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from samples import ODD, SF, sorted_rows
from lotflow.llm.packing import _best_step, _Pieces, best_fit, local_search, op3_packing, pack_documents, pack_group
from lotflow.llm.token_counts import count_tokens, op2_token_counts
from lotflow.llm.tokens import Encoder, public

HARD = ["", "a", "it's   a\n\n test 's", "x<|endoftext|>y <|startoftext|>", "日本語 text", "a\x00b", "  ", "Ünïcödé ſtraße ŉ Ÿ", "nb sp", "12 345²¾", "!!!'s ''s", "\t\t x", "İstanbul ΣΑΣ", "éte", "a\u0085b\x1cc"]


def library(name, text):
    return Tokenizer.from_file(public(name)).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    rng, tokenizer = random.Random(1), Tokenizer.from_file(public(name))
    texts = HARD + ["".join(rng.choice("ab 'stré.1\n\tÉ²-") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    for remember in (600_000, 3):
        got = Encoder(public(name), remember).encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts_of_odd_rows_and_an_empty_table(odd, none):
    counts = count_tokens(odd, public("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), len(library("byte_bpe_50k.json", t or ""))) for i, t, *_ in ODD]
    assert sorted_rows(counts) == sorted(want, key=str)
    assert count_tokens(none, public("byte_bpe_50k.json")).count() == 0


def test_stored_counts_are_used_and_misses_appended(spark, tmp_path):
    path, name = f"file://{tmp_path}/cache", public("byte_bpe_50k.json")
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    count_tokens(first, name, path).collect()
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    # A wrong count in the cache shows that it is read.
    forged = stored.selectExpr("digest", "tokenizer", "n_tokens + 100 AS n_tokens").collect()
    other = f"file://{tmp_path}/forged"
    spark.createDataFrame(forged, stored.schema).write.parquet(other)
    more = first.union(spark.createDataFrame([(4, "new text")], first.schema))
    rows = dict((i, n) for i, _, n in sorted_rows(count_tokens(more, name, other)))
    assert rows[1] > 100 and rows[3] > 100 and rows[4] == len(library("byte_bpe_50k.json", "new text"))
    assert spark.read.parquet(other).count() == 3
    # Another tokenizer's version does not see them.
    assert all(n < 100 for _, _, n in sorted_rows(count_tokens(first, public("word_bpe_49k.json"), other)))


def test_query_counts_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(public("byte_bpe_50k.json"))
    rows = op2_token_counts(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(tokenizer.encode(docs[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[r.doc_id] or "").encode()), n, n > 1024)


def check_packing(rows, docs, capacity):
    """Every document whole, every sequence gapless and within the capacity."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for key, text in docs:
        ids = [*library("word_bpe_49k.json", text or ""), 0]
        for k, i in enumerate(range(0, len(ids), capacity)):
            part = ids[i : i + capacity]
            want[key].append((k, i, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    return len(sequences)


def test_packing_is_exact_and_at_its_bound(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op3_packing(spark, SF).collect()
    used = check_packing(rows, docs, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_of_odd_rows_in_several_groups(odd, none):
    rows = pack_documents(odd, public("word_bpe_49k.json"), capacity=64, group_size=4).collect()
    check_packing(rows, [r[:2] for r in ODD], 64)
    assert pack_documents(none, public("word_bpe_49k.json")).count() == 0


def test_local_search_empties_bins_that_best_fit_leaves():
    rng, before, after = np.random.Generator(np.random.PCG64(1)), 0, 0
    for _ in range(100):
        sizes = rng.integers(150, 500, 40)
        first = best_fit(sizes, 1000)
        bins = local_search(sizes, first, 1000)
        assert np.bincount(bins, weights=sizes).max() <= 1000
        assert (np.bincount(bins, weights=sizes) ** 2).sum() >= (np.bincount(first, weights=sizes) ** 2).sum()
        before, after = before + len(set(first)), after + len(set(bins))
    assert after < before
    assert len(pack_group(np.zeros(0, np.int64), 10)) == 0


def exchange_left(sizes, bins, capacity):
    """Whether any exchange of one or two pieces for none, one or two would raise the squares."""
    fill = np.bincount(bins, weights=sizes).astype(int)
    underfull = [b for b in range(len(fill)) if 0 < fill[b] < capacity]
    for s, t in itertools.permutations(underfull, 2):
        for n_out, n_back in ((1, 0), (2, 0), (1, 1), (2, 1), (1, 2)):
            for out in itertools.combinations(np.flatnonzero(bins == s), n_out):
                for back in itertools.combinations(np.flatnonzero(bins == t), n_back):
                    d = sizes[list(out)].sum() - sizes[list(back)].sum()
                    if 0 < d <= capacity - fill[t] and fill[t] - fill[s] + d > 0:
                        return True
    return False


def test_a_bin_that_stays_has_no_exchange_left():
    rng, searched = np.random.Generator(np.random.PCG64(2)), 0
    for _ in range(60):
        sizes = rng.integers(*((5, 50), (30, 60))[_ % 2], 24)
        bins = np.zeros(24, np.int64) if rng.random() < 0.1 else best_fit(sizes, 100)
        if np.bincount(bins, weights=sizes).max() > 100:
            continue
        last = local_search(sizes, bins, 100)
        fill = np.bincount(last, weights=sizes)
        assert fill.max() <= 100
        if np.count_nonzero(fill) > -(-sizes.sum() // 100):
            searched += 1
            assert _best_step(_Pieces(sizes, last, 100), fill.astype(np.int64), int(np.flatnonzero(fill == fill[fill > 0].min())[0])) is None
    assert searched


def test_a_step_is_found_wherever_there_is_one():
    rng, found = np.random.Generator(np.random.PCG64(3)), set()
    for _ in range(60):
        sizes, bins = rng.integers(5, 60, 9), rng.integers(0, 3, 9)
        fill = np.bincount(bins, weights=sizes, minlength=3).astype(np.int64)
        capacity = int(fill.max()) + int(rng.integers(0, 8))
        steps = [_best_step(_Pieces(sizes, bins, capacity), fill, b) for b in range(3) if 0 < fill[b] < capacity]
        assert any(s is not None for s in steps) == exchange_left(sizes, bins, capacity)
        found.add(any(s is not None for s in steps))
    assert found == {True, False}
