"""The language query against a plain version: words cut by a pattern, one text and one trigram at a time."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lotflow.llm.langid import op10_language_id
from samples import SF

LETTERS = np.random.Generator(np.random.PCG64(7)).integers(0, 2, (128, 1024), dtype=np.int8) * 2 - 1


def number(letter):
    low = letter.lower()[0]
    return ord(low) - ord("a") + 1 if "a" <= low <= "z" else 27 + ord(low) % 101


def bundle(grams):
    total = np.zeros(1024)
    for (a, b, c), n in grams.items():
        total += n * (np.roll(LETTERS[a], 2) * np.roll(LETTERS[b], 1) * LETTERS[c]).astype(float)
    return total


def grams_of(text):
    words = re.findall(r"[^\W\d_]+", text)
    if not words:
        return Counter()
    signs = [0] + [s for word in words for s in [*map(number, word), 0]]
    return Counter(zip(signs, signs[1:], signs[2:]))


def test_query_equals_plain_cosines(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    grams = {r.doc_id: grams_of(r.text or "") for r in rows}
    sums: dict[str, Counter] = {}
    for r in rows:
        if not held[r.doc_id] and r.lang is not None:
            sums.setdefault(r.lang, Counter()).update(grams[r.doc_id])
    prototypes = {lang: bundle(total) for lang, total in sums.items()}
    got = {r.doc_id: r for r in op10_language_id(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        one = got[r.doc_id]
        assert one.held_out == held[r.doc_id]
        if not grams[r.doc_id]:
            assert (one.lang_pred, one.score) == ("und", 0.0)
            continue
        own = bundle(grams[r.doc_id])
        cosines = {lang: own @ p / np.linalg.norm(own) / np.linalg.norm(p) for lang, p in prototypes.items()}
        assert one.lang_pred == max(sorted(cosines), key=cosines.get)
        assert one.score == pytest.approx(cosines[one.lang_pred], abs=1e-5)
