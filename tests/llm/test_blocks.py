"""Entities of the field at the edges of blocks."""

from __future__ import annotations

import random

import numpy as np

from lotflow.llm import pii, semicrf


def test_blocks_find_what_a_whole_line_holds(monkeypatch):
    model = semicrf.train([e for e in (pii._example(t, s) for t, s in pii._generated(150)) if e], epochs=3)
    rng = random.Random(2)
    lines = []
    for shift in range(12):
        parts = ["on"] * shift
        while len(parts) < 420:
            parts += ["call", "(%d) 555-%d" % (rng.randint(200, 999), rng.randint(1000, 9999)), "at", "%d:%d" % (rng.randint(10, 23), rng.randint(10, 59))]
        lines.append(" ".join(parts))
    blocks = [pii.model_spans(t, model, [], 0.5) for t in lines]
    monkeypatch.setattr(pii, "BLOCK", 1 << 30)
    whole = [pii.model_spans(t, model, [], 0.5) for t in lines]
    assert min(map(len, whole)) > 50
    assert [[s[:3] for s in x] for x in blocks] == [[s[:3] for s in x] for x in whole]
    assert all(np.allclose([s[3] for s in x], [s[3] for s in y]) for x, y in zip(blocks, whole))
