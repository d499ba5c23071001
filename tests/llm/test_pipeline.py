"""The pipeline against a plain version of every stage."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from samples import SF
from lotflow.llm import langid
from lotflow.llm.tokens import public
from test_groups import groups, hits
from test_scans import secret_spans


def test_stages_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(3).selectExpr("doc_id + 5000 AS doc_id", "if(doc_id = 0, null, '1234 !!') AS text", "lang", "source", "n_chars")
    docs = docs.union(more)
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.materialize(stage(spark, steps[-1], SF), "step"))
    named, single, clean, redacted, packed = steps[1:]
    for step in steps[1:5]:
        assert step.columns == docs.columns and step.schema.simpleString() == docs.schema.simpleString()
    rows = {r.doc_id: r for r in docs.collect()}

    has_letter = {i for i, r in rows.items() if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in named.collect()} == has_letter and len(has_letter) == len(rows) - 3
    root, _ = groups([(i, rows[i].text) for i in sorted(has_letter)], 5)
    firsts = {i for i in has_letter if root[i] == i}
    assert {r.doc_id for r in single.collect()} == firsts
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = {i: hits(rows[i].text, items) for i in firsts}
    left = {i for i, (n, k, _) in found.items() if not (k and 20 * k >= n)}
    assert {r.doc_id for r in clean.collect()} == left
    for r in redacted.collect():
        spans, text, at = secret_spans(rows[r.doc_id].text), "", 0
        for a, kind, b in spans:
            if a >= at:
                text += rows[r.doc_id].text[at:a] + f"<{kind}>"
            at = max(at, b)
        want = text + rows[r.doc_id].text[at:]
        assert r.text == want and r.n_chars == (len(want) if spans else rows[r.doc_id].n_chars)
    tokenizer = Tokenizer.from_file(public("word_bpe_49k.json"))
    lengths = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in redacted.collect()}
    sums: dict[int, int] = {}
    for r in packed.collect():
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
    assert sums == lengths
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.run(spark, SF).count() > 0


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "empty")
        assert docs.count() == 0


def test_cosine_of_bundles():
    vectors = langid.Vectors(256)
    codes, counts = np.array([5, 7 << 14 | 3]), np.array([2, 1])
    first, second, third = vectors.parts
    want = 2 * (first[0] * second[0] * third[5]).astype(int) + first[7] * second[0] * third[3]
    assert vectors.bundle(codes, counts).tolist() == want.tolist()
