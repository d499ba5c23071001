"""Ranked lexical search with bit-sliced Bloom signatures.

Method: documents are taken in blocks. Every document has a Bloom signature of its
terms, one for each frequency step (the term occurs at least 1, 2, 4 or 8 times),
and a block stores signatures by slices: one bitmap over its documents per
signature bit. The slices of a term ANDed overestimate the documents that hold it,
never missing one; the bitmaps of a query's terms summed by their weights, step by
step, give an upper bound of every document's score. Documents whose bound lies
below the tenth best score found are excluded by proof; all others are rescored
exactly, in descending order of their bounds.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, raw_texts, release, table
from lotflow.session import materialize

#: Frequency steps, bits of a signature, bits set per term and step.
STEPS, BITS, HASHES = (1, 2, 4, 8), 4096, 2
#: Terms of all queries up to which a task gets them all, to keep postings of these only (some 60 MB).
VOCABULARY = 500_000
#: Terms of the queries that are searched in one pass over the postings.
PASS_TERMS = 200_000
#: Documents rescored at a time.
ROUND = 64
LONG = 1_000_000

# Bytes of terms: digits, letters, everything beyond ASCII; A-Z in small letters, others are blanks.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in their order, with repeats."""
    return raw.translate(_FOLD).split()


def postings(docs: DataFrame, wanted: set[bytes] | None, id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tfs``: how many terms a document has and how often it has the wanted ones (None: all)."""

    def make():
        def step(batch):
            out = {"id": batch.column("id"), "n": [], "terms": [], "tfs": []}
            for raw in raw_texts(batch):
                words = terms(raw)
                counts = Counter(words if wanted is None else filter(wanted.__contains__, words))
                out["n"].append(len(words))
                out["terms"].append(list(counts))
                out["tfs"].append(list(counts.values()))
            return out

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, "id bigint, n bigint, terms array<binary>, tfs array<bigint>", make)


def _weights(held: DataFrame, asked: DataFrame, count: int) -> DataFrame:
    """``q, term, w``: the weight of every term of a query times its repeats there."""
    words = held.select(F.explode("terms").alias("term"))
    frequency = words.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * count + 2) / (2 * F.coalesce("df", F.lit(0)) + 1)))
    return asked.join(frequency, "term", "left").select("q", "term", (weight * F.col("repeats")).alias("w"))


class Block:
    """Postings of some documents: exact ones by (term, document), and bit-sliced signatures."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, ms: np.ndarray):
        self.count, self.ms = len(ms), ms
        order = np.argsort(term * self.count + doc)
        self.keys, self.tfs = (term * self.count + doc)[order], tf[order]
        self.slices = []
        for least in STEPS:
            hold = tf >= least
            bits = np.zeros((BITS, self.count), bool)
            for place in _places(term[hold]):
                bits[place, doc[hold]] = True
            self.slices.append(np.packbits(bits, axis=1))
        # The most that one term can give a document if it is at a step but not at the next one.
        most = [gain(np.int64(2 * s - 1), ms) for s in STEPS[:-1]] + [np.full(self.count, LONG)]
        self.gains = [most[0]] + [b - a for a, b in zip(most, most[1:])]

    def bounds(self, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """An upper bound of every document's score."""
        total = np.zeros(self.count, np.int64)
        for slices, more in zip(self.slices, self.gains):
            held = np.bitwise_and.reduce([slices[place] for place in _places(term)])
            hit = held.any(axis=1)
            if hit.any():
                # Sums of integers far below 2**53 are exact.
                total += more * (weight[hit].astype(np.float64) @ np.unpackbits(held[hit], axis=1, count=self.count)).astype(np.int64)
        return total

    def scores(self, term: np.ndarray, weight: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The exact scores of some documents."""
        keys = term[:, None] * self.count + docs
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        tf = np.where(self.keys[at] == keys, self.tfs[at], 0)
        return (weight[:, None] * gain(tf, self.ms[docs])).sum(axis=0)


def _places(term: np.ndarray) -> list[np.ndarray]:
    """The signature bits of each term."""
    mixed = (term.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return [((mixed >> np.uint64(14 * k + 8)) % np.uint64(BITS)).astype(np.int64) for k in range(HASHES)]


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What ``tf`` occurrences give a document of length factor ``m`` for a weight of 1."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _search(held: DataFrame, queries: list[tuple[int, list[bytes], list[int]]], k: int, count: int, length: int) -> DataFrame:
    """``q, id, score``: the best ``k`` documents of every task for each query, and no others of that task can be better."""
    names: dict[bytes, int] = {}
    asked = []
    for q, words, weights in queries:
        term = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
        asked.append((q, term, np.array(weights, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {q: [] for q, _, _ in asked}
        for batch in batches:
            ids, n = batch.column("id").to_pylist(), batch.column("n").to_numpy()
            lists = batch.column("terms")
            doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            term = np.array([names.get(w, -1) for w in lists.flatten().to_pylist()], np.int64)
            tf = batch.column("tfs").flatten().to_numpy()
            known = term >= 0
            if not known.any():
                continue
            block = Block(term[known], doc[known], tf[known], 25 + np.array([75 * int(x) * count // length for x in n], np.int64))
            for q, term, weight in asked:
                bounds, found = block.bounds(term, weight), best[q]
                order = np.argsort(-bounds, kind="stable")
                order = order[: np.count_nonzero(bounds)]
                while len(order):
                    if len(found) == k:
                        # Equal scores go by id, so a bound equal to the last score does not exclude.
                        order = order[bounds[order] >= found[0][0]]
                    now, order = order[:ROUND], order[ROUND:]
                    for d, score in zip(now, block.scores(term, weight, now)):
                        if score > 0:
                            # A document without an id is after all others of its score.
                            entry = (int(score), -ids[d] if ids[d] is not None else -np.inf)
                            if len(found) < k:
                                heapq.heappush(found, entry)
                            elif entry > found[0]:
                                heapq.heapreplace(found, entry)
        rows = [(q, None if place == -np.inf else -place, score) for q, found in best.items() for score, place in found]
        q, ids, scores = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["q", "id", "score"])
        release()

    return held.mapInArrow(run, "q bigint, id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text: str = "text") -> DataFrame:
    """``query, rank, id, score``: the ``k`` best documents of each query with a score above 0.

    Whole texts are searched and all documents counted; equal scores go by
    ascending id, a document without an id after the others. Null and empty texts,
    and queries without a term that a document holds, give no rows. Every row of
    ``queries`` is a query of its own, also where ids repeat or are null; rows of
    ``docs`` that repeat are documents of their own. Ids of documents are cast to
    long. Other columns are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession

    def make():
        def step(batch):
            counts = [Counter(terms(raw)) for raw in raw_texts(batch)]
            return {
                "q": np.repeat(batch.column("q").to_numpy(), [len(c) for c in counts]),
                "term": [w for c in counts for w in c],
                "repeats": [n for c in counts for n in c.values()],
            }

        return step

    # Numbered as written.
    numbered = queries.select(F.col(query_col).alias("query"), F.col(query_text).alias("text")).withColumn("q", F.monotonically_increasing_id())
    numbered = materialize(numbered, "queries")
    asked = materialize(map_arrow(numbered.select("q", "text"), "q bigint, term binary, repeats bigint", make), "asked")
    vocabulary = asked.select("term").distinct().limit(VOCABULARY + 1).collect()
    wanted = {bytes(r.term) for r in vocabulary} if len(vocabulary) <= VOCABULARY else None
    held = materialize(postings(docs, wanted, id_col, text_col), "postings")
    count, length = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weighted = materialize(_weights(held, asked, count), "weights")

    parts = max(1, -(-weighted.count() // PASS_TERMS))
    results = None
    for part in range(parts):
        mine = weighted.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == part)
        rows = mine.groupBy("q").agg(F.collect_list(F.struct("term", "w")).alias("x")).collect()
        block = [(r.q, [bytes(e.term) for e in r.x], [e.w for e in r.x]) for r in sorted(rows)]
        found = materialize(_search(held, block, k, count, max(1, length)), "found")
        results = found if results is None else results.unionByName(found)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("q", "query"), "q").select(F.col("query").alias(query_col), "rank", F.col("id").alias(id_col), "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
