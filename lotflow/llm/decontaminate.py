"""Benchmark decontamination by winnowing.

Method: of every ``window`` consecutive words the smallest hash of their runs of
``gram`` words is kept as its fingerprint; neighbouring windows mostly keep the
same one. Fingerprints of documents and benchmark are joined and every hit is
extended to the windows that keep it. A window kept by both sides has the same
smallest run on both sides, so every shared span of ``window`` words or more is
found. Benchmark texts with fewer words are one window with its own fingerprint.

A benchmark of at most ``broadcast_windows`` windows (24 bytes each) is sent to
all tasks and looked up there; a larger one is joined by shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotflow.llm.common import append, map_arrow, sha, table
from lotflow.llm.words import SIGN_CUT, runs, word_chunks
from lotflow.session import materialize

WINDOW, GRAM = 13, 8
#: Windows of a benchmark that may be sent to every task: 96 MB.
BROADCAST_WINDOWS = 4_000_000


def windows(hashes: np.ndarray, bounds: np.ndarray, n: int, window: int, gram: int):
    """Places, fingerprints and hashes of all windows of ``n`` words that lie within one text."""
    whole = runs(hashes, n)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if not len(whole):
        return np.zeros(0, np.int64), whole, whole
    inside = np.flatnonzero(owner[: len(whole)] == owner[n - 1 :])
    if n < window:
        return inside, whole[inside], whole[inside]
    grams, keep = runs(hashes, gram), n - gram + 1
    least = grams[: len(whole)].copy()
    for i in range(1, keep):
        np.minimum(least, grams[i : i + len(whole)], out=least)
    return inside, least[inside], whole[inside]


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """``n, fp, win, item`` of all windows of the benchmark; a text of fewer words is one window."""

    def make():
        def step(batch):
            out = {"n": [], "fp": [], "win": [], "item": []}
            items = batch.column("item").to_pylist()
            for begin, hashes, bounds in word_chunks(batch.column("text"), SIGN_CUT):
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    if a < b:
                        n = min(window, int(b - a))
                        _, fp, win = windows(hashes[a:b], np.array([0, b - a]), n, window, gram)
                        out["n"].append(np.full(len(fp), n))
                        out["fp"].append(fp)
                        out["win"].append(win)
                        out["item"] += [items[begin + k]] * len(fp)
            for name, kind in (("n", np.int32), ("fp", np.uint64), ("win", np.uint64)):
                joined = np.concatenate(out[name]) if out[name] else np.zeros(0, kind)
                out[name] = joined.astype(kind).view(np.int64 if kind is np.uint64 else kind)
            return out

        return step

    rows = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return map_arrow(rows, "n int, fp bigint, win bigint, item bigint", make).distinct()


class Index:
    """All windows of a benchmark of bounded size, for look-up in a task."""

    def __init__(self, rows: pa.Table):
        n = rows["n"].to_numpy()
        self.lengths = sorted(set(n.tolist()), reverse=True)
        self.sets = {}
        for length in self.lengths:
            pick = n == length
            win = rows["win"].to_numpy()[pick].view(np.uint64)
            item = rows["item"].combine_chunks().fill_null(NO_ID).to_numpy()[pick]
            order = np.lexsort((item, win))
            bits = np.zeros(1 << 20, bool)
            bits[rows["fp"].to_numpy()[pick].view(np.uint64) >> np.uint64(44)] = True
            fps = np.unique(rows["fp"].to_numpy()[pick].view(np.uint64))
            self.sets[length] = bits, fps, win[order], item[order]

    def hits(self, hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int):
        """Place, length and the range of items of every window that the benchmark has."""
        for n in self.lengths:
            bits, fps, wins, items = self.sets[n]
            at, fp, win = windows(hashes, bounds, n, window, gram)
            kept = np.flatnonzero(bits[fp >> np.uint64(44)])
            kept = kept[fps[np.minimum(np.searchsorted(fps, fp[kept]), len(fps) - 1)] == fp[kept]]
            low, high = np.searchsorted(wins, win[kept], "left"), np.searchsorted(wins, win[kept], "right")
            for k in np.flatnonzero(low < high):
                yield int(at[kept[k]]), n, items[low[k] : high[k]]


#: Stands for a null item id, which is never listed.
NO_ID = -(1 << 63)
RESULT = "n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<begin:bigint,end:bigint>>"


def _find_here(docs: DataFrame, index: Index, window: int, gram: int, text_col: str) -> DataFrame:
    def make():
        def step(batch):
            out = {"n_words": [], "n_hit": [], "items": [], "spans": []}
            for _, hashes, bounds in word_chunks(batch.column(text_col), SIGN_CUT):
                found: dict[int, list] = {}
                for at, n, items in index.hits(hashes, bounds, window, gram):
                    found.setdefault(int(np.searchsorted(bounds, at, "right")) - 1, []).append((at, at + n, items))
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    spans: list[list[int]] = []
                    for begin, end, _ in sorted(found.get(k, []), key=lambda x: x[:2]):
                        if spans and begin - a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], end - a)
                        else:
                            spans.append([begin - a, end - a])
                    out["n_words"].append(b - a)
                    out["n_hit"].append(sum(e - s for s, e in spans))
                    out["items"].append(sorted({int(i) for x in found.get(k, []) for i in x[2]} - {NO_ID}))
                    out["spans"].append([{"begin": s, "end": e} for s, e in spans])
            return out

        return step

    found = append(docs, RESULT, make)
    return found.select("row", "out")


def _find_joined(docs: DataFrame, bench: DataFrame, lengths: list[int], window: int, gram: int, text_col: str) -> DataFrame:
    """The same by shuffles: once per distinct text, keyed by its digest."""

    def make():
        def step(batch):
            out = {"digest": [], "n_words": [], "n": [], "at": [], "fp": [], "wins": []}
            digests = batch.column("digest").to_pylist()
            for begin, hashes, bounds in word_chunks(batch.column("text"), SIGN_CUT):
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    count = 0
                    for n in lengths:
                        at, fp, win = windows(hashes[a:b], np.array([0, b - a]), n, window, gram)
                        if len(at):
                            cut = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]])
                            for i, j in zip(cut, np.r_[cut[1:], len(at)]):
                                out["n"].append(n)
                                out["at"].append(int(at[i]))
                                out["fp"].append(int(fp[i : i + 1].view(np.int64)[0]))
                                out["wins"].append(win[i:j].view(np.int64))
                            count += len(cut)
                    for name, value in (("digest", digests[begin + k]), ("n_words", int(b - a))):
                        out[name] += [value] * max(count, 1)
                    if not count:
                        for name in ("n", "at", "fp", "wins"):
                            out[name].append(None)
            return out

        return step

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct("*").alias("row"), sha(text).alias("digest"))
    distinct = docs.select(sha(text).alias("digest"), text.alias("text")).dropDuplicates(["digest"])
    prints = materialize(map_arrow(distinct, "digest binary, n_words bigint, n int, at bigint, fp bigint, wins array<bigint>", make), "prints")
    hits = prints.join(bench, ["n", "fp"]).select("digest", "n", "item", "win", "at", F.posexplode("wins").alias("k", "own")).where("own = win")
    hits = hits.select("digest", "item", (F.col("at") + F.col("k")).alias("begin"), (F.col("at") + F.col("k") + F.col("n")).alias("end"))
    items = hits.groupBy("digest").agg(F.sort_array(F.collect_set("item")).alias("items"))
    order = W.partitionBy("digest").orderBy("begin", "end")
    spans = hits.select("digest", "begin", "end").distinct()
    spans = spans.withColumn("reach", F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)))
    spans = spans.withColumn("part", F.sum((F.col("reach").isNull() | (F.col("begin") > F.col("reach"))).cast("int")).over(order))
    spans = spans.groupBy("digest", "part").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    spans = spans.groupBy("digest").agg(F.sum(F.col("end") - F.col("begin")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    words = prints.groupBy("digest").agg(F.max("n_words").alias("n_words"))
    found = words.join(items, "digest", "left").join(spans, "digest", "left")
    none = F.from_json(F.lit("[]"), "array<bigint>"), F.from_json(F.lit("[]"), "array<struct<begin:bigint,end:bigint>>")
    out = F.struct("n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none[0]).alias("items"), F.coalesce("spans", none[1]).alias("spans"))
    return keyed.join(found.select("digest", out.alias("out")), "digest").select("row", "out")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, text_col: str = "text", item_col: str = "item_id", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``out``: word count, words hit, items and merged word spans.

    Null texts have no words; items without words have no window; windows that
    several items share count for each of them; an item without an id hits words,
    but is not listed. Repeated rows keep their own
    results. An empty benchmark hits nothing, an empty table gives no rows.
    """
    bench = materialize(benchmark_windows(benchmark, item_col, "text", window, gram), "benchmark-windows")
    if bench.count() <= broadcast_windows:
        return _find_here(docs, Index(bench.toArrow()), window, gram, text_col)
    lengths = [r[0] for r in bench.select("n").distinct().collect()]  # at most `window` of them
    return _find_joined(docs, bench, lengths, window, gram, text_col)


def contaminated(share: int = 20):
    """Whether at least one word in ``share`` is hit."""
    return (F.col("out.n_hit") > 0) & (share * F.col("out.n_hit") >= F.col("out.n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of which fewer than one word in twenty lies in benchmark windows, unchanged."""
    return find_contamination(docs, benchmark).where(~contaminated()).select("row.*")


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark hits of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("out.items", lambda i: i.cast("string"))), ",")
    return found.select("row.doc_id", "out.n_words", "out.n_hit", F.size("out.items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), contaminated().alias("contaminated"))
