"""Removal of byte strings that occur more than once, by suffix arrays.

Method: every window of 200 bytes chooses an anchor, the run of 64 bytes in it of
least hash, so equal windows choose equal anchors at equal places. Consecutive
windows of one anchor form a context. Only contexts whose anchor occurs twice can
hold a repeated window; equal ones are counted, and the different ones of an anchor
are compared by a suffix array: aligned at the anchor, they are cut where any two of
them part, each piece becomes a symbol, and the suffixes of all contexts of a task
are sorted by the linear grouping construction (:mod:`lotflow.llm.suffixes`). What a
suffix shares with its neighbours in order, in bytes, is what is repeated from there.

An anchor with more than LIMIT different contexts is cut into shorter ones around
common bytes, the last of them single windows, so no group is larger than that.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, raw_texts, table
from lotflow.llm.suffixes import longest_matches, suffix_array
from lotflow.llm.words import mix
from lotflow.session import materialize, scratch_path

#: Bytes of an anchor, windows of a text that are hashed at a time, different contexts of an anchor compared together.
ANCHOR, CHUNK, LIMIT = 64, 1 << 20, 4096
#: Windows of a context that is cut since its anchor has too many.
CUTS = (8, 1)
#: Symbols sorted together: a bound of memory, no group is split by it.
SYMBOLS = 200_000

_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(51)).integers(1, 1 << 63, 256, dtype=np.uint64)


def run_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every ``length`` consecutive bytes; ``length`` is a power of two."""
    h, n = _BYTES[data], 1
    while n < length:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
    return mix(h)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    rest = width - n
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def contexts(raw: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, anchor's place and hash of all contexts of a text, in order."""
    out = ([], [], [], [])
    mask = np.uint64((1 << 21) - 1)
    for begin in range(0, len(raw) - width + 1, CHUNK):
        h = run_hashes(np.frombuffer(raw, np.uint8, min(CHUNK + width - 1, len(raw) - begin), begin), ANCHOR)
        # The last of equal runs is taken: the choice depends on the window's bytes only.
        place = mask - np.arange(len(h), dtype=np.uint64)
        chosen = (mask - (sliding_min((h & ~mask) | place, width - ANCHOR + 1) & mask)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        for o, v in zip(out, (first + begin, np.diff(np.r_[first, len(chosen)]), chosen[first] + begin, h[chosen[first]].view(np.int64))):
            o.append(v)
    return tuple(np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)


def _parting(parts: list[bytes]) -> tuple[list[int], list[int]]:
    """How much each of ``parts`` shares with any other from its beginning, and all lengths at which two of them part."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    longest, cuts = [0] * len(parts), set()
    for i, j in zip(order, order[1:]):
        a, b = parts[i], parts[j]
        n = min(len(a), len(b))
        differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
        same = n - (differ.bit_length() + 7) // 8
        cuts.add(same)
        longest[i], longest[j] = max(longest[i], same), max(longest[j], same)
    return longest, sorted(cuts - {0})


def symbols_of(group: int, texts: list[bytes], anchors: list[int], names: dict, width: int) -> list[tuple[int, int, list[int], list[int]]]:
    """For each context that may repeat a window: its number, its first shared byte, its symbols and their bytes.

    Two contexts agree around the anchor from one cut to another, so equal pieces
    between cuts are equal symbols; ``names`` numbers the symbols.
    """
    right, right_cuts = _parting([t[a:] for t, a in zip(texts, anchors)])
    left, left_cuts = _parting([t[:a][::-1] for t, a in zip(texts, anchors)])
    out = []
    for i, (text, anchor) in enumerate(zip(texts, anchors)):
        if left[i] + right[i] < width:
            continue
        places = [-c for c in reversed(left_cuts) if c <= left[i]] + [0] + [c for c in right_cuts if c <= right[i]]
        pieces = [(group, z, text[anchor + a : anchor + z]) for a, z in zip(places, places[1:])]
        out.append((i, anchor + places[0], [names.setdefault(p, len(names)) for p in pieces], [len(p[2]) for p in pieces]))
    return out


def repeated_spans(parts: list[tuple[int, list[int], list[int]]], count: int, width: int) -> list[list[tuple[int, int]]]:
    """Per string (first byte, symbols, their bytes) the spans whose windows occur elsewhere, by one suffix array of all strings."""
    text, sizes, begins = [], [], []
    for number, (_, symbols, bytes_of) in enumerate(parts):
        begins.append(len(text))
        # A symbol of its own ends each string.
        text += [s + 1 for s in symbols] + [count + 1 + number]
        sizes += bytes_of + [0]
    text.append(0)
    matches = longest_matches(text, suffix_array(text, count + 1 + len(parts)))
    end = np.r_[0, np.cumsum(sizes)].tolist()
    out = []
    for begin, (first, symbols, _) in zip(begins, parts):
        spans: list[tuple[int, int]] = []
        for i in range(begin, begin + len(symbols)):
            a, z = first + end[i] - end[begin], first + end[i + matches[i]] - end[begin]
            if z - a >= width:
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(z, spans[-1][1]))
                else:
                    spans.append((a, z))
        out.append(spans)
    return out


def _compared(groups: DataFrame, width: int) -> DataFrame:
    """``h, c, a, z``: repeated spans of the contexts that occur once, per anchor's list of different contexts."""

    def make():
        def solve(pending, names):
            out = {"h": [], "c": [], "a": [], "z": []}
            if pending:
                for (h, c, n, *_), spans in zip(pending, repeated_spans([p[3:] for p in pending], len(names), width)):
                    for a, z in spans if n == 1 else ():
                        for k, v in zip(out, (h, c, a, z)):
                            out[k].append(v)
            return out

        def step(batch):
            pending, names, total = [], {}, 0
            for h, rows in zip(batch.column("h").to_pylist(), batch.column("rows").to_pylist()):
                rows.sort(key=lambda r: r["c"])
                for i, first, symbols, sizes in symbols_of(h, [r["ctx"] for r in rows], [r["off"] for r in rows], names, width):
                    pending.append((h, rows[i]["c"], rows[i]["n"], first, symbols, sizes))
                    total += len(symbols) + 1
                if total >= SYMBOLS:
                    yield solve(pending, names)
                    pending, names, total = [], {}, 0
            yield solve(pending, names)

        return step

    return map_arrow(groups, "h bigint, c bigint, a bigint, z bigint", make)


def _cut(found: DataFrame, windows: int, width: int) -> DataFrame:
    """``h, c, off, ctx, r, n`` of shorter contexts, with the context ``oh, oc`` they come from and their place ``at`` there.

    Cells of ``windows`` places before the anchor; the bytes that all windows of a
    cell have in common name the new anchor.
    """

    def make():
        def step(batch):
            out = {k: [] for k in ("h", "off", "ctx", "oh", "oc", "at", "n")}
            for h, c, off, ctx, n in zip(*(batch.column(k).to_pylist() for k in ("h", "c", "off", "ctx", "n"))):
                last = len(ctx) - width
                for cell in range(-off // windows, (last - off) // windows + 1):
                    low, high = off + cell * windows, off + cell * windows + windows - 1
                    a, z = max(low, 0), min(high, last)
                    core = hashlib.blake2b(b"%d %d " % (h, cell) + ctx[high : low + width], digest_size=8).digest()
                    new = (int.from_bytes(core, "big", signed=True), off - a, ctx[a : z + width], h, c, a, n)
                    for k, v in zip(out, new):
                        out[k].append(v)
            return out

        return step

    ddl = "h bigint, off int, ctx binary, oh bigint, oc bigint, at bigint, n bigint"
    rows = map_arrow(found.select("h", "c", "off", "ctx", "n"), ddl, make)
    return rows.withColumns({"c": F.xxhash64("off", "ctx"), "r": F.xxhash64("oh", "oc", "at")})


def _covered(rows: DataFrame, cuts: tuple[int, ...], width: int, limit: int) -> DataFrame:
    """``h, c, a, z``: the spans of contexts ``h, c`` whose windows occur more than once.

    ``rows(h, c, off, ctx, r, n)``: contexts that occur ``n`` times, named ``r``; equal ones have equal ``h, c``.
    """
    kinds = rows.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min("r").alias("r"), F.min(F.length("ctx")).alias("size"))
    kinds = materialize(kinds, "contexts")
    whole = kinds.where("n > 1").select("h", "c", F.lit(0).cast("bigint").alias("a"), F.col("size").cast("bigint").alias("z"))
    # An anchor needs two different contexts, and one that is not settled yet.
    groups = kinds.groupBy("h").agg(F.count("*").alias("d"), F.min("n").alias("least")).where("d > 1 AND least = 1")
    kinds = kinds.join(groups.select("h", "d"), "h").select("h", "c", "r", F.col("n").alias("m"), "d")
    firsts = _written(rows.join(kinds, ["h", "c", "r"]).select("h", "c", "off", "ctx", F.col("m").alias("n"), "d"), "compared")
    lists = firsts.where(F.col("d") <= limit).groupBy("h").agg(F.collect_list(F.struct("c", "off", "ctx", "n")).alias("rows"))
    out = whole.union(_compared(lists, width))
    wide = firsts.where(F.col("d") > limit)
    if cuts and not wide.isEmpty():
        cells = _written(_cut(wide, cuts[0], width), "cells")
        inner = _covered(cells.select("h", "c", "off", "ctx", "r", "n"), cuts[1:], width, limit)
        back = cells.select("h", "c", "oh", "oc", "at").join(inner, ["h", "c"])
        out = out.union(back.select("oh", "oc", F.col("at") + F.col("a"), F.col("at") + F.col("z")))
    return out


def _written(df: DataFrame, name: str) -> DataFrame:
    """As ``materialize``, packed closer: contexts overlap."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _merged(spans: DataFrame) -> DataFrame:
    """``x, spans``: the maximal runs of ``x, a, z`` in order; runs that touch are one."""
    spans = spans.withColumn("far", F.expr("max(z) OVER (PARTITION BY x ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    new = F.coalesce(F.col("a") > F.col("far"), F.lit(True)).cast("int")
    spans = spans.withColumn("new", new).withColumn("run", F.expr("sum(new) OVER (PARTITION BY x ORDER BY a, z ROWS UNBOUNDED PRECEDING)"))
    runs = spans.groupBy("x", "run").agg(F.min("a").alias("a"), F.max("z").alias("z"))
    return runs.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("a", "z"))).alias("spans"))


def repeated(texts: DataFrame, width: int = 200, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """``x, spans`` of texts that occur once and hold repeated bytes; ``x`` of those that occur more often.

    ``texts(x, text)``: texts named by ``x``, of ``width`` bytes or more.
    """
    copies = texts.groupBy("x").count().where("count > 1").select("x")

    def hashes():
        def step(batch):
            return {"x": batch.column("x"), "hs": [contexts(raw, width)[3] for raw in raw_texts(batch)]}

        return step

    named = map_arrow(texts, "x binary, hs array<bigint>", hashes).dropDuplicates(["x"])
    named = materialize(named.withColumn("t", F.monotonically_increasing_id()), "anchors")
    held = named.select("t", F.explode("hs").alias("h"))
    twice = held.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n")).where("n > 1").select("h")
    places = named.select("t", F.posexplode("hs").alias("place", "h")).join(materialize(twice, "twice"), "h", "left_semi")
    places = places.groupBy("t").agg(F.collect_list("place").alias("places"))
    wanted = materialize(named.select("t", "x").join(places, "t").select("x", "t", "places"), "wanted")
    once = texts.join(wanted.select("x"), "x", "left_semi").groupBy("x").agg(F.first("text").alias("text"))

    def cut():
        def step(batch):
            for t, places, raw in zip(batch.column("t").to_pylist(), batch.column("places").to_pylist(), raw_texts(batch)):
                first, count, anchor, h = (v[np.sort(places)] for v in contexts(raw, width))
                yield {
                    "t": np.full(len(first), t),
                    "start": first,
                    "off": anchor - first,
                    "h": h,
                    "ctx": [raw[a : a + n + width - 1] for a, n in zip(first.tolist(), count.tolist())],
                }

        return step

    rows = map_arrow(once.join(wanted, "x").select("t", "places", "text"), "t bigint, start bigint, off int, h bigint, ctx binary", cut)
    rows = _written(rows.withColumns({"c": F.xxhash64("off", "ctx"), "r": F.xxhash64("t", "start"), "n": F.lit(1).cast("bigint")}), "contexts")
    spans = _covered(rows.select("h", "c", "off", "ctx", "r", "n"), CUTS, width, limit)
    spans = rows.select("t", "start", "h", "c").join(materialize(spans, "spans"), ["h", "c"])
    spans = spans.select(F.col("t").alias("x"), (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("z")).alias("z"))
    merged = _merged(spans).withColumnRenamed("x", "t").join(wanted.select("t", "x"), "t")
    return merged.join(copies, "x", "left_anti").select("x", "spans"), copies


def remove_repeats(docs: DataFrame, width: int = 200, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row.

    Every byte of a text that lies in a string of ``width`` bytes (128 or more)
    which also starts elsewhere, in the same text or another, is removed; ``spans``
    are the maximal runs of such bytes. Null texts are empty; shorter texts lose
    nothing. Rows with equal texts are occurrences of their own: each loses all.
    Repeated and null ids keep their rows, other columns are left out, an empty
    table gives no rows. ``limit``: different contexts of an anchor that are
    compared in one task; more are cut further, with the same result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("kept"))
    texts = rows.where(F.col("n_bytes") >= width).select(F.unhex("kept").alias("x"), "text")
    spans, copies = repeated(texts, width, limit)

    def keep():
        def step(batch):
            kept = []
            for raw, spans in zip(raw_texts(batch), batch.column("spans").to_pylist()):
                digest, at = hashlib.sha256(), 0
                for s in spans:
                    digest.update(raw[at : s["a"]])
                    at = s["z"]
                digest.update(raw[at:])
                kept.append(digest.hexdigest())
            return {"x": batch.column("x"), "spans": batch.column("spans"), "rest": kept}

        return step

    kind = "array<struct<a:bigint,z:bigint>>"
    cut = map_arrow(texts.join(materialize(spans, "runs"), "x"), f"x binary, spans {kind}, rest string", keep)
    cut = cut.unionByName(copies.select("x", F.lit(None).cast(kind).alias("spans"), F.sha2(F.lit(""), 256).alias("rest")))
    cut = materialize(cut.withColumn("hit", F.lit(True)), "cut")
    out = rows.select("id", "n_bytes", "kept", F.when(F.col("n_bytes") >= width, F.unhex("kept")).alias("x")).join(cut, "x", "left")
    every = F.array(F.struct(F.lit(0).cast("bigint").alias("a"), F.col("n_bytes").alias("z")))
    runs = F.when(F.col("hit"), F.coalesce("spans", every)).otherwise(F.array().cast(kind))
    out = out.select("id", "n_bytes", F.coalesce("rest", "kept").alias("kept_sha256"), runs.alias("spans"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["z"] - s["a"])
    return out.select(F.col("id").alias(id_col), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "spans")


def op12_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes removed from all documents."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
