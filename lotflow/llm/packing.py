"""Best-fit packing of token sequences, refined by a swap-based local search.

Method: pieces are dealt at random to groups of bounded size and every group is
packed best-fit decreasing. Then pieces are moved between underfull bins, and
exchanged one for one, two for one and one for two, whenever that raises the sum
of squared fills, so that the emptiest bins empty. The underfull bins that are
left over go to a second pass, dealt anew, until a pass saves no bin.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, table, texts
from lotflow.llm.tokens import encoder, public
from lotflow.session import materialize

#: Pieces of one group; it bounds the memory and time of a packing task.
GROUP = 4096
PIECES = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """The pieces of every document: its ids, then id 0, cut at multiples of ``capacity``."""

    def make():
        encode = encoder(tokenizer).encode

        def step(batch):
            out = {k: [] for k in ("id", "piece", "start", "length", "ids_crc32")}
            for key, ids in zip(batch.column("id").to_pylist(), encode(texts(batch))):
                ids += b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for k, v in zip(out, (key, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[k].append(v)
            return out

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, PIECES, make)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, the pieces in descending order of size, each into the fullest bin that takes it."""
    bins = np.zeros(len(sizes), dtype=np.int64)
    room: list[tuple[int, int]] = []
    count = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b, count = capacity, count, count + 1
        bins[i] = b
        if left > size:
            insort(room, (left - size, b))
    return bins


def local_search(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Empty bins by exchanges that raise the sum of squared fills.

    The emptiest underfull bin that has not failed is the source. Each step takes
    the largest gain among moving a piece or two and exchanging one or two for
    one, or else one for two. Every step raises the sum of squares, which is
    bounded. All bins may be sources again after one was emptied, and after all
    have failed with steps on the way. The search ends when the bins are as few
    as the sum of sizes allows, or when no underfull bin has a step left.
    """
    bins = bins.copy()
    fill = np.bincount(bins, weights=sizes).astype(np.int64)
    least = -(-int(sizes.sum()) // capacity)
    failed: set[int] = set()
    stepped = False
    while np.count_nonzero(fill) > least:
        source = next((int(b) for b in np.argsort(fill, kind="stable") if 0 < fill[b] < capacity and b not in failed), None)
        if source is None:
            if not stepped:
                break
            failed.clear()
            stepped = False
            continue
        failed.add(source)
        pieces = _Pieces(sizes, bins, capacity)
        while fill[source] and (step := _best_step(pieces, fill, source)):
            out, back, target = step
            bins[out], bins[back] = target, source
            moved = int(sizes[out].sum() - sizes[back].sum())
            fill[target] += moved
            fill[source] -= moved
            pieces, stepped = _Pieces(sizes, bins, capacity), True
        if not fill[source]:
            failed.clear()
    return bins


class _Pieces:
    """Pieces in order of bin and size, with keys that are searched by bisection."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int):
        self.capacity, self.order = capacity, np.lexsort((sizes, bins))
        self.bins, self.sizes = bins[self.order], sizes[self.order]
        self.keys = self.bins * (capacity + 1) + self.sizes

    def first(self, bins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of the smallest pieces of these bins that are not below these sizes; another bin's if there is none."""
        return np.searchsorted(self.keys, bins * (self.capacity + 1) + sizes)


def _outs(own: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct sums of one or two of the own pieces, at most as many as the capacity, and pieces for each."""
    one, at = np.unique(size, return_index=True)
    first, second = np.triu_indices(len(own), 1)
    two, place = np.unique(size[first] + size[second], return_index=True)
    new = np.isin(two, one, invert=True)
    pieces = [own[[i]] for i in at] + [own[[first[i], second[i]]] for i in place[new]]
    return np.concatenate([one, two[new]]), pieces


def _best_step(pieces: _Pieces, fill: np.ndarray, source: int):
    """The pieces that leave the source, those that come back, and the other bin; None if nothing raises the squares.

    Moving ``d`` tokens from fill ``s`` to fill ``t`` raises them by ``2d(t - s + d)``,
    the more the larger ``d`` is, so each bin gives back the least that makes room.
    """
    begin, end = np.searchsorted(pieces.bins, [source, source + 1])
    own, own_size = pieces.order[begin:end], pieces.sizes[begin:end]
    targets = np.flatnonzero((fill > 0) & (fill < pieces.capacity))
    targets = targets[targets != source]
    if not len(targets):
        return None
    room, full, none = pieces.capacity - fill, fill - fill[source], np.zeros(0, np.int64)
    sums, outs = _outs(own, own_size)
    best, chosen, last = 0, None, len(pieces.keys) - 1
    step = max(1, 1_000_000 // len(targets))
    for a in range(0, len(sums), step):
        size, over = sums[a : a + step, None], sums[a : a + step, None] - room[targets]
        at = pieces.first(targets, np.maximum(over, 0))
        back = np.where(over <= 0, 0, pieces.sizes[np.minimum(at, last)])
        moved = size - back
        right = (over <= 0) | (at <= last) & (pieces.bins[np.minimum(at, last)] == targets)
        gain = np.where(right & (moved > 0), 2 * moved * (full[targets] + moved), 0)
        k, t = divmod(int(np.argmax(gain)), len(targets))
        if gain[k, t] > best:
            best = int(gain[k, t])
            chosen = outs[a + k], none if over[k, t] <= 0 else pieces.order[at[k, t : t + 1]], int(targets[t])
    if chosen is not None:
        return chosen
    held = np.flatnonzero(np.isin(pieces.bins, targets))
    bin_of, size_of = pieces.bins[held], pieces.sizes[held]
    for size, piece in zip(sums, outs):
        if len(piece) > 1:
            break
        at = np.maximum(pieces.first(bin_of, np.maximum(size - room[bin_of] - size_of, 0)), held + 1)
        other = np.minimum(at, last)
        moved = size - size_of - pieces.sizes[other]
        right = (at <= last) & (pieces.bins[other] == bin_of) & (moved > 0) & (moved <= room[bin_of])
        gain = np.where(right, 2 * moved * (full[bin_of] + moved), 0)
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, chosen = int(gain[k]), (piece, pieces.order[[held[k], at[k]]], int(bin_of[k]))
    return chosen


def pack_group(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bins of one group's pieces, numbered from 0 without gaps."""
    bins = local_search(sizes, best_fit(sizes, capacity), capacity)
    return np.unique(bins, return_inverse=True)[1]


def _pack(items: DataFrame, n: int, capacity: int, group_size: int, keep: float) -> DataFrame:
    """``items`` with ``bin`` (unique over groups), ``offset`` and ``full``: its bin is filled to ``keep`` at least."""
    groups = max(1, -(-n // group_size))
    schema = items.schema.fields
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", bin bigint, offset bigint, full boolean"
    names = [f.name for f in schema]

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.select(names).sort_by([("length", "descending"), ("row", "ascending")])
        sizes = rows["length"].to_numpy().astype(np.int64)
        bins = pack_group(sizes, capacity)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        offset = np.empty(len(bins), dtype=np.int64)
        offset[order] = np.cumsum(sizes[order]) - sizes[order] - (np.cumsum(fill) - fill)[bins[order]]
        new = {"bin": bins + (key[0].as_py() << 32), "offset": offset, "full": fill[bins] >= keep * capacity}
        for name, values in new.items():
            rows = rows.append_column(name, pa.array(values))
        return rows

    dealt = items.withColumn("g", F.pmod(F.xxhash64("row", F.lit(groups)), F.lit(groups)))
    return dealt.groupBy("g").applyInArrow(pack, ddl)


def pack_pieces(pieces: DataFrame, capacity: int = 2048, group_size: int = GROUP, passes: int = 3) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Pieces of full length are sequences of their own. Of each pass the bins filled
    to 0.98 are final; the pieces of the rest, if they fill more than one group or
    bin, are dealt and packed again, in groups that mix all parts of the corpus.
    """
    pieces = materialize(pieces, "pieces")
    full = pieces.where(F.col("length") == capacity)
    full = full.withColumns({"bin": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "pass": F.lit(0)})
    # Numbered over written files, so that a repeated task deals the same rows to the same groups.
    rest = pieces.where(F.col("length") < capacity).withColumn("row", F.monotonically_increasing_id())
    done, n = [full], rest.count()
    for turn in range(1, passes + 1):
        packed = materialize(_pack(rest, n, capacity, group_size, 0.98), "packed").withColumn("pass", F.lit(turn))
        left = packed.where(~F.col("full"))
        n_left = left.count() if n > group_size and turn < passes else 0
        if not n_left or n_left > 0.9 * n and turn > 1:
            done.append(packed.drop("row", "full"))
            break
        done.append(packed.where("full").drop("row", "full"))
        rest, n = left.drop("bin", "offset", "full", "pass"), n_left
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumn("sequence_id", F.col("pass") * F.lit(1 << 60) + F.col("bin")).drop("bin", "pass")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", group_size: int = GROUP) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are the single id 0. Only documents longer than
    ``capacity`` are cut. Rows with equal ids are packed apart; null ids stay null;
    other columns are left out. An empty table gives no rows.
    """
    packed = pack_pieces(cut_pieces(docs, tokenizer, capacity, id_col, text_col), capacity, group_size)
    return packed.withColumnRenamed("id", id_col)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), public("word_bpe_49k.json"))
