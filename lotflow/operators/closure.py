"""All paths of a graph of orders by doubling: longest paths, reach, and coefficients.

A round joins the paths that are known with each other, so a graph of depth d is
done in about log2(d) rounds. The result has one row per pair of orders with a
path; orders with too many others before them are left out, and callers walk
that part of the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lotflow.session import materialize

#: Length of a path that leads through a cycle: there is no longest one.
ENDLESS = 1 << 40
#: Pairs up to which paths are doubled: this many, or a multiple of the links.
PAIRS, PER_LINK = 1_000_000, 8


def stored(df: DataFrame, name: str, **counts) -> tuple[DataFrame, dict]:
    """``df`` written once, and numbers taken along the way."""
    seen = Observation()
    written = materialize(df.observe(seen, *[c.alias(k) for k, c in counts.items()]), name)
    return written, {k: v or 0 for k, v in seen.get.items()}


def unseen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """The orders of ``rows`` that are not in ``seen``. ``rows`` is written and mostly few, so ``seen`` is scanned where it lies."""
    return rows.join(seen.join(rows.select("aufnr"), "aufnr", "left_semi"), "aufnr", "left_anti")


def longest_paths(links: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``u, v, w``: the length of the longest path from ``u`` to ``v``, for every pair with a path; and the nodes left out.

    ``w`` is ENDLESS where paths lead through a cycle; ``(u, u)`` is there for the
    orders on one. ``links(u, v)``: no nulls, repeats allowed. Round k knows all
    paths of up to 2**k links; the next one extends those that round k changed,
    ``since`` tells which. If there are more than ``most`` pairs, nodes with many
    others before them (large cycles, above all) are left out as ``v``, with all
    that lies behind them, and returned as a table ``v``, written out; the other nodes have
    all their pairs. The second result is None if no node was left out.
    """
    first = links.select("u", "v").distinct().select("u", "v", _length(F.lit(1)).alias("w"), F.lit(0).alias("since"))
    paths, seen = stored(first, "paths", n=F.count(F.lit(1)))
    most = most or max(PAIRS, PER_LINK * seen["n"])
    turn, new, wide = 0, seen["n"], None
    while new:
        if seen["n"] > most or _next_size(paths, turn) > 4 * most:
            found, paths, seen = _without_wide(paths, turn, most)
            wide = found if wide is None else wide.unionByName(found)
        changed = paths.where(F.col("since") == turn)
        front = changed.select("u", F.col("v").alias("m"), F.col("w").alias("w1"))
        back = paths.select(F.col("u").alias("m"), "v", F.col("w").alias("w2"))
        found = front.join(back, "m")
        # A path that turned endless makes those endless that end where it begins.
        endless = changed.where(F.col("w") == ENDLESS).select(F.col("u").alias("m"), "v", F.col("w").alias("w2"))
        found = found.unionByName(paths.select("u", F.col("v").alias("m"), F.col("w").alias("w1")).join(endless, "m"))
        turn += 1
        longer = found.select("u", "v", _length(F.col("w1") + F.col("w2")).alias("w"), F.lit(turn).alias("since"))
        # Of equal lengths the one known before stays, so its row does not count as changed.
        best = F.max(F.struct("w", (-F.col("since")).alias("s")))
        merged = paths.unionByName(longer).groupBy("u", "v").agg(best.alias("x"))
        merged = merged.select("u", "v", F.col("x.w").alias("w"), (-F.col("x.s")).alias("since"))
        paths, seen = stored(merged, "paths", n=F.count(F.lit(1)), new=F.count_if(F.col("since") == turn))
        new = seen["new"]
    return paths.drop("since"), wide


def _next_size(paths: DataFrame, turn: int) -> int:
    """Rows that the next round joins, counted before it does."""
    ends = paths.where(F.col("since") == turn).groupBy(F.col("v").alias("m")).agg(F.count(F.lit(1)).alias("a"))
    begins = paths.groupBy(F.col("u").alias("m")).agg(F.count(F.lit(1)).alias("b"))
    return ends.join(begins, "m").agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0


def _without_wide(paths: DataFrame, turn: int, most: int) -> tuple[DataFrame, DataFrame, dict]:
    """The nodes with more than their share of ``most`` pairs before them and all behind these; the paths to other nodes."""
    before = materialize(paths.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "before")
    share = max(1, most // max(1, before.count()))
    wide = new = materialize(before.where(F.col("n") > share).select("v"), "wide")
    while not new.isEmpty():
        # A step spans 2**turn links.
        behind = paths.join(new.withColumnRenamed("v", "u"), "u", "left_semi").select("v").distinct()
        new = materialize(behind.join(wide, "v", "left_anti"), "wide")
        wide = wide.unionByName(new)
    kept, seen = stored(paths.join(wide, "v", "left_anti"), "paths", n=F.count(F.lit(1)))
    return wide, kept, seen


def _length(total):
    """A path that returns to its beginning is endless, as is one with an endless part."""
    return F.when(F.col("u") == F.col("v"), ENDLESS).otherwise(F.least(total, F.lit(ENDLESS))).cast("long")


def coefficients(factors: DataFrame) -> DataFrame:
    """``u, v, c``: how much of ``v`` goes into ``u`` over all paths, by squaring of the sparse matrix ``factors(u, v, f)``.

    Products along paths, summed over paths: F + F² + F³ + ...; a round doubles the number of
    summands. Several rows of a pair add up. The graph has no cycles.
    """
    power = materialize(factors.groupBy("u", "v").agg(F.sum("f").alias("c")), "power")
    total = power
    times = lambda a, b: (
        a.select("u", F.col("v").alias("m"), F.col("c").alias("a"))
        .join(b.select(F.col("u").alias("m"), "v", F.col("c").alias("b")), "m")
        .groupBy("u", "v")
        .agg(F.sum(F.col("a") * F.col("b")).alias("c"))
    )
    while True:
        more = total.unionByName(times(power, total)).groupBy("u", "v").agg(F.sum("c").alias("c"))
        total = materialize(more, "total")
        power, seen = stored(times(power, power), "power", n=F.count(F.lit(1)), loop=F.count_if(F.col("u") == F.col("v")))
        if seen["loop"]:
            raise ValueError("the graph has a cycle: level the orders first")
        if not seen["n"]:
            return total
