"""The graph of production orders: who consumes whose batches, and how deep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.functions.scalars import BLANK, present
from lotflow.operators.closure import ENDLESS, longest_paths, stored, unseen
from lotflow.operators.monthend import closing_status
from lotflow.session import materialize

CYCLIC = "cyclic"
#: Rounds of peeling after which what they passed on is added up.
MERGE_AFTER = 16


def reset_orders(aufkx: DataFrame) -> DataFrame:
    """Every order that is not done starts over: blank state, level 0."""
    done = F.col("xstat") == "X"
    return aufkx.withColumn("bomlv", F.when(done, F.col("bomlv")).otherwise(0)).withColumn(
        "xstat", F.when(done, F.col("xstat")).otherwise(BLANK)
    )


def order_edges(aufm: DataFrame, jest: DataFrame, first_receipt: DataFrame) -> DataFrame:
    """Closed orders with postings, and the orders that produced the posted batches.

    ``submo`` is NULL where the batch has no producer or the order made it itself.
    Postings pass one shuffle by batch and one by order, which also makes their
    edges distinct.
    """
    closed = closing_status(jest.where(F.col("objnr").startswith("OR"))).withColumn("aufnr", F.expr("substring(objnr, 3)"))
    producer = first_receipt.where(present(F.col("aufnr"))).select("matnr", "charg", F.col("aufnr").alias("submo"))
    return (
        aufm.select("aufnr", "matnr", "charg")
        .join(producer, ["matnr", "charg"], "left")
        .select("aufnr", F.when(F.col("submo") != F.col("aufnr"), F.col("submo")).alias("submo"))
        .join(closed, "aufnr")
        .select("aufnr", "stat", "chgnr", "submo")
        .distinct()
    )


def correct_edges(edges: DataFrame, aufm: DataFrame, jest: DataFrame, first_receipt: DataFrame, changed: DataFrame) -> DataFrame:
    """``edges`` after ``changed`` index rows: those of the orders that post a changed batch are derived again, no others."""
    consumers = aufm.join(changed.select("matnr", "charg"), ["matnr", "charg"], "left_semi").select("aufnr").distinct()
    again = order_edges(aufm.join(consumers, "aufnr", "left_semi"), jest, first_receipt)
    return edges.join(consumers, "aufnr", "left_anti").unionByName(again)


def _successors(orders: DataFrame, links: DataFrame) -> DataFrame:
    return orders.join(links, "aufnr").select(F.col("submo").alias("aufnr")).distinct()


def endless_orders(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """Orders reachable from ``seeds`` that lie on a cycle or behind one.

    Collects everything reachable, then drops, round by round, the orders no
    remaining order leads to; what never drops out has endless paths to it.
    """
    reached = materialize(seeds, "reached")
    new = reached
    while not new.isEmpty():
        new = materialize(unseen(materialize(_successors(new, links), "successors"), reached), "reached")
        reached = reached.unionByName(new)
    remaining = materialize(reached.distinct(), "remaining")
    size = remaining.count()
    while size:
        fewer = materialize(remaining.join(_successors(remaining, links), "aufnr", "left_semi"), "remaining")
        before, size, remaining = size, fewer.count(), fewer
        if size == before:
            break
    return remaining


def _peeled(entries: DataFrame, links: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """``aufnr, w`` of the orders that peel off, of those that are left, and whether some could follow.

    An order is settled when all that lead to it over ``links`` are: its count of
    open ones is then 0. ``w`` is the longest path to it from ``entries(aufnr, w)``,
    NULL where none leads. A round writes what the orders it settles pass on and
    which orders that sets free; all others are scanned, not written again.
    """
    ends = links.groupBy(F.col("submo").alias("aufnr")).agg(F.count(F.lit(1)).alias("open"))
    nodes = links.select("aufnr").distinct().join(ends, "aufnr", "full").join(entries, "aufnr", "full")
    nodes = materialize(nodes.select("aufnr", F.coalesce("open", F.lit(0)).alias("open"), "w"), "peel")
    now, seen = stored(nodes.where("open = 0").select("aufnr", "w"), "free", n=F.count(F.lit(1)))
    settled: list[DataFrame] = []
    passed: list[DataFrame] = []

    def added_up(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts).groupBy("aufnr").agg(F.sum("_less").alias("_less"), F.max("_w").alias("_w"))

    while seen["n"] and len(settled) != rounds:
        settled.append(now)
        hit = links.join(now, "aufnr").groupBy(F.col("submo").alias("aufnr"))
        hit = materialize(hit.agg(F.count(F.lit(1)).alias("_less"), F.max(F.col("w") + 1).alias("_w")), "passed")
        if len(passed) == MERGE_AFTER:
            passed = [materialize(added_up(passed), "passed")]
        # what was passed on earlier counts for the orders hit now
        mine = added_up([*(p.join(hit.select("aufnr"), "aufnr", "left_semi") for p in passed), hit])
        passed.append(hit)
        freed = nodes.join(hit.select("aufnr"), "aufnr", "left_semi").join(mine, "aufnr").where(F.col("open") == F.col("_less"))
        now, seen = stored(freed.select("aufnr", F.greatest("w", "_w").alias("w")), "free", n=F.count(F.lit(1)))
    done = reduce(DataFrame.unionByName, settled, nodes.where("false").select("aufnr", "w"))
    left = nodes.select("aufnr", "w")
    if settled:
        left = nodes.where("open > 0").join(done.select("aufnr"), "aufnr", "left_anti")
        left = left.join(added_up(passed), "aufnr", "left").select("aufnr", F.greatest("w", "_w").alias("w"))
    return done, materialize(left, "left"), bool(seen["n"])


def _below_cycles(entries: DataFrame, links: DataFrame) -> DataFrame:
    """``aufnr, w`` of all that ``entries(aufnr, w)`` reach over ``links``, ENDLESS on cycles and behind those that are reached."""
    reached = new = materialize(entries.select("aufnr").distinct(), "reached")
    while not new.isEmpty():
        new = materialize(unseen(materialize(_successors(new, links), "successors"), reached), "reached")
        reached = reached.unionByName(new)
    done, left, _ = _peeled(entries, materialize(links.join(reached, "aufnr", "left_semi"), "links"))
    return done.unionByName(left.select("aufnr", F.lit(ENDLESS).alias("w")))


def _below_deep(entries: DataFrame, links: DataFrame, most: int | None) -> DataFrame:
    """As ``_below_cycles``, in some log2(depth) rounds by doubling; what ``longest_paths`` leaves out, beyond ``most`` pairs, is walked."""
    paths, wide = longest_paths(links.toDF("u", "v"), most)
    below = paths.join(entries.select(F.col("aufnr").alias("u"), F.col("w").alias("_w")), "u")
    lengths = entries.unionByName(below.select(F.col("v").alias("aufnr"), F.least(F.col("w") + F.col("_w"), F.lit(ENDLESS)).alias("w")))
    if wide is None:
        return lengths.groupBy("aufnr").agg(F.max("w").alias("w"))
    wide = materialize(wide.select(F.col("v").alias("aufnr")).distinct(), "wide")
    lengths = materialize(lengths.groupBy("aufnr").agg(F.max("w").alias("w")), "levels")
    inside = lengths.join(wide, "aufnr", "left_anti")
    into = links.join(wide.withColumnRenamed("aufnr", "submo"), "submo", "left_semi")
    begun = into.join(inside, "aufnr").select(F.col("submo").alias("aufnr"), F.least(F.col("w") + 1, F.lit(ENDLESS)).alias("w"))
    begun = begun.unionByName(entries.join(wide, "aufnr", "left_semi")).groupBy("aufnr").agg(F.max("w").alias("w"))
    among = materialize(into.join(wide, "aufnr", "left_semi"), "links")
    behind = _below_cycles(materialize(begun, "entries"), among)
    return inside.unionByName(behind.select("aufnr", F.least("w", F.lit(ENDLESS)).alias("w")))


def order_levels(
    seeds: DataFrame, edges: DataFrame, rounds: int = 32, most: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Level of every order reachable from ``seeds``: the longest path to it, seeds at 1.

    Returns ``(aufnr, bomlv, cyclic)`` and the edges, written out. Orders on or
    behind a cycle that a seed reaches have a NULL level. The graph is peeled from
    above by counts of open consumers. What is left when no order comes free is on or behind cycles;
    what is left after ``rounds`` is deep, and its paths are doubled.
    """
    edges = materialize(edges, "edges")
    # counts of open consumers hold for repeated links too, so these are read from the edges
    links = edges.where(F.col("submo").isNotNull()).select("aufnr", "submo")
    seeds = materialize(seeds.select("aufnr", F.lit(0).cast("long").alias("w")).distinct(), "frontier")
    longest, left, deep = _peeled(seeds, links, rounds)
    if not left.isEmpty():
        # what leads to an order that is left from one that is settled is in its length already
        links = materialize(links.join(left.select("aufnr"), "aufnr", "left_semi"), "links")
        entries = left.where(F.col("w").isNotNull())
        longest = longest.unionByName(_below_deep(entries, links, most) if deep else _below_cycles(entries, links))
    longest = longest.where(F.col("w").isNotNull())
    cyclic = F.col("w") >= ENDLESS
    return longest.select("aufnr", F.when(~cyclic, F.col("w").cast("int") + 1).alias("bomlv"), cyclic.alias("cyclic")), edges


def register_suborders(aufkx: DataFrame, found: DataFrame) -> DataFrame:
    """The tracked orders and, with blank state, the found ones not tracked yet."""
    new = found.select("aufnr").distinct().join(aufkx.select("aufnr"), "aufnr", "left_anti")
    blank = {c: F.lit(BLANK) for c in ("stat", "chgnr", "xstat", "xdate", "xtime")}
    return aufkx.unionByName(new.withColumns(blank).withColumn("bomlv", F.lit(0)), allowMissingColumns=True)


def level_orders(aufkx: DataFrame, edges: DataFrame, rounds: int = 32) -> DataFrame:
    """The order table after levelling.

    Reached closed orders get status, level and state B, also those done before;
    reached orders without a closing status are registered and stay blank; orders
    on or behind a cycle get state E.
    """
    tracked = materialize(reset_orders(aufkx), "orders")
    seeds = tracked.where(F.col("xstat") == BLANK).select("aufnr")
    levels, edges = order_levels(seeds, edges, rounds)
    closed = edges.select("aufnr", F.col("stat").alias("_stat"), F.col("chgnr").alias("_chgnr")).distinct()
    levels = materialize(levels.join(closed, "aufnr", "left"), "levels")
    known = register_suborders(tracked, levels)
    reached = levels.where(F.col("_stat").isNotNull()).withColumnRenamed("bomlv", "_level")
    hit = F.col("_stat").isNotNull()
    state = F.when(F.col("cyclic"), "E").otherwise("B")
    return known.join(reached, "aufnr", "left").select(
        "aufnr",
        F.coalesce("_stat", "stat").alias("stat"),
        F.coalesce("_chgnr", "chgnr").alias("chgnr"),
        F.coalesce("_level", "bomlv").cast("int").alias("bomlv"),
        F.when(hit, state).otherwise(F.col("xstat")).alias("xstat"),
        "xdate",
        "xtime",
        F.when(hit & F.col("cyclic"), CYCLIC).otherwise(F.col("remark")).alias("remark"),
    )
