"""Stock lots, open demand, and the allocation of one to the other."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.functions.ids import assign_row_id
from lotflow.operators.routes import ANY, Routes
from lotflow.operators.scan import (
    CHUNK,
    Chunked,
    HotKeys,
    chunk_groups,
    count_by,
    from_milli,
    hot_keys,
    milli,
    overlap_pairs,
)
from lotflow.operators.waterfall import KNOWN, NEED, STOCK, TURN, fact, fold_materials
from lotflow.session import materialize

# Fixed values
CHANNEL_PLANT = "101A"
PH_PLANTS = ("111A", "112A")
PH_STOCK_PLANTS = ("111A", "112A", "282A")
DT_PLANTS = ("481A", "482A")
DT_LOCATIONS = ("RM01", "RM02", "FGR1", "L101", "L109", "L111", "L134", "L135", "PHDT", "L127")
PH_LOCATIONS = ("L106",)
EXCLUDED_ELEMENTS = ("U1", "U2", "U3")
EXCLUDED_CUSTOMERS = ("L100", "L111", "L210", "L300", "L400", "L700", "L920")

LOT_ORDER = ["budat", "charg", "lgort", "uuid"]
DEMAND_ORDER = ["dat00", "delnr", "del12", "delps", "delet", "delkz", "lgort", "kunnr", "mng01", "uuid"]
DEMAND_KEY = ["werks", "matnr", "delkz", "delnr", "del12", "delps", "delet", "dat00", "lgort", "mng01", "kunnr"]


def stock_lots(mchbx: DataFrame, first_receipt: DataFrame, mseg: DataFrame) -> DataFrame:
    """Stock lines with the sales channel, from the plant of the batch's first receipt
    where there is one, else from location and plant."""
    # only lots at the hub ask for the plant of the receipt, and only four plants matter: both cut before the join
    hub = mchbx.where(F.col("werks") == CHANNEL_PLANT).select("matnr", "charg").distinct()
    made = mseg.where(F.col("werks").isin(*PH_PLANTS, *DT_PLANTS))
    receipts = first_receipt.select("matnr", "charg", "mjahr", "mblnr", "zeile").join(hub, ["matnr", "charg"], "left_semi")
    origin = receipts.join(
        made.select("mjahr", "mblnr", "zeile", F.col("werks").alias("_made_at")), ["mjahr", "mblnr", "zeile"]
    )
    lots = mchbx.join(origin.select("matnr", "charg", "_made_at"), ["matnr", "charg"], "left")
    at_hub = F.col("werks") == CHANNEL_PLANT
    channel = (
        F.when(at_hub & F.col("_made_at").isin(*PH_PLANTS), "PH")
        .when(at_hub & F.col("_made_at").isin(*DT_PLANTS), "DT")
        .when(at_hub & F.col("lgort").isin(*DT_LOCATIONS), "DT")
        .when(at_hub & F.col("lgort").isin(*PH_LOCATIONS), "PH")
        .when(F.col("werks").isin(*DT_PLANTS), "DT")
        .when(F.col("werks").isin(*PH_STOCK_PLANTS), "PH")
        .otherwise("TX")
    )
    return lots.withColumn("vtweg", channel).drop("_made_at")


def correct_lots(lots: DataFrame, mseg: DataFrame, changed: DataFrame) -> DataFrame:
    """``lots`` after ``changed`` index rows: lots of a changed batch get their channel again, the others keep it."""
    batch = ["matnr", "charg"]
    touched = lots.join(changed.select(*batch), batch, "left_semi").drop("vtweg")
    kept = lots.join(changed.select(*batch), batch, "left_anti")
    return kept.unionByName(stock_lots(touched, changed, mseg))


def stock_bucket(lots: DataFrame, routes: Routes | None = None) -> DataFrame:
    """Adds ``sto_lgort``: the location where it is a source of its own, else '****'."""
    table = routes or Routes()
    special = table.special_df(lots.sparkSession).withColumn("_special", F.lit(True))
    return (
        lots.join(F.broadcast(special), ["werks", "lgort"], "left")
        .withColumn("sto_lgort", F.when(F.col("_special"), F.col("lgort")).otherwise(ANY))
        .drop("_special")
    )


def demand_lines(zsd0012: DataFrame) -> DataFrame:
    """Open demand of outside customers, each line with a stable id.

    Equal lines are counted, not compared: the key and the number of the line
    among its equals make the id, so a line that repeats often needs no window.
    """
    wanted = (
        (F.col("mng01") > 0)
        & (F.col("plumi") == "-")
        & ~F.col("delkz").isin(*EXCLUDED_ELEMENTS)
        & ~F.col("kunnr").isin(*EXCLUDED_CUSTOMERS)
    )
    equal = zsd0012.where(wanted).groupBy(*DEMAND_KEY).agg(F.count(F.lit(1)).alias("_n"))
    rows = equal.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")
    rows = rows.withColumn("bal_qty", F.col("mng01")).withColumn("alc_qty", F.lit(0).cast("decimal(13,3)"))
    return assign_row_id(rows, [*DEMAND_KEY, "_copy"]).drop("_copy")


@dataclass
class Allocation:
    """``pairs``: lot id, demand id, quantity. ``unrouted``: demand of plants without a route."""

    pairs: DataFrame
    unrouted: DataFrame


def fifo_allocate(
    lots: DataFrame,
    demand: DataFrame,
    key: list[str],
    lot_order: list[str],
    demand_order: list[str],
    min_hot_rows: int | None = None,
) -> DataFrame:
    """Serve demand in order from lots in order, within each key.

    Both sides are laid end to end and matched where they overlap. ``lots`` and
    ``demand`` need ``uuid`` and ``bal_qty``.
    """
    lots = lots.where(F.col("bal_qty") > 0)
    demand = demand.where(F.col("bal_qty") > 0)
    hot = hot_keys(count_by(lots, key).unionByName(count_by(demand, key)), key, min_hot_rows)

    def line(rows: DataFrame, order: list[str], name: str) -> DataFrame:
        columns = list(dict.fromkeys([*key, *order, "uuid"]))
        rows = rows.select(*columns, milli(F.col("bal_qty")).alias("_units"))
        rows = chunk_groups(rows, key, order, hot, reread=True).intervals("_units", "start", "end")
        return rows.select(*key, F.col("uuid").alias(name), "start", "end")

    pairs = overlap_pairs(line(lots, lot_order, "lot_id"), line(demand, demand_order, "demand_id"), key, hot)
    return pairs.select(*key, "lot_id", "demand_id", from_milli(F.col("units")).alias("alc_qty"))


# ---- allocation over several sources -------------------------------------------------------------
#
# Within a material the demand plants are served one after another, so a plant's
# whole demand is one phase. Inside a phase the lines draw in order, and a bucket
# gives to them in order, so a phase's draws are intervals on the line of its
# buckets. What each phase leaves behind depends only on totals per (plant, own
# location), of which there is a bounded number per material. So: aggregate,
# follow the phases per material on the totals, then lay every line's draws out
# with running sums.

BY_PLANT = ["matnr", "plant_no"]
BY_LOCATION = ["matnr", "plant_no", "location_no"]
BY_BUCKET = ["matnr", "bucket"]


def _placed_demand(demand: DataFrame, routes: Routes, min_hot_rows: int | None) -> Chunked:
    """Routed demand laid end to end per (material, plant) as ``[s, e)``.

    From here on ``s`` stands for a line's place in its phase, so the wide
    business key is sorted and shuffled once. ``first`` is that key, kept on the
    first line of each phase only.
    """
    spark = demand.sparkSession
    located = demand.join(F.broadcast(routes.plants_df(spark)), "werks").join(
        F.broadcast(routes.own_df(spark)), ["werks", "lgort"], "left"
    )
    routed = located.where(F.col("bal_qty") > 0).select(
        *DEMAND_ORDER,
        *BY_PLANT,
        F.coalesce("location_no", F.lit(0)).alias("location_no"),
        milli(F.col("bal_qty")).alias("units"),
    )
    hot = hot_keys(count_by(routed, BY_PLANT), BY_PLANT, min_hot_rows)
    step = chunk_groups(routed, BY_PLANT, DEMAND_ORDER, hot, reread=True)
    lines = step.intervals("units", "s", "e").select(
        *BY_LOCATION,
        CHUNK,
        F.col("uuid").alias("demand_id"),
        "units",
        "s",
        "e",
        F.when(F.col("s") == 0, F.struct(*DEMAND_ORDER)).alias("first"),
    )
    return replace(step, df=materialize(lines, "demand"))


def _placed_lots(lots: DataFrame, routes: Routes, min_hot_rows: int | None) -> DataFrame:
    """Lots of the buckets in use, laid end to end per (material, bucket)."""
    held = (
        stock_bucket(lots.where(F.col("bal_qty") > 0), routes)
        .join(F.broadcast(routes.buckets_df(lots.sparkSession)), ["werks", "sto_lgort"])
        .select(*BY_BUCKET, *LOT_ORDER, milli(F.col("bal_qty")).alias("units"))
    )
    hot = hot_keys(count_by(held, BY_BUCKET), BY_BUCKET, min_hot_rows)
    placed = chunk_groups(held, BY_BUCKET, LOT_ORDER, hot, reread=True).intervals("units", "start", "end")
    return materialize(placed.select(*BY_BUCKET, F.col("uuid").alias("lot_id"), "start", "end"), "lots")


def _needs(lines: DataFrame) -> DataFrame:
    """Totals per (material, plant, own location)."""
    return lines.groupBy(*BY_LOCATION).agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("n"))


def _phases(lines: DataFrame) -> DataFrame:
    """Turn of each plant: by the key of its first line, at most one row per plant and material."""
    turn = F.row_number().over(Window.partitionBy("matnr").orderBy("first"))
    return lines.where(F.col("s") == 0).select(*BY_PLANT, turn.alias("turn"))


def _draw(lines: DataFrame, step: Chunked, supply: DataFrame, slot: int) -> tuple[DataFrame, DataFrame]:
    """Lay the lines of one slot on its buckets: draws, and what each line still needs."""
    offered = supply.where(F.col("slot") == slot).select(*step.keys, "buckets", "total")
    joined = lines.join(step.spread(offered), step.parts, "left")
    rest = F.greatest(F.col("e") - F.greatest(F.col("s"), F.coalesce("total", F.lit(0))), F.lit(0))
    left = joined.withColumn("units", rest).where(F.col("units") > 0)

    def piece(b):
        begin = F.greatest(F.col("s"), b["before"])
        end = F.least(F.col("e"), b["before"] + b["remaining"])
        return F.struct(
            b["bucket"].alias("bucket"),
            (begin - b["before"] + b["used"]).alias("start"),
            (end - b["before"] + b["used"]).alias("end"),
        )

    pieces = F.filter(F.transform("buckets", piece), lambda d: d["end"] > d["start"])
    draws = joined.select("matnr", "demand_id", F.inline(pieces))
    return draws, left.select(*BY_LOCATION, "demand_id", "place", "units")


def waterfall_allocate(
    lots: DataFrame,
    demand: DataFrame,
    routes: Routes | None = None,
    min_hot_rows: int | None = None,
) -> Allocation:
    """Allocate lots to demand through the ordered sources of each demand plant.

    Per material, plants are served in the order of their first demand line; a
    plant's lines in ``DEMAND_ORDER``; each line takes what it needs from its
    buckets in route order and from the lots of a bucket in ``LOT_ORDER``.
    """
    routes = routes or Routes()
    with ThreadPoolExecutor(2) as both:  # neither side needs the other yet
        placed_demand = both.submit(_placed_demand, demand, routes, min_hot_rows)
        placed_lots = both.submit(_placed_lots, lots, routes, min_hot_rows)
        step, lot_lines = placed_demand.result(), placed_lots.result()
    lines = step.df.drop("first").withColumn("place", F.col("s"))

    # totals per (plant, own location), turns and bucket contents: one small table
    stock = lot_lines.groupBy(*BY_BUCKET).agg(F.max("end").alias("units"), F.count(F.lit(1)).alias("n"))
    facts = (
        fact(_needs(lines), NEED, "plant_no", "location_no", n="n")
        .unionByName(fact(_phases(step.df), TURN, "plant_no", units="turn"))
        .unionByName(fact(stock, STOCK, "bucket", n="n"))
    )
    facts = materialize(facts, "facts")
    supply, pending = fold_materials(facts, routes)
    split = [p for p, phase in routes.phases.items() if phase.own]
    own_plants = F.col("plant_no").isin([routes.plant_no[p] for p in split])
    own_first = F.col("plant_no").isin([routes.plant_no[p] for p in split if not routes.phases[p].before])
    while pending is not None and not pending.isEmpty():
        # a plant with shared sources before its own ones: find what each own
        # location still needs after them, then follow the phases further
        waiting = lines.where(own_plants).join(step.spread(pending), step.parts)
        rest = F.greatest(F.col("e") - F.greatest(F.col("s"), F.col("total")), F.lit(0))
        found = waiting.groupBy(*BY_LOCATION).agg(F.sum(rest).alias("units"))
        facts = facts.unionByName(materialize(fact(found, KNOWN, "plant_no", "location_no"), "known"))
        supply, pending = fold_materials(facts, routes)
    needs = facts.where(F.col("kind") == NEED).select("matnr", F.col("a").alias("plant_no"), F.col("b").alias("location_no"), "n")

    def hot_in(keys: list[str]) -> HotKeys:
        # a plant that is not oversized has no oversized location either
        return HotKeys() if step.big is None else hot_keys(needs, keys, min_hot_rows)

    draws, left = _draw(lines.where(~own_first), step, supply, 0)
    if split:
        whole = lines.where(own_first).select(*BY_LOCATION, "demand_id", "place", "units")
        own = left.where(own_plants).unionByName(whole)
        own_step = chunk_groups(own, BY_LOCATION, ["place"], hot_in(BY_LOCATION))
        own_draws, left = _draw(own_step.intervals("units", "s", "e"), own_step, supply, 1)
        last_step = chunk_groups(left, BY_PLANT, ["place"], hot_in(BY_PLANT))
        last_draws, _ = _draw(last_step.intervals("units", "s", "e"), last_step, supply, 2)
        draws = draws.unionByName(own_draws).unionByName(last_draws)

    hot = _hot_buckets(needs, facts, supply, routes, min_hot_rows)
    pairs = overlap_pairs(lot_lines, draws, BY_BUCKET, hot)
    pairs = pairs.select("lot_id", "demand_id", from_milli(F.col("units")).alias("alc_qty"))
    return Allocation(pairs, unrouted_demand(demand, routes))


LOT_STATE = ["matnr", "uuid", "werks", "lgort", "charg", "budat", "bal_qty"]
DEMAND_STATE = ["matnr", "uuid", "werks", "bal_qty"]  # the id stands for all columns of a line


class Before(NamedTuple):
    """An earlier run: its lots and demand as they were before it, and its pairs."""

    lots: DataFrame
    demand: DataFrame
    pairs: DataFrame


def before_allocation(lots: DataFrame, demand: DataFrame, pairs: DataFrame) -> Before:
    """An earlier run from its stored balances and pairs: what was allocated is given back."""
    pairs = pairs.select(F.col("stk_mchb_id").alias("lot_id"), F.col("stk_mrp_id").alias("demand_id"), "alc_qty")
    back = pairs.withColumn("alc_qty", -F.col("alc_qty"))
    return Before(_settle(lots, back, "lot_id"), _settle(demand, back, "demand_id"), pairs)


def dirty_materials(before: Before, lots: DataFrame, demand: DataFrame) -> DataFrame:
    """Materials whose lots or demand differ between two states.

    Per material and state the rows are counted and two hashes of each are added
    up, so one row per task, material and state is shuffled. Sums of different
    rows agree with a chance of some 2 ** -128.
    """

    def marks(rows: DataFrame, columns: list[str], side: str) -> DataFrame:
        state = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
        hashes = [F.xxhash64(F.lit(seed), *state).cast("decimal(20,0)").alias(f"h{seed}") for seed in (1, 2)]
        return rows.select("matnr", F.lit(side).alias("side"), *hashes)

    rows = [
        marks(before.lots, LOT_STATE, "lots"), marks(before.demand, DEMAND_STATE, "demand"),
        marks(lots, LOT_STATE, "lots").select("matnr", "side", (-F.col("h1")).alias("h1"), (-F.col("h2")).alias("h2")),
        marks(demand, DEMAND_STATE, "demand").select("matnr", "side", (-F.col("h1")).alias("h1"), (-F.col("h2")).alias("h2")),
    ]
    all_rows = reduce(DataFrame.unionByName, rows)
    sums = all_rows.groupBy("matnr", "side").agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    return sums.where((F.col("h1") != 0) | (F.col("h2") != 0)).select("matnr").distinct()


def reallocate(
    before: Before,
    lots: DataFrame,
    demand: DataFrame,
    routes: Routes | None = None,
    min_hot_rows: int | None = None,
) -> Allocation:
    """``waterfall_allocate`` of the new state, from an earlier one: only materials that differ are allocated again.

    Materials do not share lots, so the pairs of all others stay. Only rows of
    materials that differ are sorted, folded and matched.
    """
    dirty = materialize(dirty_materials(before, lots, demand), "dirty")
    changed = [rows.join(dirty, "matnr", "left_semi") for rows in (lots, demand)]
    redone = waterfall_allocate(*changed, routes, min_hot_rows)
    gone = before.lots.join(dirty, "matnr", "left_semi").select(F.col("uuid").alias("lot_id"))
    kept = before.pairs.join(gone, "lot_id", "left_anti")
    return Allocation(kept.unionByName(redone.pairs), unrouted_demand(demand, routes))


def _hot_buckets(needs, facts, supply, routes, min_hot_rows) -> HotKeys:
    """Buckets with many lots and draws; a phase draws at most once per line and bucket."""
    longest = max(len(sources) for sources in routes.sources.values())
    most = F.when(F.col("kind") == NEED, F.col("n") * longest).otherwise(F.col("n"))
    rough = hot_keys(facts.select("matnr", most.alias("n")), ["matnr"], min_hot_rows)
    if rough.table is None:
        return rough
    held = facts.where(F.col("kind") == STOCK).select("matnr", F.col("a").alias("bucket"), "n")
    drawn = (
        supply.select(*BY_PLANT, F.explode("buckets.bucket").alias("bucket"))
        .join(needs.groupBy(*BY_PLANT).agg(F.sum("n").alias("n")), BY_PLANT)
        .select(*BY_BUCKET, "n")
    )
    return hot_keys(held.unionByName(drawn), BY_BUCKET, min_hot_rows)


def unrouted_demand(demand: DataFrame, routes: Routes | None = None) -> DataFrame:
    """Demand lines of plants without a route, which stay open."""
    plants = (routes or Routes()).plants_df(demand.sparkSession)
    return demand.join(F.broadcast(plants), "werks", "left_anti").withColumn("reason", F.lit("no_route"))


# ---- results ---------------------------------------------------------------------------------------


def _settle(rows: DataFrame, pairs: DataFrame, pair_id: str) -> DataFrame:
    """Move allocated quantity from ``bal_qty`` to ``alc_qty``; one aggregated row per id joins."""
    taken = pairs.groupBy(F.col(pair_id).alias("uuid")).agg(F.sum("alc_qty").alias("_taken"))
    moved = F.coalesce("_taken", F.lit(0))
    return (
        rows.join(taken, "uuid", "left")
        .withColumn("bal_qty", (F.col("bal_qty") - moved).cast("decimal(13,3)"))
        .withColumn("alc_qty", (F.col("alc_qty") + moved).cast("decimal(13,3)"))
        .drop("_taken")
    )


def lot_balances(lots: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every lot with its allocated and remaining quantity."""
    return _settle(lots, pairs, "lot_id")


def demand_balances(demand: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every demand line with its allocated and open quantity; the location is not kept."""
    return _settle(demand, pairs, "demand_id").drop("lgort")


def allocation_pairs(pairs: DataFrame) -> DataFrame:
    """The bridge between lots and demand."""
    return pairs.select(
        F.col("lot_id").alias("stk_mchb_id"), F.col("demand_id").alias("stk_mrp_id"), "alc_qty"
    )
