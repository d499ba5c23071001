"""Explosion of production orders down to raw material."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.functions.ids import row_id
from lotflow.functions.scalars import BLANK, signed, wip_factor
from lotflow.operators.closure import coefficients, longest_paths, stored, unseen
from lotflow.operators.orders import CYCLIC, endless_orders
from lotflow.operators.scan import scattered
from lotflow.session import materialize

# Fixed values
OUTPUT_ITEM = "0000"
MARKER = "ZIEBP023"
WIP_PLANTS = ("481A", "482A")
REWORK_PREFIX = "0014"
BOM_AREA = "2300"
BOM_COMPANY = "L400"
BOM_CONTRACT = "E23070000001"
BOM_PLANT = "481A"
BOM_REF = ("P023", "9999")

#: Steps up the orders before the graph is searched for cycles, which levelling takes out.
CHECK_AFTER = 32
POSTING = ["aufnr", "mjahr", "mblnr", "zeile"]
#: What totals need of a posting: they carry no keys of postings.
TOTALLED = ["aufnr", "matnr", "charg", "menge", "meins", "dmbtr", "waufnr", "wmoqty", "is_wip"]
ROW_COLUMNS = [
    "uuid", "aufnr", "wip", "rsnum", "rspos", "orsnum", "orspos", "mblnr", "mjahr", "zeile", "budat", "bwart", "matnr",
    "charg", "werks", "menge", "qty", "meins", "dmbtr", "amt", "waufnr", "wmoqty", "wfactor", "wrsnum", "wrspos",
    "wmjahr", "wmblnr", "wzeile",
]


def signed_posting(df: DataFrame) -> DataFrame:
    """Quantity and amount of a consumption: H positive, anything else negative."""
    return df.withColumn("menge", signed(F.col("menge"), F.col("shkzg"), "H").cast("decimal(13,3)")).withColumn(
        "dmbtr", signed(F.col("dmbtr"), F.col("shkzg"), "H").cast("decimal(15,2)")
    )


def order_output_qty(aufm: DataFrame) -> DataFrame:
    """Net output per order."""
    put = signed(F.col("menge"), F.col("shkzg"), "S")
    outputs = aufm.where(F.col("rspos") == OUTPUT_ITEM)
    return outputs.groupBy("aufnr").agg(F.sum(put).cast("decimal(23,3)").alias("wmoqty"))


def first_item(afpo: DataFrame) -> DataFrame:
    """One row per order: its lowest item."""
    ranked = afpo.withColumn("_rank", F.row_number().over(Window.partitionBy("aufnr").orderBy("posnr")))
    return ranked.where(F.col("_rank") == 1).select("aufnr", "pwerk")


def producers(aufm: DataFrame, afpo: DataFrame) -> DataFrame:
    """Producing plant and net output per order, so that postings meet them in one join."""
    return (
        first_item(afpo)
        .join(order_output_qty(aufm), "aufnr", "full")
        .withColumnRenamed("aufnr", "waufnr")
    )


def split_consumption(aufm: DataFrame, first_receipt: DataFrame, makers: DataFrame) -> DataFrame:
    """Component postings with their batch's producer; ``is_wip`` tells work in progress
    (made by another order of a WIP plant, or under the bonded marker) from pure material."""
    producer = F.col("waufnr")
    # Each batch meets its producer first, so that the postings pass one shuffle.
    made = (
        first_receipt.select("matnr", "charg", F.coalesce("aufnr", F.lit(BLANK)).alias("waufnr"))
        # purchased batches and the marker have no maker and are many
        .withColumn("_maker", scattered(producer, ~producer.isin(BLANK, MARKER), "matnr", "charg"))
        .join(makers.withColumnRenamed("waufnr", "_maker"), "_maker", "left")
        .drop("_maker")
    )
    rows = signed_posting(aufm.where(F.col("rspos") != OUTPUT_ITEM)).select(
        "aufnr", "rsnum", "rspos", "mjahr", "mblnr", "zeile", "budat", "bwart", "matnr", "charg", "werks", "menge",
        "meins", "dmbtr",
    )
    in_house = (
        (producer != BLANK) & ~producer.startswith(REWORK_PREFIX) & F.coalesce("pwerk", F.lit(BLANK)).isin(*WIP_PLANTS)
    )
    return (
        rows.join(made, ["matnr", "charg"], "left")
        .withColumn("waufnr", F.coalesce("waufnr", F.lit(BLANK)))
        .withColumn("is_wip", in_house | (producer == MARKER))
    )


def wip_postings(split: DataFrame) -> DataFrame:
    """WIP rows with output quantity and factor; the marker's factor is the quantity itself."""
    marker = F.col("waufnr") == MARKER
    output = F.when(marker, F.lit(1).cast("decimal(23,3)")).otherwise(F.col("wmoqty"))
    return (
        split.where("is_wip")
        .withColumn("wmoqty", output)
        .withColumn("wfactor", wip_factor(F.col("menge"), F.col("wmoqty")))
        .drop("is_wip")
    )


@dataclass
class Readiness:
    """``ready``: orders that can be exploded. ``blocked``: the others with their remark."""

    ready: DataFrame
    blocked: DataFrame


def _walked_consumers(held: DataFrame, needed: DataFrame, rounds: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``held`` and all orders that need one of them, by a walk that follows newly found ones only.

    The second result is None, or after so many ``rounds`` those whose consumers are not followed yet.
    """
    found = new = held
    steps = 0
    while not new.isEmpty():
        if steps == rounds:
            return found, new
        steps += 1
        consumers = needed.join(new.withColumnRenamed("aufnr", "waufnr"), "waufnr", "left_semi")
        new = materialize(unseen(materialize(consumers.select("aufnr").distinct(), "consumers"), found), "blocked")
        found = found.unionByName(new)
    return found, None


def readiness(orders: DataFrame, wip: DataFrame, most: int | None = None, rounds: int = CHECK_AFTER) -> Readiness:
    """Which levelled orders (state B) can be exploded.

    An order is blocked by a producer that is neither done nor going to be, by
    itself, or by a producer without output; blocked orders block their consumers.
    These are found by a walk; what it has not reached after ``rounds`` steps by
    doubling of paths, and those before an order that ``longest_paths`` leaves
    out, beyond ``most`` pairs, by a walk again.
    """
    todo = orders.where(F.col("xstat") == "B").select("aufnr")
    state = orders.select(F.col("aufnr").alias("waufnr"), F.col("xstat").alias("_state"))
    needed = (
        wip.where(F.col("waufnr") != MARKER)
        .select("aufnr", "waufnr", F.col("wfactor").isNull().alias("no_output"))
        .distinct()
        .join(todo, "aufnr", "left_semi")
        .join(state, "waufnr", "left")
        .withColumn(
            "open", (F.col("waufnr") == F.col("aufnr")) | ~F.coalesce(F.col("_state").isin("B", "X"), F.lit(False))
        )
        .drop("_state")
    )
    needed = materialize(needed, "needed")
    held = materialize(needed.where(F.col("open") | F.col("no_output")).select("aufnr").distinct(), "blocked")
    blocked, deep = _walked_consumers(held, needed, rounds)
    if deep is not None:
        links = needed.select(F.col("aufnr").alias("u"), F.col("waufnr").alias("v"))
        paths, wide = longest_paths(links, most)
        above = paths.join(deep.withColumnRenamed("aufnr", "v"), "v", "left_semi").select(F.col("u").alias("aufnr"))
        blocked = blocked.unionByName(above)
        if wide is not None:
            lost = materialize(deep.join(wide.withColumnRenamed("v", "aufnr"), "aufnr", "left_semi"), "blocked")
            blocked = blocked.unionByName(_walked_consumers(lost, needed)[0])
    blocked = materialize(blocked.distinct(), "blocked")
    failed = blocked.select(F.col("aufnr").alias("waufnr"), F.lit(True).alias("_failed"))
    reasons = needed.join(failed, "waufnr", "left").withColumn(
        "open", F.col("open") | F.coalesce("_failed", F.lit(False))
    )

    def listed(condition):
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(condition, F.col("waufnr")))))

    # the remark is one text per order: the distinct producers that hold it up
    remarks = reasons.where(F.col("open") | F.col("no_output")).groupBy("aufnr").agg(
        listed(F.col("open")).alias("_open"), listed(F.col("no_output")).alias("_none")
    )
    remark = F.when(F.col("_open") != "", F.col("_open")).otherwise(F.concat(F.lit("no output:"), "_none"))
    blocked = blocked.join(remarks.select("aufnr", remark.alias("remark")), "aufnr", "left")
    ready = todo.join(blocked.select("aufnr"), "aufnr", "left_anti")
    return Readiness(materialize(ready, "ready"), materialize(blocked, "remarks"))


def _row(df: DataFrame, kind: str, key: list[str], **values) -> DataFrame:
    """A row of the result; columns not named in ``values`` come from ``df`` or are NULL."""
    types = {"wmoqty": "decimal(23,3)", "wfactor": "double"}
    columns = {"uuid": row_id(["_kind", *key]), "wip": F.lit(kind[0]), **values}
    picked = [
        (columns[c] if c in columns else F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "string"))).alias(c)
        for c in ROW_COLUMNS
    ]
    return df.withColumn("_kind", F.lit(kind)).select(*picked)


def _number(value) -> object:
    return value.cast("double")


def wip_marker_rows(wip: DataFrame) -> DataFrame:
    """One W row per WIP posting, without quantity and amount."""
    zero = F.lit(0.0)
    return _row(
        wip, "W", POSTING, orsnum=F.col("rsnum"), orspos=F.col("rspos"), menge=zero, qty=zero,
        dmbtr=F.lit(0).cast("decimal(15,2)"), amt=zero,
    )


def _bonded(wip: DataFrame, ziebp023: DataFrame) -> DataFrame:
    bom = ziebp023.where(
        (F.col("bnarea") == BOM_AREA) & (F.col("bukrs") == BOM_COMPANY) & (F.col("connr") == BOM_CONTRACT)
    ).select("matnr", "charg", "idnrk", F.col("menge").alias("_per"))
    return wip.where(F.col("waufnr") == MARKER).join(bom, ["matnr", "charg"])


def bonded_bom_rows(wip: DataFrame, ziebp023: DataFrame) -> DataFrame:
    """Components of bonded batches from the contract's bill of material."""
    rows = _bonded(wip, ziebp023)
    qty = _number(F.col("_per")) * F.col("wfactor")
    return _row(
        rows, "S bonded", [*POSTING, "idnrk"], orsnum=F.lit(BOM_REF[0]), orspos=F.lit(BOM_REF[1]),
        matnr=F.col("idnrk"), charg=F.lit(BLANK), werks=F.lit(BOM_PLANT), menge=qty, qty=qty,
        dmbtr=F.lit(0).cast("decimal(15,2)"), amt=F.lit(0.0),
    )


def pure_material_rows(split: DataFrame) -> DataFrame:
    """Direct consumption, unscaled."""
    rows = split.where(~F.col("is_wip")).drop("wmoqty")
    return _row(
        rows, "M", POSTING, orsnum=F.col("rsnum"), orspos=F.col("rspos"), menge=_number(F.col("menge")),
        qty=_number(F.col("menge")), amt=_number(F.col("dmbtr")),
    )


def inherit_child_rows(wip: DataFrame, exploded: DataFrame) -> DataFrame:
    """All rows of each producer under its consumer, quantity and amount times the factor."""
    links = wip.where(F.col("waufnr") != MARKER).select(
        *[F.col(c).alias(f"_{c}") for c in ("aufnr", "rsnum", "rspos", "mjahr", "mblnr", "zeile", "wmoqty", "wfactor")],
        F.col("waufnr").alias("_maker"),
    )
    rows = exploded.join(links, F.col("aufnr") == F.col("_maker")).withColumnRenamed("uuid", "_child")
    return _row(
        rows, "S inherited", ["_aufnr", "_mjahr", "_mblnr", "_zeile", "_child"],
        aufnr=F.col("_aufnr"), rsnum=F.col("_rsnum"), rspos=F.col("_rspos"), mjahr=F.col("_mjahr"),
        mblnr=F.col("_mblnr"), zeile=F.col("_zeile"), qty=F.col("qty") * F.col("_wfactor"),
        amt=F.col("amt") * F.col("_wfactor"), waufnr=F.col("aufnr"), wmoqty=F.col("_wmoqty"),
        wfactor=F.col("_wfactor"), wrsnum=F.col("rsnum"), wrspos=F.col("rspos"), wmjahr=F.col("mjahr"),
        wmblnr=F.col("mblnr"), wzeile=F.col("zeile"),
    )


def own_use(split: DataFrame, wip: DataFrame, ziebp023: DataFrame) -> DataFrame:
    """Direct consumption for ``material_totals``: quantities of ``pure_material_rows`` and ``bonded_bom_rows``, from TOTALLED columns."""
    qty = _number(F.col("_per")) * F.col("wfactor")
    key = ["aufnr", "matnr", "charg", "meins"]
    bonded = _bonded(wip, ziebp023).select(
        "aufnr", F.col("idnrk").alias("matnr"), F.lit(BLANK).alias("charg"), "meins", qty.alias("qty"), F.lit(0.0).alias("amt")
    )
    pure = split.where(~F.col("is_wip")).select(*key, _number(F.col("menge")).alias("qty"), _number(F.col("dmbtr")).alias("amt"))
    return bonded.unionByName(pure).select(*key, "qty", "amt", F.col("qty").alias("menge"), F.col("amt").alias("dmbtr"))


def material_totals(orders: DataFrame, wip: DataFrame, own: DataFrame, rounds: int = CHECK_AFTER) -> DataFrame:
    """``aufnr, matnr, charg, meins, qty, amt``: what ``orders`` consume of each batch over all their producers.

    The same sums as of the exploded rows, added up per order and batch at every
    step up the orders instead of one row per path. What climbs on after ``rounds``
    steps goes by one coefficient per order and producer. ``wip``: the WIP postings of orders that
    can be exploded. ``own``: rows of direct consumption. Work in progress itself is not counted.
    """
    key = ["matnr", "charg", "meins"]
    used = own.where("menge <> 0 OR dmbtr <> 0").groupBy("aufnr", *key).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt"))
    used = materialize(used, "used")
    factors = wip.where(F.col("waufnr") != MARKER).select(F.col("aufnr").alias("u"), F.col("waufnr").alias("v"), F.col("wfactor").alias("f"))
    factors = materialize(factors.groupBy("u", "v").agg(F.sum("f").alias("c")), "factors")

    def climb(rows: DataFrame, shares: DataFrame) -> DataFrame:
        into = shares.join(rows.withColumnRenamed("aufnr", "v"), "v")
        parts = into.select(F.col("u").alias("aufnr"), *key, (F.col("qty") * F.col("c")).alias("qty"), (F.col("amt") * F.col("c")).alias("amt"))
        return parts.groupBy("aufnr", *key).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt"))

    sums, new, left, steps = used, used, 1, 0
    while left and steps < rounds:
        new, seen = stored(climb(new, factors), "climb", n=F.count(F.lit(1)))
        sums, left, steps = sums.unionByName(new), seen["n"], steps + 1
    if left:
        sums = sums.unionByName(climb(new, coefficients(factors.withColumnRenamed("c", "f"))))
    sums = sums.groupBy("aufnr", *key).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt"))
    return sums.join(orders.select("aufnr"), "aufnr", "left_semi")


@dataclass
class Explosion:
    """``rows``: the exploded rows after the run. ``orders``: the order table after the run."""

    rows: DataFrame
    orders: DataFrame


def explode_orders(
    orders: DataFrame,
    aufm: DataFrame,
    first_receipt: DataFrame,
    afpo: DataFrame,
    ziebp023: DataFrame,
    stored: DataFrame | None,
    as_of: datetime,
    only: DataFrame | None = None,
) -> Explosion:
    """Explode all levelled orders; ``only`` names those that have state B, if postings of others need not be read.

    Rows climb from producers to consumers one level per step: each step joins
    only the rows the step before made, so every row of the result is made once.
    Rows of an order that starts over are dropped; those of untouched orders stay
    and can be inherited.
    """
    posted = aufm if only is None else aufm.join(only, "aufnr", "left_semi")
    split = materialize(split_consumption(posted, first_receipt, producers(aufm, afpo)), "split")
    wip = wip_postings(split)
    state = readiness(orders, wip)
    wip = wip.join(state.ready, "aufnr", "left_semi")
    own = (
        wip_marker_rows(wip)
        .unionByName(bonded_bom_rows(wip, ziebp023))
        .unionByName(pure_material_rows(split.join(state.ready, "aufnr", "left_semi")))
    )
    made = new = materialize(own, "rows")
    links = materialize(wip, "wip")
    if stored is not None:
        # orders in error have no rows: those blocked now, and those that levelling found on a cycle
        redone = orders.where(F.col("xstat").isin("B", "E")).select("aufnr")
        stored = stored.join(redone, "aufnr", "left_anti").select(*ROW_COLUMNS)
        makers = links.select(F.col("waufnr").alias("aufnr")).distinct()
        new = new.unionByName(stored.join(makers, "aufnr", "left_semi"))
    steps = 0
    while True:
        steps += 1
        if steps == CHECK_AFTER:
            climbs = links.where(F.col("waufnr") != MARKER).select(F.col("waufnr").alias("aufnr"), F.col("aufnr").alias("submo"))
            if not endless_orders(new.select("aufnr").distinct(), climbs.distinct()).isEmpty():
                raise ValueError("orders in state B lie on a cycle: level them first")
        new = materialize(inherit_child_rows(links, new), "rows")
        if new.isEmpty():
            break
        made = made.unionByName(new)
    if stored is not None:
        made = made.unionByName(stored)
    return Explosion(made, settle_orders(orders, state, as_of))


def changed_orders(before: DataFrame, after: DataFrame, index_changes: DataFrame | None = None) -> DataFrame:
    """Orders whose postings differ between two states of the postings, or that post a batch whose first receipt changed."""

    def summed(rows: DataFrame) -> DataFrame:
        h = F.xxhash64(*[F.struct(c) for c in sorted(before.columns)])
        return rows.groupBy("aufnr").agg(F.struct(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).alias("all"))

    both = summed(before).withColumnRenamed("all", "was").join(summed(after), "aufnr", "full")
    found = both.where(~F.col("was").eqNullSafe(F.col("all"))).select("aufnr")
    if index_changes is not None:
        batches = index_changes.select("matnr", "charg").distinct()
        found = found.unionByName(after.join(batches, ["matnr", "charg"], "left_semi").select("aufnr"))
    return found.distinct()


@dataclass
class Delta:
    """``redone``: orders exploded again. ``rows``: their rows, which replace the stored ones. ``orders``: the order table after it."""

    redone: DataFrame
    rows: DataFrame
    orders: DataFrame


def reexplode_orders(
    orders: DataFrame,
    changed: DataFrame,
    aufm: DataFrame,
    first_receipt: DataFrame,
    afpo: DataFrame,
    ziebp023: DataFrame,
    stored: DataFrame,
    as_of: datetime,
) -> Delta:
    """Explode again what ``changed`` orders change: these and all orders above them.

    ``orders`` and ``stored`` are those of the last explosion. Consumers are known
    from its rows, those of orders in error from their postings. Orders that are
    not above a changed one keep rows, state and stamp. Orders on a cycle stay in
    error; where new postings may close one, level the orders first.
    """
    cyclic = (F.col("xstat") == "E") & (F.col("remark") == CYCLIC)
    failed = orders.where((F.col("xstat") == "E") & ~F.coalesce(cyclic, F.lit(False))).select("aufnr")
    held = aufm.join(failed, "aufnr", "left_semi").where(F.col("rspos") != OUTPUT_ITEM)
    made = first_receipt.select("matnr", "charg", F.col("aufnr").alias("waufnr"))
    links = stored.where((F.col("wip") == "W") & (F.col("waufnr") != MARKER)).select("aufnr", "waufnr")
    links = links.unionByName(held.join(made, ["matnr", "charg"]).select("aufnr", "waufnr")).distinct()
    redone, _ = _walked_consumers(materialize(changed.select("aufnr").distinct(), "changed"), materialize(links, "links"))
    redone = materialize(redone.join(orders.where(F.col("xstat").isin("X", "E", "B") & ~F.coalesce(cyclic, F.lit(False))), "aufnr", "left_semi"), "redone")
    # the others keep state and rows; those in error count as not done
    again = orders.join(redone.withColumn("_again", F.lit(True)), "aufnr", "left")
    again = again.withColumn("xstat", F.when(F.col("_again"), "B").otherwise(F.col("xstat"))).drop("_again")
    kept = stored.join(redone, "aufnr", "left_anti")
    # inherited rows come from producers that are not done again; all others of their rows are left where they are
    result = explode_orders(again, aufm, first_receipt, afpo, ziebp023, kept, as_of, only=redone)
    after = result.orders.join(redone, "aufnr", "left_semi").unionByName(orders.select(*result.orders.columns).join(redone, "aufnr", "left_anti"))
    return Delta(redone, result.rows.join(redone, "aufnr", "left_semi").select(*ROW_COLUMNS), after)


def apply_delta(stored: DataFrame, delta: Delta) -> DataFrame:
    """The stored rows with those of the redone orders replaced."""
    return stored.join(delta.redone, "aufnr", "left_anti").unionByName(delta.rows).select(*ROW_COLUMNS)


def settle_orders(orders: DataFrame, state: Readiness, as_of: datetime) -> DataFrame:
    """Final states: X for exploded orders, E with a remark for blocked and cyclic ones, all stamped."""
    processed = F.col("xstat") == "B"
    stamped = F.col("xstat").isin("B", "E")
    blocked = state.blocked.select("aufnr", F.col("remark").alias("_why"))
    failed = F.col("_why").isNotNull()

    def stamp(text: str, column: str):
        return F.when(stamped, F.lit(text)).otherwise(F.col(column)).alias(column)

    return orders.join(blocked, "aufnr", "left").select(
        "aufnr",
        "stat",
        "chgnr",
        "bomlv",
        F.when(processed, F.when(failed, "E").otherwise("X")).otherwise(F.col("xstat")).alias("xstat"),
        stamp(as_of.strftime("%Y%m%d"), "xdate"),
        stamp(as_of.strftime("%H%M%S"), "xtime"),
        F.when(processed, F.coalesce("_why", F.lit(BLANK))).otherwise(F.col("remark")).alias("remark"),
    )
