"""Month-end billing lines traced to the order that made the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.functions.ids import row_id
from lotflow.functions.scalars import BLANK, billed_qty
from lotflow.session import materialize

# Fixed values
LEDGER = "01"
BILLING_RECORDS = "F"
CLOSED = ("I0045", "I0046")
REMARK = "KE30"

SLICE = ["perio", "vtweg"]
LINE_KEY = ["gjahr", "belnr", "paobjnr", "pasubnr", "vbeln", "posnr"]
LINE_COLUMNS = [
    "vtweg", "perio", "budat", "kndnr", "artnr", "kaufn", "kdpos", "rbeln", "rposn", "vvr10", "paobjnr", "pasubnr", "belnr", "gjahr",
]
TRACE_COLUMNS = [
    "vtweg", "perio", "budat", "kndnr", "artnr", "kaufn", "kdpos", "vgbel", "vgpos", "vbeln", "posnr", "charg", "fkimg",
    "vrkme", "vvr10", "arktx", "mfgdt", "aufnr", "rldat", "rid", "paobjnr", "pasubnr", "belnr", "gjahr",
]


def slices_of(rows: DataFrame, channel: str | None = None, period: str | None = None) -> DataFrame:
    """The (period, channel) slices present in ``rows``, all or those of one channel or period."""
    wanted = F.lit(True)
    if period is not None:
        wanted = wanted & (F.col("perio") == period)
    if channel is not None:
        wanted = wanted & (F.col("vtweg") == channel)
    return rows.where(wanted).select(*SLICE).distinct()


def released_slices(ke30x: DataFrame) -> DataFrame:
    """(Period, channel) slices with a release date; an unknown date does not count."""
    return slices_of(ke30x.where(F.col("rldat") != BLANK))


def period_released(ke30x: DataFrame, channel: str, period: str) -> bool:
    mine = ke30x.where((F.col("vtweg") == channel) & (F.col("perio") == period))
    return not mine.where(F.col("rldat") != BLANK).isEmpty()


def billing_trace(
    ce13058: DataFrame,
    vbrp: DataFrame,
    first_receipt: DataFrame,
    channel: str | None = None,
    period: str | None = None,
) -> DataFrame:
    """Profitability lines with their billing item and the origin of the billed batch.

    A return changes the sign of the quantity, not of the revenue. Without
    ``channel`` and ``period`` all slices are traced at once. Lines with their
    items are written, so the shuffle files of both are gone when the wide rows
    are shuffled by batch.
    """
    lines = ce13058.where(
        (F.col("paledger") == LEDGER) & (F.col("vrgar") == BILLING_RECORDS) & (F.col("versi") == BLANK)
    )
    if period is not None:
        lines = lines.where(F.col("perio") == period)
    if channel is not None:
        lines = lines.where(F.col("vtweg") == channel)
    items = vbrp.select(
        F.col("vbeln").alias("rbeln"),
        F.col("posnr").alias("rposn"),
        "vgbel",
        "vgpos",
        "charg",
        billed_qty(F.col("fkimg"), F.col("shkzg")).cast("decimal(13,3)").alias("fkimg"),
        "vrkme",
        "arktx",
    )
    made = first_receipt.select(F.col("matnr").alias("artnr"), "charg", F.col("budat").alias("mfgdt"), "aufnr")
    billed = materialize(lines.select(*LINE_COLUMNS).join(items, ["rbeln", "rposn"]), "billed")
    return (
        billed.join(made, ["artnr", "charg"], "left")
        .withColumns({"vbeln": F.col("rbeln"), "posnr": F.col("rposn"), "rldat": F.lit(BLANK)})
        .withColumn("rid", row_id(LINE_KEY))
        .select(*TRACE_COLUMNS)
    )


def correct_trace(ke30x: DataFrame, changed: DataFrame) -> DataFrame:
    """The unreleased slices of ``ke30x`` that ``changed`` index rows touch, whole, with date and order of the new receipts.

    Each slice replaces the stored one; released slices stay as they were billed.
    Ids are hashes, which no codec makes smaller: one that follows from its line
    is not shuffled but made again.
    """
    made = changed.select(
        F.col("matnr").alias("artnr"), "charg", F.struct(F.col("budat").alias("mfgdt"), "aufnr").alias("_made")
    )
    # a few slices per month: they go to the lines, which stay where they are
    unreleased = ke30x.join(F.broadcast(released_slices(ke30x)), SLICE, "left_anti")
    touched = slices_of(unreleased.join(made, ["artnr", "charg"], "left_semi"))
    rid = row_id(LINE_KEY)
    rows = unreleased.join(F.broadcast(touched), SLICE, "left_semi")
    rows = rows.withColumn("_rid", F.when(~F.col("rid").eqNullSafe(rid), F.struct("rid"))).drop("rid")
    rows = rows.join(made, ["artnr", "charg"], "left")
    rows = rows.withColumn("rid", F.when(F.col("_rid").isNull(), rid).otherwise(F.col("_rid.rid")))
    now = {c: F.when(F.col("_made").isNull(), F.col(c)).otherwise(F.col("_made")[c]) for c in ("mfgdt", "aufnr")}
    return rows.withColumns(now).select(*TRACE_COLUMNS)


def replace_period(ke30x: DataFrame, trace: DataFrame) -> DataFrame:
    """The stored table after each slice of ``trace`` took the place of the stored one."""
    kept = ke30x.join(F.broadcast(slices_of(trace)), SLICE, "left_anti")
    return kept.unionByName(trace, allowMissingColumns=True)


def closing_status(jest: DataFrame) -> DataFrame:
    """The active closing status per order object, the higher code where there are two."""
    active = jest.where((F.col("inact") == BLANK) & F.col("stat").isin(*CLOSED))
    best = Window.partitionBy("objnr").orderBy(F.desc("stat"), F.desc("chgnr"))
    ranked = active.withColumn("_rank", F.row_number().over(best))
    return ranked.where(F.col("_rank") == 1).select("objnr", "stat", "chgnr")


def enqueue_orders(aufk: DataFrame, jest: DataFrame, aufkx: DataFrame, ke30x: DataFrame) -> DataFrame:
    """Orders behind unreleased billing lines that are not tracked yet."""
    open_orders = ke30x.where(F.col("rldat") == BLANK).select("aufnr").distinct()
    return (
        aufk.select("aufnr", "objnr")
        .join(open_orders, "aufnr", "left_semi")
        .join(aufkx.select("aufnr"), "aufnr", "left_anti")
        .join(closing_status(jest), "objnr", "left")
        .select(
            "aufnr",
            "stat",
            "chgnr",
            F.lit(0).alias("bomlv"),
            F.lit(BLANK).alias("xstat"),
            F.lit(BLANK).alias("xdate"),
            F.lit(BLANK).alias("xtime"),
            F.lit(REMARK).alias("remark"),
        )
    )
