"""Index of the first receipt of every material batch."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.session import materialize
from lotflow.sources.tables import append_new

BATCH = ["matnr", "charg"]
ENTRY_ORDER = ["cpudt", "cputm", "mjahr", "mblnr", "zeile"]
INDEX_COLUMNS = [
    "matnr", "charg", "mjahr", "mblnr", "zeile", "budat", "bwart", "aufnr", "ebeln", "ebelp", "lifnr", "cpudt",
]

#: A receipt with all that orders it.
ORDERED_COLUMNS = [*INDEX_COLUMNS, "cputm"]


def receipt_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Receipt lines with the entry columns of their documents."""
    entered = headers.select("mandt", "mjahr", "mblnr", "budat", "cpudt", "cputm")
    return lines.where(F.col("shkzg") == "S").join(entered, ["mandt", "mjahr", "mblnr"])


def _earliest(receipts: DataFrame, key: list[str], order_cols: list[str], columns: list[str] = INDEX_COLUMNS) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(*order_cols)
    ranked = receipts.withColumn("_seq", F.row_number().over(order))
    return ranked.where(F.col("_seq") == 1).select(*columns)


def first_receipt(
    lines: DataFrame,
    headers: DataFrame,
    key: list[str] = BATCH,
    order_cols: list[str] = ENTRY_ORDER,
) -> DataFrame:
    """Earliest receipt line per batch by entry date, time, year, document, item.

    The rank filter is pushed below the shuffle as a group limit: each map task
    sends one row per batch, however many lines a batch has.
    """
    return _earliest(receipt_lines(lines, headers), key, order_cols)


def first_receipt_incremental(existing: DataFrame, lines: DataFrame, headers: DataFrame) -> DataFrame:
    """New index rows: documents from the last stored entry date on, batches not stored yet.

    An empty index loads everything. A stored batch is never corrected, even by
    an older document that arrives late.
    """
    watermark = existing.agg(F.max("cpudt").alias("cpudt")).scalar()
    recent = headers.where(F.col("cpudt") >= F.coalesce(watermark, F.lit("")))
    new = materialize(receipt_lines(lines, recent), "increment")
    # of the index only the increment's batches are looked up; a small increment is sent to it
    keys = new.select(*[F.col(k).alias(f"_{k}") for k in BATCH]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in BATCH])
    return _earliest(append_new(existing.join(keys, same, "left_semi"), new, BATCH), BATCH, ENTRY_ORDER)


def ordered_receipts(receipts: DataFrame) -> DataFrame:
    """The earliest of ``receipts`` per batch, with the time of entry."""
    return _earliest(receipts, BATCH, ENTRY_ORDER, ORDERED_COLUMNS)


def receipt_changes(stored: DataFrame, receipts: DataFrame) -> DataFrame:
    """What ``receipts`` change in the index ``stored``: rows with ``change`` ``+``, and ``-`` for those they replace.

    Both carry the time of entry. A batch changes where it is not stored, or was
    stored with a later receipt; so the index after any order of loads is that of
    all documents at once, and a load that is repeated changes nothing. Of the
    index only the batches of ``receipts`` are looked up.
    """
    new = ordered_receipts(receipts)
    old = stored.select(*[F.col(k).alias(f"_{k}") for k in BATCH], F.struct(*ORDERED_COLUMNS).alias("_old"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in BATCH])
    both = new.select(*BATCH, F.struct(*ORDERED_COLUMNS).alias("_new")).join(old, same, "left")
    place = lambda row: F.struct(*[F.col(row)[c] for c in ENTRY_ORDER])
    earlier = both.where(F.col("_old").isNull() | (place("_new") < place("_old")))
    sides = F.array(
        F.struct(F.lit("+").alias("change"), F.col("_new").alias("row")),
        F.struct(F.lit("-").alias("change"), F.col("_old").alias("row")),
    )
    rows = earlier.select(F.explode(sides).alias("side")).where(F.col("side.row").isNotNull())
    return rows.select("side.row.*", "side.change")


def corrected(changes: DataFrame) -> DataFrame:
    """The index rows of the batches that ``changes`` touch, as they are now."""
    return changes.where(F.col("change") == "+").select(*INDEX_COLUMNS)
