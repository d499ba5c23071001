"""Ordered running computations per key that stay parallel when one key is huge.

A window puts a whole key into one task. Keys above a size limit are cut here
into consecutive chunks by a range shuffle, the window runs per chunk, and the
value carried into each chunk is added from a table with one row per chunk.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotflow.session import local_table, materialize, shuffle_partitions

CHUNK = "_chunk"
MIN_HOT_ROWS = 1_000_000


@dataclass
class HotKeys:
    """Keys with more than ``limit`` rows; ``table`` is None when there are none.

    ``limit`` is at least rows / (4 * shuffle partitions), so there are at most
    4 * shuffle partitions such keys and the table is safe to broadcast.
    """

    table: DataFrame | None = None
    rows: int = 0
    limit: int = 0


def hot_keys(counts: DataFrame, keys: list[str], min_rows: int | None = None) -> HotKeys:
    """Find oversized keys in ``counts``, a table of ``keys`` and a row count ``n``.

    ``counts`` may repeat a key; its counts are added up.
    """
    spark = counts.sparkSession
    min_rows = MIN_HOT_ROWS if min_rows is None else min_rows
    per_key = counts.groupBy(*keys).agg(F.sum("n").alias("n"))
    total, largest = per_key.agg(F.sum("n"), F.max("n")).first()
    if not total:
        return HotKeys()
    limit = max(min_rows, total // (4 * shuffle_partitions(spark)))
    if largest <= limit:
        return HotKeys()
    found = per_key.where(F.col("n") > limit).dropna(subset=keys).collect()
    if not found:
        return HotKeys()
    ddl = per_key.select(*keys).schema.simpleString()[len("struct<") : -1]
    table = local_table(spark, [tuple(r[k] for k in keys) for r in found], ddl)
    return HotKeys(table, sum(r["n"] for r in found), limit)


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Chunked:
    """Rows with a ``_chunk`` column: 0 for ordinary keys, increasing along the
    order for hot ones. ``big`` holds the rows of the hot keys only."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    big: DataFrame | None = None

    @property
    def parts(self) -> list[str]:
        return [*self.keys, CHUNK]

    def spread(self, small: DataFrame) -> DataFrame:
        """Repeat the rows of ``small`` (one or few per key) once per chunk."""
        if self.big is None:
            return small.withColumn(CHUNK, F.lit(0))
        # one row per chunk of a hot key: bounded by the number of range partitions
        chunks = self.big.select(*self.parts).distinct()
        return small.join(F.broadcast(chunks), self.keys, "left").withColumn(
            CHUNK, F.coalesce(F.col(CHUNK), F.lit(0))
        )

    def _window(self):
        return (
            Window.partitionBy(*self.parts)
            .orderBy(*self.order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def _before(self):
        return (
            Window.partitionBy(*self.keys)
            .orderBy(CHUNK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )

    def intervals(self, value: str, start: str, end: str) -> DataFrame:
        """Lay the values of each key end to end: ``[start, end)`` per row."""
        out = self.df.withColumn(end, F.sum(value).over(self._window()))
        if self.big is not None:
            carried = (
                self.big.groupBy(*self.parts)
                .agg(F.sum(value).alias("_sum"))
                .select(*self.parts, F.sum("_sum").over(self._before()).alias("_carry"))
            )
            out = (
                out.join(F.broadcast(carried), self.parts, "left")
                .withColumn(end, F.col(end) + F.coalesce("_carry", F.lit(0)))
                .drop("_carry")
            )
        return out.withColumn(start, F.col(end) - F.col(value))

    def last_seen(self, columns: list[str]) -> DataFrame:
        """Fill each of ``columns`` with its last non-null value along the order."""
        out = self.df
        filled = {c: F.last(c, ignorenulls=True).over(self._window()) for c in columns}
        if self.big is None:
            return out.withColumns(filled)
        at = F.struct(*self.order)
        ends = self.big.groupBy(*self.parts).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
        )
        carried = ends.select(
            *self.parts,
            *[F.last(c, ignorenulls=True).over(self._before()).alias(f"_carry_{c}") for c in columns],
        )
        out = out.withColumns(filled).join(F.broadcast(carried), self.parts, "left")
        return out.withColumns({c: F.coalesce(c, f"_carry_{c}") for c in columns}).drop(
            *[f"_carry_{c}" for c in columns]
        )


def chunk_groups(
    df: DataFrame, keys: list[str], order: list[str], hot: HotKeys, reread: bool = False
) -> Chunked:
    """Cut the hot keys of ``df`` into chunks; leave the others whole.

    Without hot keys this adds a constant and nothing else. With them, only
    their rows pass the extra range shuffle, which is written out so that chunk
    numbers are the same wherever they are used. ``df`` is then read three times:
    ``reread`` says it is a scan for which that is cheaper than writing it.
    """
    if hot.table is None:
        return Chunked(df.withColumn(CHUNK, F.lit(0)), keys, order)
    listed = F.broadcast(hot.table)
    if not reread:
        df = materialize(df, "groups")
    parts = -(-hot.rows // hot.limit)
    big = materialize(
        df.join(listed, keys, "left_semi")
        .repartitionByRange(parts, *keys, *order)
        .withColumn(CHUNK, F.spark_partition_id() + 1),
        "chunks",
    )
    rest = df.join(listed, keys, "left_anti").withColumn(CHUNK, F.lit(0))
    return Chunked(rest.unionByName(big), keys, order, big)


def overlap_pairs(
    supply: DataFrame,
    draws: DataFrame,
    keys: list[str],
    hot: HotKeys,
) -> DataFrame:
    """Match two sets of disjoint intervals on one line per key.

    ``supply`` has ``keys, lot_id, start, end``; ``draws`` has ``keys, demand_id,
    start, end``. Each overlap begins where the later of its two intervals
    starts, so a pass over all starts with the last seen interval of both sides
    finds every pair: at most one row per input row, and no join.
    """
    def starts(df: DataFrame, kind: int) -> DataFrame:
        held = F.struct(F.col("lot_id" if kind == 0 else "demand_id").alias("id"), F.col("end"))
        none = F.lit(None).cast("struct<id:string,end:bigint>")
        return df.where(F.col("end") > F.col("start")).select(
            *keys,
            F.col("start").alias("pos"),
            F.lit(kind).alias("kind"),
            (held if kind == 0 else none).alias("lot"),
            (held if kind == 1 else none).alias("draw"),
        )

    events = starts(supply, 0).unionByName(starts(draws, 1))
    seen = chunk_groups(events, keys, ["pos", "kind"], hot).last_seen(["lot", "draw"])
    qty = F.least("lot.end", "draw.end") - F.col("pos")
    return (
        seen.where(F.col("lot").isNotNull() & F.col("draw").isNotNull())
        .select(*keys, F.col("lot.id").alias("lot_id"), F.col("draw.id").alias("demand_id"), qty.alias("units"))
        .where(F.col("units") > 0)
    )


def scattered(key: Column, has_match: Column, *salt: str) -> Column:
    """A text join key whose rows without a match are spread over many values.

    For left joins where one key, such as blank or NULL, has no row on the right
    but a large part of the left.
    """
    other = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*salt), F.lit(65536)).cast("string"))
    return F.when(has_match, key).otherwise(other)


def milli(qty: Column) -> Column:
    """Quantity with three decimals as whole thousandths, exact in a long."""
    return F.round(qty * 1000).cast("bigint")


def from_milli(units: Column) -> Column:
    return (units.cast("decimal(20,0)") / F.lit(1000)).cast("decimal(13,3)")
