"""The batch jobs: read the work tables under a folder, run the operators, write them back.

Work tables are parquet folders. Snapshots are kept per run date, billing lines
per (period, channel); the index and the worklist only ever grow. A table that
is rewritten from itself is written to the scratch folder first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.operators import allocation, explosion, history, monthend, orders, receipts, report
from lotflow.session import materialize
from lotflow.sources import tables

REPORT_TABLES = (
    "mara", "makt", "marc", "lfa1", "cepct", "kna1", "knvp", "pa0002", "t001w", "t001k", "t001", "knmt", "zsd0012",
    "marax", "tcurrx", "knvvx",
)


def _stamp(as_of: datetime):
    """The time as given, whatever the zones of driver and session."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def run_first_receipts(spark: SparkSession, work: str, lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Append the new batches to the index; returns the index."""
    existing = tables.read_work(spark, work, "mch1x")
    new = materialize(receipts.first_receipt_incremental(existing, lines, headers), "mch1x")
    new.write.mode("append").parquet(f"{work}/mch1x")
    return tables.read_work(spark, work, "mch1x")


def run_receipt_corrections(
    spark: SparkSession,
    work: str,
    arrived: DataFrame,
    seen: int | None = None,
    replace: dict[str, DataFrame] | None = None,
    append: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Load receipts (lines with their entry columns) of any date; returns what they change in the index.

    ``mch1x_log`` grows by the new first receipts; the earliest per batch is the
    index, so a row that was replaced needs no deletion, and a load that is
    repeated after a failure appends nothing. ``replace`` and ``append`` name other
    work tables that change in the same commit, from version ``seen`` on.
    """
    seen = tables.version(spark, work) if seen is None else seen
    stored = receipts.ordered_receipts(tables.read_work(spark, work, "mch1x_log", seen))
    changes = materialize(receipts.receipt_changes(stored, arrived), "changes")
    new = changes.where(F.col("change") == "+").select(*receipts.ORDERED_COLUMNS)
    tables.commit(spark, work, seen, replace=replace, append={"mch1x_log": new, **(append or {})})
    return changes


def corrected_index(spark: SparkSession, work: str) -> DataFrame:
    """The index that the log of first receipts holds."""
    return receipts.ordered_receipts(tables.read_work(spark, work, "mch1x_log")).select(*receipts.INDEX_COLUMNS)


def compact_receipts(spark: SparkSession, work: str) -> None:
    """Rewrite the log of first receipts to one row per batch; a load that commits meanwhile makes this fail."""
    seen = tables.version(spark, work)
    log = receipts.ordered_receipts(tables.read_work(spark, work, "mch1x_log", seen))
    tables.publish(spark, work, {"mch1x_log": log}, seen)


def run_allocation(
    spark: SparkSession, work: str, erp: dict[str, DataFrame], as_of: datetime, since: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Allocate stock to demand; stores lots, demand, pairs and the demand without a route under the run date.

    With ``since``, the date of an earlier run, only materials whose lots or
    demand differ from it are allocated; the others keep that run's pairs.
    """
    run_date = as_of.strftime("%Y%m%d")
    index = tables.read_work(spark, work, "mch1x")
    lots = materialize(allocation.stock_lots(erp["mchbx"], index, erp["mseg"]), "lots")
    demand = materialize(allocation.demand_lines(erp["zsd0012"]), "demand")
    if since is None:
        result = allocation.waterfall_allocate(lots, demand)
    else:
        names = ("stk_mchb", "stk_mrp", "stk_aloc")
        before = [tables.current_snapshot(spark, f"{work}/{name}", since) for name in names]
        result = allocation.reallocate(allocation.before_allocation(*before), lots, demand)
    pairs = materialize(result.pairs, "pairs")
    results = {
        "stk_mchb": allocation.lot_balances(lots, pairs),
        "stk_mrp": allocation.demand_balances(demand, pairs),
        "stk_aloc": allocation.allocation_pairs(pairs),
        "stk_open": result.unrouted.select("uuid", "werks", "matnr", "bal_qty", "reason"),
    }
    for name, rows in results.items():
        tables.write_snapshot(rows.withColumn("created_at", _stamp(as_of)), f"{work}/{name}", run_date)
    stored = [tables.current_snapshot(spark, f"{work}/{name}", run_date) for name in list(results)[:3]]
    return stored[0], stored[1], stored[2]


def run_history(spark: SparkSession, work: str, run_date: str) -> DataFrame:
    """Merge the lots of a run into their intervals; returns all intervals.

    The days have to come in order; the last one may come again. Unchanged lots
    are stored once. Open intervals and those that end on the day change in one
    commit.
    """
    seen = tables.version(spark, work)
    running = tables.read_work(spark, work, "stk_mchb_open", seen)
    ended = tables.read_work(spark, work, "stk_mchb_ended", seen)
    day = tables.current_snapshot(spark, f"{work}/stk_mchb", run_date).drop("created_at")
    now, over = history.merge_day(running, ended, day, run_date)
    now, over = materialize(now, "open"), materialize(over, "ended")
    this_day = spark.range(1).select(F.lit(run_date).alias("valid_to"))
    tables.commit(
        spark, work, seen, replace={"stk_mchb_open": now}, slices={"stk_mchb_ended": (["valid_to"], over, this_day)}
    )
    return lot_history(spark, work)


def lot_history(spark: SparkSession, work: str) -> DataFrame:
    """All intervals of the lots, for ``history.as_of`` and ``history.as_of_join``."""
    return tables.read_work(spark, work, "stk_mchb_open").unionByName(tables.read_work(spark, work, "stk_mchb_ended"))


def run_stock(spark: SparkSession, work: str, erp: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """Allocation, report, and the append to the idle worklist; returns the report."""
    run_date = as_of.strftime("%Y%m%d")
    stock, _, _ = run_allocation(spark, work, erp, as_of)
    index = tables.read_work(spark, work, "mch1x")
    idle = tables.read_work(spark, work, "stk_idle")
    tables.write_snapshot(report.stock_report(stock, index, idle, erp, as_of), f"{work}/stk_report", run_date)
    rows = tables.current_snapshot(spark, f"{work}/stk_report", run_date)
    new = report.new_idle_rows(rows, idle).withColumn("created_at", _stamp(as_of))
    materialize(new, "stk_idle").write.mode("append").parquet(f"{work}/stk_idle")
    return rows


def run_month_end(
    spark: SparkSession,
    work: str,
    erp: dict[str, DataFrame],
    channel: str | None = None,
    period: str | None = None,
) -> DataFrame:
    """Trace the billing lines of unreleased slices and queue the orders behind them.

    With ``channel`` and ``period`` this is one slice; without them, every slice
    that is not released. Where the folder has commits (``tables.adopt``, or an
    explosion), slices and queue change in one commit: a failure leaves both as
    they were, and a run that another one overtook raises ``tables.Conflict``.
    Plain folders are written one after the other. Returns the queued orders.
    """
    seen = tables.version(spark, work)
    stored = tables.read_work(spark, work, "ke30x", seen)
    tracked = tables.read_work(spark, work, "aufkx", seen)
    if channel is not None and period is not None and monthend.period_released(stored, channel, period):
        return tracked.limit(0)
    released = materialize(monthend.released_slices(stored), "released")
    index = tables.read_work(spark, work, "mch1x")
    # released slices go before the lines are joined with anything
    lines = erp["ce13058"].join(released, monthend.SLICE, "left_anti")
    trace = materialize(monthend.billing_trace(lines, erp["vbrp"], index, channel, period), "ke30x")
    # a slice with stored rows but no traced ones ends up empty
    redone = monthend.slices_of(stored, channel, period).join(released, monthend.SLICE, "left_anti")
    queued = materialize(monthend.enqueue_orders(erp["aufk"], erp["jest"], tracked, trace), "aufkx")
    if seen:
        slices = {"ke30x": (monthend.SLICE, trace, materialize(redone, "redone"))}
        tables.commit(spark, work, seen, append={"aufkx": queued}, slices=slices)
    else:
        gone = materialize(redone.join(monthend.slices_of(trace), monthend.SLICE, "left_anti"), "gone")
        tables.clear_slices(gone, f"{work}/ke30x")
        tables.replace_slices(trace, f"{work}/ke30x", monthend.SLICE)
        queued.write.mode("append").parquet(f"{work}/aufkx")
    return queued


def run_explosion(spark: SparkSession, work: str, erp: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """Level all orders, explode them, store rows and orders; returns the orders."""
    seen = tables.version(spark, work)
    tracked = tables.read_work(spark, work, "aufkx", seen)
    index = tables.read_work(spark, work, "mch1x", seen)
    stored = tables.read_work(spark, work, "aufmx", seen)
    edges = orders.order_edges(erp["aufm"], erp["jest"], index)
    levelled = materialize(orders.level_orders(tracked, edges), "levelled")
    result = explosion.explode_orders(
        levelled, erp["aufm"], index, erp["afpo"], erp["ziebp023"], stored, as_of
    )
    # rows and orders become current together, unless orders were queued meanwhile
    tables.publish(spark, work, {"aufmx": result.rows, "aufkx": result.orders}, seen)
    return tables.read_work(spark, work, "aufkx")
