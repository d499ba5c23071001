"""The registered queries: each operator over ERP views of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.bindings.tables import EXTRACTED, SNAPSHOT_DAYS, driver_table, view
from lotflow.functions import scalars as S
from lotflow.operators import allocation, explosion, history, monthend, orders, receipts, report
from lotflow.operators.routes import Routes, candidate_sources
from lotflow.operators.routes import sourcing_routes as routes_of
from lotflow.plans import jobs
from lotflow.session import configure, materialize, scratch_path
from lotflow.sources import tables
from lotflow.streaming.documents import stream_receipts as start_receipts

AS_OF = datetime(2001, 12, 1, 9, 0)
AS_OF_LATE = datetime(2001, 12, 1, 15, 0)
PRIOR_ENTRY = "19990101"

# what the explosion needs of the index of first receipts
EXPLODED = ("matnr", "charg", "mblnr", "zeile", "aufnr")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Callable[["Tables"], DataFrame]) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(Tables(configure(spark), sf_dir))

    QUERIES[run.__name__] = call
    return call


# ERP extracts of a driver folder, written once per application
_EXTRACTS: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """The ERP tables of one driver folder.

    Where a table is one small file, the tables made from lineitem and orders are
    extracted to parquet once, dealt out to all cores and shared by all queries;
    larger ones are read as they are, with the columns and rows a query needs. The
    index of first receipts, the order postings that depend on it and the open demand
    are written once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in EXTRACTED and self._small:
            return self._extract(name, lambda: view(self.spark, self.sf_dir, name))
        return view(self.spark, self.sf_dir, name)

    @cached_property
    def _small(self) -> bool:
        """A test folder is one small file per table, read by a task or two; larger input is split as it is."""
        return driver_table(self.spark, self.sf_dir, "lineitem").rdd.getNumPartitions() < self.spark.sparkContext.defaultParallelism

    def _extract(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _EXTRACTS:
            rows = make()
            if self._small:
                rows = rows.repartition(self.spark.sparkContext.defaultParallelism)
            _EXTRACTS[key] = materialize(rows, name)
        return _EXTRACTS[key]

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = materialize(make(), name)
        return self._made[name]

    @property
    def receipts(self) -> DataFrame:
        """The index of first receipts, not written: for one use."""
        return receipts.first_receipt(self["mseg"], self["mkpf"])

    @property
    def mch1x(self) -> DataFrame:
        return self._extract("mch1x", lambda: self.receipts)

    @property
    def made(self) -> DataFrame:
        """What the explosion needs of the index."""
        return self._extract("made", lambda: self.receipts.select(*EXPLODED))

    @property
    def aufm(self) -> DataFrame:
        return self._extract("aufm", lambda: view(self.spark, self.sf_dir, "aufm", mch1x=self.made))

    @property
    def lots(self) -> DataFrame:
        return allocation.stock_lots(self["mchbx"], self.mch1x, self["mseg"])

    @property
    def demand(self) -> DataFrame:
        return self._extract("demand", lambda: allocation.demand_lines(self["zsd0012"]))

    @property
    def fifo_pairs(self) -> DataFrame:
        return self._once("fifo", lambda: _fifo(self).drop("matnr"))

    @property
    def pairs(self) -> DataFrame:
        return self._once("pairs", lambda: allocation.waterfall_allocate(self["mchbx"], self.demand).pairs)

    @property
    def erp(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in jobs.REPORT_TABLES}

    @property
    def split(self) -> DataFrame:
        makers = explosion.producers(self.aufm, self["afpo"])
        return explosion.split_consumption(self.aufm, self.made, makers)

    @property
    def edges(self) -> DataFrame:
        return orders.order_edges(self.aufm, self["jest"], self.made)

    @property
    def levelled(self) -> DataFrame:
        return self._once("levelled", lambda: orders.level_orders(self["aufkx"], self.edges))

    @property
    def exploded(self) -> explosion.Explosion:
        return explosion.explode_orders(
            self.levelled, self.aufm, self.made, self["afpo"], self["ziebp023"], None, AS_OF
        )


def _prior_index(t: Tables) -> DataFrame:
    return receipts.first_receipt(t["mseg"], t["mkpf"].where(F.col("cpudt") < PRIOR_ENTRY))


def _fifo(t: Tables) -> DataFrame:
    return allocation.fifo_allocate(
        t["mchbx"], t.demand, ["matnr"], allocation.LOT_ORDER, allocation.DEMAND_ORDER
    )


# ---- first receipts ----


@query
def first_receipt(t: Tables) -> DataFrame:
    return receipts.first_receipt(t["mseg"], t["mkpf"])


@query
def first_receipt_incremental(t: Tables) -> DataFrame:
    existing = materialize(_prior_index(t), "prior")
    return receipts.first_receipt_incremental(existing, t["mseg"], t["mkpf"])


@query
def run_first_receipts(t: Tables) -> DataFrame:
    """The index after a full load of the earlier documents and an incremental one of the rest."""
    path = scratch_path(t.spark, "work")
    early = t["mkpf"].where(F.col("cpudt") < PRIOR_ENTRY)
    jobs.run_first_receipts(t.spark, path, t["mseg"], early)
    return jobs.run_first_receipts(t.spark, path, t["mseg"], t["mkpf"])


def _late_changes(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The index before the documents up to PRIOR_ENTRY arrive, which are older, and what these change after the newer ones."""
    path = scratch_path(t.spark, "work")
    old = F.col("cpudt") < PRIOR_ENTRY
    first, changes = (
        jobs.run_receipt_corrections(t.spark, path, receipts.receipt_lines(t["mseg"], t["mkpf"].where(part)))
        for part in (~old, old)
    )
    return receipts.corrected(first), changes


@query
def receipt_changes(t: Tables) -> DataFrame:
    return _late_changes(t)[1]


@query
def stream_receipts(t: Tables) -> DataFrame:
    """The index after two runs of the stream: newer documents first, and half of all lines before their headers."""
    path = scratch_path(t.spark, "stream")
    half, old = F.pmod(F.xxhash64("mblnr", "zeile"), F.lit(2)) == 0, F.col("cpudt") < PRIOR_ENTRY
    for lines, headers in ((half, ~old), (~half, old)):
        t["mseg"].where(lines).write.mode("append").parquet(f"{path}/mseg")
        t["mkpf"].where(headers).write.mode("append").parquet(f"{path}/mkpf")
        start_receipts(t.spark, f"{path}/mseg", f"{path}/mkpf", f"{path}/work", f"{path}/check").awaitTermination()
    return jobs.corrected_index(t.spark, f"{path}/work")


@query
def corrected_billing(t: Tables) -> DataFrame:
    """Billing lines traced before the older documents arrived, corrected by what these change."""
    index, changes = _late_changes(t)
    stored = materialize(monthend.billing_trace(t["ce13058"], t["vbrp"], index), "ke30x")
    return monthend.replace_period(stored, monthend.correct_trace(stored, receipts.corrected(changes)))


@query
def corrected_edges(t: Tables) -> DataFrame:
    """Order edges found before the older documents arrived, corrected by what these change."""
    index, changes = _late_changes(t)
    edges = materialize(orders.order_edges(t.aufm, t["jest"], index), "edges")
    return orders.correct_edges(edges, t.aufm, t["jest"], t.made, receipts.corrected(changes))


@query
def corrected_lots(t: Tables) -> DataFrame:
    """Channels of the lots given before the older documents arrived, corrected by what these change."""
    # a correction gives the channel only: the columns of the result are carried, no others
    stock = t["mchbx"].select("uuid", "matnr", "werks", "charg", "lgort", "budat", "bal_qty")
    index, changes = _late_changes(t)
    lots = materialize(allocation.stock_lots(stock, index, t["mseg"]), "lots")
    lots = allocation.correct_lots(lots, t["mseg"], receipts.corrected(changes))
    return lots.select("uuid", "matnr", "werks", "charg", "lgort", "budat", "bal_qty", "vtweg")


# ---- stock allocation ----


@query
def snapshot_rotation(t: Tables) -> DataFrame:
    """Two runs on one day and one on the next: the log holds the last run of the first day."""
    path = scratch_path(t.spark, "snapshots")
    lots = t["mchbx"]
    tables.write_snapshot(lots.where(F.col("lgort") == "RM01"), path, "20011201")
    tables.write_snapshot(lots.where(F.col("lgort") != "RM01"), path, "20011201")
    tables.write_snapshot(lots, path, "20011202")
    log = tables.snapshot_log(t.spark, path, "20011202").drop("run_date").withColumn("part", F.lit("log"))
    current = tables.current_snapshot(t.spark, path, "20011202").withColumn("part", F.lit("current"))
    return log.unionByName(current).groupBy("part", "werks", "lgort").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bal_qty").cast("decimal(20,3)").alias("qty")
    )


def _stock_of(t: Tables, day: str, *keys: str) -> DataFrame:
    """Stock per key as it was on a day."""
    since = f"{int(day[:4]) - 2}{day[4:]}"
    held = t["mchbx"].where((F.col("budat") <= day) & (F.col("budat") > since))
    return held.groupBy(*keys).agg(F.sum("bal_qty").cast("decimal(20,3)").alias("qty"))


def _intervals(t: Tables, *keys: str) -> DataFrame:
    """The snapshots of all days merged in order, the last one twice: first without what came late."""
    none = _stock_of(t, SNAPSHOT_DAYS[0], *keys).limit(0)
    bounds = {"copies": F.lit(0).cast("long"), "valid_from": F.lit("").cast("string"), "valid_to": F.lit(None).cast("string")}
    running = ended = none.withColumns(bounds)
    last = SNAPSHOT_DAYS[-1]
    days = [(day, _stock_of(t, day, *keys)) for day in SNAPSHOT_DAYS]
    days.insert(-1, (last, _stock_of(t, SNAPSHOT_DAYS[1], *keys)))
    for day, rows in days:
        running, over = history.merge_day(running, ended, rows, day)
        running, over = materialize(running, "running"), materialize(over, "over")
        ended = ended.where(~F.col("valid_to").eqNullSafe(F.lit(day))).unionByName(over)
    return running.unionByName(ended)


@query
def stock_history(t: Tables) -> DataFrame:
    """Every day's stock from the intervals of all days."""
    intervals = _intervals(t, "matnr", "werks", "lgort")
    days = [history.as_of(intervals, day).withColumn("day", F.lit(day)) for day in SNAPSHOT_DAYS]
    return reduce(DataFrame.unionByName, days)


@query
def stock_as_of(t: Tables) -> DataFrame:
    """Stock of the material when its demand is due, by the last snapshot before."""
    lines = t.demand.select("uuid", "matnr", F.add_months(F.to_date("dat00", "yyyyMMdd"), 36).alias("due"))
    lines = lines.select("uuid", "matnr", F.date_format("due", "yyyyMMdd").alias("due"))
    return history.as_of_join(lines, _intervals(t, "matnr"), ["matnr"], "due")


@query
def reallocate(t: Tables) -> DataFrame:
    """Pairs after some materials got more stock and others new demand, from the run before."""
    few = F.crc32(F.col("matnr").cast("binary")) % 9
    lots = t["mchbx"].withColumn("bal_qty", F.when(few == 0, F.lit(1)).otherwise(F.col("bal_qty")).cast("decimal(13,3)"))
    demand = t.demand.where((few != 1) | (F.col("dat00") < "19930101"))
    pairs = materialize(allocation.waterfall_allocate(lots, demand).pairs, "pairs")
    before = allocation.Before(lots, demand, pairs)
    return allocation.allocation_pairs(allocation.reallocate(before, t["mchbx"], t.demand).pairs)


@query
def stock_lots_channel(t: Tables) -> DataFrame:
    return t.lots.select("uuid", "matnr", "werks", "charg", "lgort", "budat", "bal_qty", "vtweg")


@query
def stock_buckets(t: Tables) -> DataFrame:
    return allocation.stock_bucket(t["mchbx"]).select("uuid", "matnr", "werks", "lgort", "sto_lgort")


@query
def demand_lines(t: Tables) -> DataFrame:
    return t.demand


@query
def sourcing_routes(t: Tables) -> DataFrame:
    """The sources of every plant in order, and how many demand lines go by them."""
    lines = t.demand.groupBy(F.col("werks").alias("demand_plant")).agg(F.count(F.lit(1)).alias("n_lines"))
    routes = routes_of(t.spark).join(lines, "demand_plant", "left")
    return routes.withColumn("n_lines", F.coalesce("n_lines", F.lit(0)).cast("long"))


@query
def candidate_source_lines(t: Tables) -> DataFrame:
    return candidate_sources(t.demand).select(
        "uuid", "matnr", "werks", "lgort", "priority", "supply_plant", "supply_location"
    )


@query
def fifo_allocate(t: Tables) -> DataFrame:
    return _fifo(t)


@query
def lot_balances(t: Tables) -> DataFrame:
    return allocation.lot_balances(t["mchbx"], t.fifo_pairs).select("uuid", "matnr", "werks", "bal_qty", "alc_qty")


@query
def demand_balances(t: Tables) -> DataFrame:
    return allocation.demand_balances(t.demand, t.fifo_pairs)


@query
def waterfall_allocate(t: Tables) -> DataFrame:
    return allocation.allocation_pairs(t.pairs)


@query
def unrouted_demand(t: Tables) -> DataFrame:
    """Demand of plants that one of the routes is missing for."""
    known = {p: s for p, s in Routes().sources.items() if p not in ("381A", "921A")}
    routes = Routes({p: " ".join(s) for p, s in known.items()})
    return allocation.unrouted_demand(t.demand, routes).select("uuid", "werks", "reason")


# ---- stock report ----


@query
def partner_pivot(t: Tables) -> DataFrame:
    return report.partner_pivot(t["knvp"], t["pa0002"])


@query
def plant_currency_rate(t: Tables) -> DataFrame:
    return report.plant_currency_rate(t["t001w"], t["t001k"], t["t001"], t["tcurrx"])


@query
def open_purchase_qty(t: Tables) -> DataFrame:
    return report.open_purchase_qty(t["zsd0012"], t["mchbx"])


@query
def latest_customer_part(t: Tables) -> DataFrame:
    return report.latest_customer_part(t["knmt"], t["mchbx"])


@query
def stock_valuation(t: Tables) -> DataFrame:
    rates = report.plant_currency_rate(t["t001w"], t["t001k"], t["t001"], t["tcurrx"])
    lots = t["mchbx"].join(rates, "werks")
    amount = S.stock_amount(F.col("bal_qty"), F.col("salk3"), F.col("lbkum"), F.col("ukurs"))
    return lots.select("uuid", "werks", amount.alias("stk_amt"))


@query
def stock_aging(t: Tables) -> DataFrame:
    morning, afternoon = (S.age_days(F.col("budat"), at) for at in (AS_OF, AS_OF_LATE))
    return t["mchbx"].select(
        "uuid",
        "budat",
        morning.alias("days_0900"),
        S.age_bucket(morning).alias("aged_0900"),
        afternoon.alias("days_1500"),
        S.age_bucket(afternoon).alias("aged_1500"),
    )


@query
def stock_labels(t: Tables) -> DataFrame:
    """Category, material type, document and purchase references of every lot."""
    index = t.mch1x.select("matnr", "charg", "mjahr", "mblnr", "zeile", "ebeln", "ebelp")
    lots = t["mchbx"].join(t["mara"].select("matnr", "matkl", "mtart"), "matnr").join(index, ["matnr", "charg"], "left")
    return lots.select(
        "uuid",
        S.stock_category(F.col("werks"), F.col("lgort"), F.col("matkl"), F.col("ebeln")).alias("stk_cat"),
        S.material_type(F.col("matkl"), F.col("mtart")).alias("mtart"),
        S.document_ref(F.col("mjahr"), F.col("mblnr"), F.col("zeile")).alias("mb51"),
        S.purchase_ref(F.col("ebeln"), F.col("ebelp")).alias("po"),
    )


@query
def resolved_customers(t: Tables) -> DataFrame:
    """Customer per material and channel: the newest customer part, else the material's default."""
    parts = report.latest_customer_part(t["knmt"], t["mchbx"]).withColumnRenamed("kunnr", "part_customer")
    default = t["marax"].withColumnRenamed("kunnr", "default_customer")
    customer = S.resolve_customer(F.col("part_customer"), F.col("default_customer"))
    return parts.join(default, "matnr", "full").select("matnr", "vtweg", customer.alias("customer"))


@query
def worklist_owners(t: Tables) -> DataFrame:
    """The first worklist row of every batch with the owner it names."""
    owner = S.resolve_owner(F.col("acc_rep"), F.col("ecn_resp"), F.col("moq_resp"))
    return report.first_listed(t["stk_idle"]).select("matnr", "charg", "werks", "kunnr", owner.alias("owner"))


def _stock(t: Tables) -> DataFrame:
    return materialize(allocation.lot_balances(t.lots, t.pairs), "stock")


@query
def stock_report(t: Tables) -> DataFrame:
    rows = report.stock_report(_stock(t), t.mch1x, t["stk_idle"], t.erp, AS_OF)
    return rows.withColumn("z_datecode", F.date_format("z_datecode", "yyyyMMdd"))


@query
def idle_worklist(t: Tables) -> DataFrame:
    rows = report.stock_report(_stock(t), t.mch1x, t["stk_idle"], t.erp, AS_OF)
    return report.new_idle_rows(rows, t["stk_idle"])


@query
def run_stock(t: Tables) -> DataFrame:
    """The whole stock job; what the report table holds afterwards, per plant and category."""
    path = scratch_path(t.spark, "work")
    t["stk_idle"].write.parquet(f"{path}/stk_idle")
    source = {**t.erp, "mchbx": t["mchbx"], "mseg": t["mseg"]}
    t.receipts.write.parquet(f"{path}/mch1x")
    rows = jobs.run_stock(t.spark, path, source, AS_OF)
    return rows.groupBy("werks", "stk_cat", "stk_aged").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("idle_qty").cast("decimal(20,3)").alias("idle_qty"),
        F.sum("idle_amt").cast("decimal(20,2)").alias("idle_amt"),
    )


# ---- month end ----


def _billed_index(t: Tables) -> DataFrame:
    """What billing lines need of the index, written before they are shuffled."""
    return materialize(t.receipts.select("matnr", "charg", "budat", "aufnr"), "made")


@query
def released_slices(t: Tables) -> DataFrame:
    return monthend.released_slices(t["ke30x_prior"])


@query
def billing_trace(t: Tables) -> DataFrame:
    return monthend.billing_trace(t["ce13058"], t["vbrp"], _billed_index(t))


@query
def replace_period(t: Tables) -> DataFrame:
    """Rows per slice after all traced slices took the place of the stored ones."""
    trace = monthend.billing_trace(t["ce13058"], t["vbrp"], _billed_index(t))
    trace = materialize(trace.select("perio", "vtweg", "rldat", "vvr10"), "trace")
    return monthend.replace_period(t["ke30x_prior"], trace).groupBy("perio", "vtweg", "rldat").agg(
        F.count(F.lit(1)).alias("n"), F.sum("vvr10").cast("decimal(20,2)").alias("vvr10")
    )


@query
def enqueue_orders(t: Tables) -> DataFrame:
    return monthend.enqueue_orders(t["aufk"], t["jest"], t["aufkx"], t["ke30x_prior"])


@query
def run_month_end(t: Tables) -> DataFrame:
    """The month-end job for every slice, on top of stored slices; orders queued by it."""
    path = scratch_path(t.spark, "work")
    source = {name: t[name] for name in ("ce13058", "vbrp", "aufk", "jest")}
    tables.replace_slices(t["ke30x_prior"], f"{path}/ke30x", monthend.SLICE)
    t["aufkx"].write.parquet(f"{path}/aufkx")
    t.receipts.write.parquet(f"{path}/mch1x")
    return jobs.run_month_end(t.spark, path, source)


@query
def month_end_slices(t: Tables) -> DataFrame:
    """All billing lines in the files after the month-end job has changed slices and queue in one commit."""
    path = scratch_path(t.spark, "work")
    source = {name: t[name] for name in ("ce13058", "vbrp", "aufk", "jest")}
    tables.replace_slices(t["ke30x_prior"], f"{path}/ke30x", monthend.SLICE)
    t["aufkx"].write.parquet(f"{path}/aufkx")
    t.receipts.write.parquet(f"{path}/mch1x")
    tables.adopt(t.spark, path, ["ke30x", "aufkx"])
    jobs.run_month_end(t.spark, path, source)
    return tables.read_work(t.spark, path, "ke30x").select(*monthend.TRACE_COLUMNS)


# ---- order explosion ----


@query
def reset_orders(t: Tables) -> DataFrame:
    """All orders start over but those that the explosion has done."""
    return orders.reset_orders(t.exploded.orders)


@query
def order_edges(t: Tables) -> DataFrame:
    return t.edges


@query
def order_levels(t: Tables) -> DataFrame:
    levels, _ = orders.order_levels(t["aufkx"], t.edges)
    return levels


@query
def level_orders(t: Tables) -> DataFrame:
    return t.levelled


@query
def order_output_qty(t: Tables) -> DataFrame:
    return explosion.order_output_qty(t.aufm)


@query
def split_consumption(t: Tables) -> DataFrame:
    return t.split


@query
def wip_factors(t: Tables) -> DataFrame:
    return explosion.wip_postings(t.split)


@query
def order_readiness(t: Tables) -> DataFrame:
    state = explosion.readiness(t.levelled, explosion.wip_postings(t.split))
    return explosion.settle_orders(t.levelled, state, AS_OF)


@query
def wip_marker_rows(t: Tables) -> DataFrame:
    return explosion.wip_marker_rows(explosion.wip_postings(t.split))


@query
def bonded_bom_rows(t: Tables) -> DataFrame:
    return explosion.bonded_bom_rows(explosion.wip_postings(t.split), t["ziebp023"])


@query
def pure_material_rows(t: Tables) -> DataFrame:
    return explosion.pure_material_rows(t.split)


@query
def inherit_child_rows(t: Tables) -> DataFrame:
    """One step up: the direct rows of every producer under its consumers."""
    split = materialize(t.split, "split")
    return explosion.inherit_child_rows(
        explosion.wip_postings(split), explosion.pure_material_rows(split)
    )


@query
def explode_orders(t: Tables) -> DataFrame:
    return t.exploded.rows


@query
def reexplode_orders(t: Tables) -> DataFrame:
    """All rows after an explosion of postings of which every ninth order lacks its last ones, and one of what these change."""
    early = t.aufm.join(t["afpo"].where(F.pmod(F.xxhash64("aufnr"), F.lit(9)) == 0).select("aufnr"), "aufnr", "left_anti")
    late = t.aufm.join(early.select("aufnr").distinct(), "aufnr", "left_anti").where(F.col("zeile") < "0003")
    before = materialize(early.unionByName(late), "before")
    sources = (t.made, t["afpo"], t["ziebp023"])
    first = explosion.explode_orders(t.levelled, before, *sources, None, AS_OF)
    stored = materialize(first.rows, "stored")
    changed = explosion.changed_orders(before, t.aufm)
    delta = explosion.reexplode_orders(materialize(first.orders, "orders"), changed, t.aufm, *sources, stored, AS_OF)
    return explosion.apply_delta(stored, delta)


@query
def material_totals(t: Tables) -> DataFrame:
    """Raw material per order by coefficients, equal to the sums of the exploded rows."""
    split = materialize(t.split.select(*explosion.TOTALLED), "split")
    wip = explosion.wip_postings(split)
    ready = explosion.readiness(t.levelled, wip).ready
    wip = materialize(wip.join(ready, "aufnr", "left_semi"), "wip")
    totals = explosion.material_totals(ready, wip, explosion.own_use(split.join(ready, "aufnr", "left_semi"), wip, t["ziebp023"]))
    milli = lambda c: F.floor(F.col(c) * 1000 + 0.3137).cast("long").alias(f"{c}_milli")
    return totals.select("aufnr", "matnr", "charg", "meins", milli("qty"), milli("amt"))


@query
def run_explosion(t: Tables) -> DataFrame:
    """The whole explosion job; the order table it leaves."""
    path = scratch_path(t.spark, "work")
    source = {"aufm": t.aufm, **{name: t[name] for name in ("jest", "afpo", "ziebp023")}}
    t["aufkx"].write.parquet(f"{path}/aufkx")
    # the postings depend on the same index: it is made once
    t.made.write.parquet(f"{path}/mch1x")
    return jobs.run_explosion(t.spark, path, source, AS_OF)
