"""What each demand phase finds in its buckets, followed on per-material totals.

The rows that reach Python hold one material each, with lists whose length is
bounded by the sourcing routes, never by the number of lots or demand lines.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.operators.routes import Routes
from lotflow.session import materialize

# tasks then need no installed copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PENDING = -1
SHARED = -1

SUPPLY_SCHEMA = (
    "matnr string, plant_no int, slot int, location_no int, total bigint, "
    "buckets array<struct<bucket:int,used:bigint,before:bigint,remaining:bigint>>"
)


def _plain_phases(routes: Routes) -> dict[int, tuple[list[int], dict[int, int], list[int]]]:
    """Phases as numbers: shared buckets, bucket per own location, shared buckets."""
    return {
        routes.plant_no[plant]: (
            [routes.bucket_no[b] for b in phase.before],
            {routes.location_no[loc]: routes.bucket_no[b] for loc, b in phase.own.items()},
            [routes.bucket_no[b] for b in phase.after],
        )
        for plant, phase in routes.phases.items()
    }


NEED, TURN, STOCK, KNOWN = range(4)


def fact(df: DataFrame, kind: int, a: str, b: str | None = None, units: str = "units", n: str | None = None) -> DataFrame:
    """Rows of one kind in the common shape; ``n`` counts the lines or lots behind a row."""
    return df.select(
        "matnr",
        F.lit(kind).alias("kind"),
        F.col(a).alias("a"),
        (F.col(b) if b else F.lit(0)).alias("b"),
        F.col(units).cast("bigint").alias("units"),
        (F.col(n) if n else F.lit(0)).cast("bigint").alias("n"),
    )


class _Supply:
    """Collects output rows column by column."""

    def __init__(self):
        self.rows, self.lengths, self.cells = [], [], []

    def add(self, material, plant, slot, location, total, buckets=None):
        n = len(material)
        if n:
            self.rows.append((material, np.full(n, plant), np.full(n, slot), np.full(n, location), total))
            self.lengths.append(np.full(n, 0 if buckets is None else buckets.shape[1]))
            if buckets is not None:
                self.cells.append(buckets.reshape(-1, 4))

    def batch(self, names: pa.Array) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        material, plant, slot, location, total = (np.concatenate(c) for c in zip(*self.rows))
        cells = np.concatenate(self.cells) if self.cells else np.zeros((0, 4), np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self.lengths))])
        fields = [("bucket", pa.int32()), ("used", pa.int64()), ("before", pa.int64()), ("remaining", pa.int64())]
        structs = pa.StructArray.from_arrays(
            [pa.array(cells[:, i], type=t) for i, (_, t) in enumerate(fields)], fields=[pa.field(*f) for f in fields]
        )
        return pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(material)),
                pa.array(plant, pa.int32()),
                pa.array(slot, pa.int32()),
                pa.array(location, pa.int32()),
                pa.array(total, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
            ],
            names=["matnr", "plant_no", "slot", "location_no", "total", "buckets"],
        )


def _fold(batch: pa.RecordBatch, phases, n_locations: int, n_buckets: int) -> pa.RecordBatch | None:
    m, n_plants = batch.num_rows, len(phases)
    items = pc.list_flatten(batch["facts"])
    owner = pc.list_parent_indices(batch["facts"]).to_numpy()
    kind, a, b, units = (items.field(n).to_numpy(zero_copy_only=False) for n in ("kind", "a", "b", "units"))

    def table(of: int, *shape: int) -> np.ndarray:
        out = np.zeros((m, *shape), dtype=np.int64)
        pick = kind == of
        at = (owner[pick], a[pick], b[pick])[: 1 + len(shape)]
        out[at] = units[pick]
        return out

    need = table(NEED, n_plants, n_locations)
    known = table(KNOWN, n_plants, n_locations)
    resolved = known.sum(axis=2) > 0
    held = table(STOCK, n_buckets)
    used = np.zeros_like(held)
    turn_of = table(TURN, n_plants)
    alive = np.ones(m, dtype=bool)
    out = _Supply()

    def serve(rows, plant, slot, location, wanted, buckets):
        """Offer the buckets in turn to a total of ``wanted``; returns the total offered."""
        at = np.ix_(rows, buckets)
        offered = held[at]
        before = np.cumsum(offered, axis=1) - offered
        total = offered.sum(axis=1)
        show = (wanted > 0) & (total > 0)
        cells = np.stack([np.broadcast_to(buckets, offered.shape), used[at], before, offered], axis=2)
        out.add(rows[show], plant, slot, location, total[show], cells[show])
        taken = np.clip(wanted[:, None] - before, 0, offered)
        held[at] -= taken
        used[at] += taken
        return total

    for turn in range(1, n_plants + 1):
        for plant in range(n_plants):
            rows = np.flatnonzero((turn_of[:, plant] == turn) & alive)
            if not len(rows):
                continue
            before, own, after = phases[plant]
            left = need[rows, plant]
            if before:
                wanted = left.sum(axis=1)
                total = serve(rows, plant, 0, SHARED, wanted, before)
                if not own:
                    continue
                rest = np.maximum(wanted - total, 0)
                one = (left > 0).sum(axis=1) == 1
                clear = one | (rest == 0) | (total == 0)
                wait = ~clear & ~resolved[rows, plant]
                out.add(rows[wait], plant, PENDING, SHARED, total[wait])
                left = np.where(clear[:, None], np.where(left > 0, np.minimum(left, rest[:, None]), 0), known[rows, plant])
                alive[rows[wait]] = False
                rows, left = rows[~wait], left[~wait]
            for location, bucket in own.items():
                total = serve(rows, plant, 1, location, left[:, location], [bucket])
                left[:, location] = np.maximum(left[:, location] - total, 0)
            if after:
                serve(rows, plant, 2, SHARED, left.sum(axis=1), after)
    return out.batch(batch["matnr"])


def fold_materials(facts: DataFrame, routes: Routes) -> tuple[DataFrame, DataFrame | None]:
    """Follow the phases of every material.

    ``facts`` has one row per (plant, own location) need, per plant's turn and per
    bucket of a material, so the list made of them here is bounded by the routes.

    Returns what each slot of each phase finds (per bucket: used up so far and
    remaining), and the phases that cannot be entered before it is known how the
    shared sources of their first slot were spread over the own locations.
    """
    phases = _plain_phases(routes)
    n_locations, n_buckets = len(routes.locations), len(routes.buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = _fold(batch, phases, n_locations, n_buckets) if batch.num_rows else None
            if result is not None:
                yield result

    materials = facts.groupBy("matnr").agg(F.collect_list(F.struct("kind", "a", "b", "units")).alias("facts"))
    rows = materialize(materials.mapInArrow(run, SUPPLY_SCHEMA), "supply")
    supply = rows.where(F.col("slot") >= 0)
    if not any(phase.before and phase.own for phase in routes.phases.values()):
        return supply, None
    pending = rows.where(F.col("slot") == PENDING).select("matnr", "plant_no", "total")
    return supply, pending
