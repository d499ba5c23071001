"""Daily snapshots as intervals: a row is stored once for all the days on which it does not change.

Intervals hold the columns of the snapshot, ``copies`` (equal rows of one day),
``valid_from`` (the first day) and ``valid_to`` (the first day without it; NULL
while it still holds). Days are text that sorts by date.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOUNDS = ["copies", "valid_from", "valid_to"]


def merge_day(running: DataFrame, ended: DataFrame, snapshot: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """The intervals that hold after ``day``, and those that end on it, from those before it and the day's rows.

    ``running`` are the open intervals, ``ended`` the others. If the day was merged
    before, its first merge is undone: what ended on it holds again, what began
    on it goes. A day before the last one is refused. Rows are compared by all
    columns, NULL like a value; both sides pass one shuffle.
    """
    last = running.agg(F.max("valid_from")).first()[0], ended.agg(F.max("valid_to")).first()[0]
    if max(d or "" for d in last) > day:
        raise ValueError(f"{day} lies before a day that is already merged")
    columns = snapshot.columns
    began, none = F.col("valid_from"), F.lit(None)
    stood = running.where(began < day).unionByName(ended.where((F.col("valid_to") == day) & (began < day)))
    before = stood.select(*columns, F.col("copies").alias("_old"), began.alias("_from"), none.cast("long").alias("_new"))
    today = snapshot.groupBy(*columns).agg(F.count(F.lit(1)).alias("_new"))
    today = today.select(*columns, none.cast("long").alias("_old"), none.cast("string").alias("_from"), "_new")
    both = before.unionByName(today).groupBy(*columns).agg(*[F.max(c).alias(c) for c in ("_old", "_from", "_new")])
    same = F.col("_old").eqNullSafe(F.col("_new"))
    holds = both.where(F.col("_new").isNotNull()).select(
        *columns,
        F.col("_new").alias("copies"),
        F.when(same, F.col("_from")).otherwise(F.lit(day)).alias("valid_from"),
        none.cast("string").alias("valid_to"),
    )
    over = both.where(F.col("_old").isNotNull() & ~same).select(
        *columns, F.col("_old").alias("copies"), F.col("_from").alias("valid_from"), F.lit(day).alias("valid_to")
    )
    return holds, over


def as_of(intervals: DataFrame, day: str) -> DataFrame:
    """The snapshot that held on ``day``, row by row; a day without one shows the last before it."""
    held = (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))
    rows = intervals.where(held).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.drop("_copy", *BOUNDS)


def as_of_join(events: DataFrame, intervals: DataFrame, on: list[str], day: str) -> DataFrame:
    """Every event with the row of its keys that held on its ``day``; the columns of ``intervals`` are NULL without one.

    An event meets each row of its keys that held then, equal rows once. Columns
    that the events have as well are those of the events. The keys shuffle as in
    any join, the interval is a condition on it; NULL keys match nothing.
    """
    held = intervals.select(F.struct("*").alias("_held"))
    match = [F.col(c) == F.col(f"_held.{c}") for c in on]
    since, until = F.col("_held.valid_from"), F.col("_held.valid_to")
    match += [since <= F.col(day), until.isNull() | (until > F.col(day))]
    added = [F.col(f"_held.{c}") for c in intervals.columns if c not in (*events.columns, *BOUNDS)]
    return events.join(held, reduce(and_, match), "left").select(*events.columns, *added)
