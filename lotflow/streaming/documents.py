"""Receipts from two file streams, whatever arrives first: lines wait in a table for their document's header."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotflow.plans.jobs import run_receipt_corrections
from lotflow.session import local_table
from lotflow.sources import tables
from lotflow.sources.schemas import DOCUMENT, ENTERED, ERP, LINE, WORK
from lotflow.sources.tables import CLIENT, of_client


def _with_header(lines: DataFrame, headers: DataFrame, how: str) -> DataFrame:
    named = headers.select(*[F.col(c).alias(f"_{c}") for c in DOCUMENT], *ENTERED)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DOCUMENT])
    return lines.join(named, same, how).drop(*[f"_{c}" for c in DOCUMENT])


def load_documents(
    spark: SparkSession, work: str, batch: DataFrame, checkpoint: str, number: int, keep: timedelta | None = None
) -> DataFrame:
    """Load a micro-batch of lines and headers (``is_header``); returns what it changes in the index.

    ``mkpf_known`` holds the headers, ``mseg_waiting`` the lines without one. Both,
    the log of first receipts and the number of the micro-batch change in one
    commit, so a micro-batch that comes again after a failure changes nothing.
    """
    seen = tables.version(spark, work)
    loads = tables.read_work(spark, work, "stream_loads", seen).where(F.col("checkpoint") == checkpoint)
    last = loads.agg(F.max("number")).first()[0]
    if last is not None and last >= number:
        batch = batch.where(F.lit(False))
    now = int(datetime.now().timestamp() * 1000)
    known = tables.read_work(spark, work, "mkpf_known", seen)
    if keep is not None:
        known = known.where(F.col("arrived") > now - int(keep.total_seconds() * 1000))
    new = batch.where("is_header").select(*DOCUMENT, *ENTERED, F.lit(now).cast("long").alias("arrived"))
    lines = tables.read_work(spark, work, "mseg_waiting", seen).unionByName(batch.where("NOT is_header").select(*DOCUMENT, *LINE))
    headers = known.unionByName(new)
    # without a limit of time the headers only grow
    headers_as = {"replace": {"mkpf_known": headers}} if keep is not None else {"append": {"mkpf_known": new}}
    waiting = _with_header(lines, headers, "left_anti")
    load = local_table(spark, [(checkpoint, number)], WORK["stream_loads"])
    return run_receipt_corrections(
        spark, work, _with_header(lines, headers, "inner"), seen,
        replace={"mseg_waiting": waiting, **headers_as.get("replace", {})},
        append={"stream_loads": load, **headers_as.get("append", {})},
    )


def stream_receipts(
    spark: SparkSession,
    lines_path: str,
    headers_path: str,
    work: str,
    checkpoint: str,
    client: str = CLIENT,
    keep: timedelta | None = None,
    files: int = 1000,
    changed: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Load the line and header files that arrived since the last run, at most ``files`` of each at a time, then stop.

    Files may come in any order, and documents at any time: the log of first
    receipts holds the index of all documents that are complete. ``changed`` gets
    what each micro-batch changed in the index, to be passed on to lots, billing and
    edges; it may get a micro-batch again after a failure, then without changes
    that were stored. ``keep``: how long a header waits for further lines of its
    document; None is for ever. Lines wait for ever. Of several headers of a
    document the earliest counts, as in a full load.
    """

    def read(path: str, name: str) -> DataFrame:
        return of_client(spark.readStream.schema(ERP[name]).option("maxFilesPerTrigger", files).parquet(path), client)

    def load(batch: DataFrame, number: int) -> None:
        changes = load_documents(batch.sparkSession, work, batch, checkpoint, number, keep)
        if changed:
            changed(changes, number)

    lines = read(lines_path, "mseg").where(F.col("shkzg") == "S").select(*DOCUMENT, *LINE, F.lit(False).alias("is_header"))
    headers = read(headers_path, "mkpf").select(*DOCUMENT, *ENTERED, F.lit(True).alias("is_header"))
    return (
        lines.unionByName(headers, allowMissingColumns=True)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
