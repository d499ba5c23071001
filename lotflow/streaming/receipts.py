"""The index of first receipts kept by a file stream of document lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lotflow.plans.jobs import run_first_receipts
from lotflow.sources.schemas import ERP
from lotflow.sources.tables import CLIENT, of_client


def stream_first_receipts(
    spark: SparkSession,
    lines_path: str,
    headers_path: str,
    work: str,
    checkpoint: str,
    client: str = CLIENT,
) -> StreamingQuery:
    """Load the line files that arrived since the last run, then stop.

    Each micro-batch is one incremental load: it appends batches the index does
    not hold, so a batch that is replayed after a failure appends nothing. Header
    files have to arrive no later than their lines.
    """
    lines = of_client(spark.readStream.schema(ERP["mseg"]).parquet(lines_path), client)

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        headers = of_client(session.read.schema(ERP["mkpf"]).parquet(headers_path), client)
        run_first_receipts(session, work, batch, headers)

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
