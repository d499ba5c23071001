"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lotflow.session import shuffle_partitions


#: Rows of an Arrow batch: whole texts are read, so fewer than the usual 10,000.
BATCH_ROWS = "2000"


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a batch of whole texts in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Give freed memory back to the system: worker processes outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_rows_since_release = 0


def releasing(function: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The function of a group, for ``applyInArrow``, giving freed memory back after every 20,000 rows that a worker takes."""

    def run(rows: pa.Table) -> pa.Table:
        global _rows_since_release
        out = function(rows)
        _rows_since_release += len(rows) + 100
        if _rows_since_release >= 20_000:
            _rows_since_release = 0
            release()
        return out

    return run


def map_arrow(df: DataFrame, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """Run a batch function on every partition; ``make`` builds it once per task.

    The function takes a record batch and returns its result columns by name, or
    yields them in parts; their length may differ from that of the batch.
    """
    schema = StructType.fromDDL(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, step = to_arrow_schema(schema), make()
        for batch in batches:
            out = step(batch)
            for part in [out] if isinstance(out, dict) else out:
                yield pa.RecordBatch.from_arrays([pa.array(part[f.name], f.type) for f in arrow], schema=arrow)
        step = out = part = None
        release()

    return df.mapInArrow(run, schema)


def append(df: DataFrame, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """Columns ``row`` (all of ``df``) and ``out`` (the results of ``ddl``): names cannot clash.

    The batch function returns one value per row and column.
    """
    given, made = df.schema, StructType.fromDDL(ddl)
    schema = StructType().add("row", given).add("out", made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, step = to_arrow_schema(made), make()
        for batch in batches:
            out = step(batch)
            row = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))
            results = pa.StructArray.from_arrays([pa.array(out[f.name], f.type) for f in arrow], fields=list(arrow))
            yield pa.RecordBatch.from_arrays([row, results], names=["row", "out"])
        step = out = row = results = None
        release()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of the texts of a batch, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def chunks(values: list, weight: Callable[[object], int], limit: int) -> Iterator[slice]:
    """Consecutive slices whose values weigh about ``limit`` together."""
    begin = total = 0
    for i, value in enumerate(values):
        total += weight(value)
        if total >= limit:
            yield slice(begin, i + 1)
            begin, total = i + 1, 0
    if begin < len(values):
        yield slice(begin, len(values))


def sha(column: Column) -> Column:
    """SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(column, 256))


def partitions(spark: SparkSession) -> int:
    return max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism)
