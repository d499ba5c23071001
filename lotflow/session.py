"""Session settings and the shared scratch space that cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# AQE splits skewed join partitions and coalesces small ones. Shuffle files go when the action that made them ends.
# Document numbers and items are long texts, which zstd writes in about two thirds of the default's bytes.
# Two to five bytes of such a file, sorted order numbers above all, become a hundred in the table that a broadcast builds
# in the driver, so a file counts fifty times where Spark asks whether it is small enough to be sent to all tasks.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "50",
}

_local_scratch: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the jobs are designed for."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_dir(spark: SparkSession) -> str:
    """Folder for materialised intermediates: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may fall back to a temporary folder; on a cluster
    the folder has to be one that every executor and the driver can reach.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if not is_local(spark) and re.match(r"(?:file:/*)?/?tmp(?:/|$)", shared):
            raise RuntimeError(f"{shared} is a folder of one machine: set spark.checkpoint.dir to one all executors share")
        return shared.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="lotflow-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other call returns."""
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/lotflow/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts lineage like a reliable checkpoint, survives the loss of executors,
    keeps column pruning and size statistics for the steps that follow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few fixed rows as a plan-time constant, without a job to ship them."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) or [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.table(arrays, schema=arrow), schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
