"""Row ids derived from a natural key, so that a recomputed row keeps its id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.functions.scalars import present


def row_id(key_cols: list[str]) -> Column:
    """Hash of the key columns. Each part carries its length, so no two keys have one text; NULL has none."""
    texts = [F.col(c).cast("string") for c in key_cols]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def assign_row_id(df: DataFrame, key_cols: list[str], id_col: str = "uuid") -> DataFrame:
    """Fill ``id_col`` where it is missing or blank."""
    new = row_id(key_cols)
    if id_col in df.columns:
        new = F.when(present(F.col(id_col)), F.col(id_col)).otherwise(new)
    return df.withColumn(id_col, new)
