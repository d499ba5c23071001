"""Token counts with a digest cache.

Method: the normalised content (null as empty text; these tokenizers normalise
inside the library, so nothing else may change) and the tokenizer's file are each
named by a SHA-256 digest. Contents whose pair of digests is in the cache are
counted from it; of the others one copy each is encoded and appended.
"""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, sha, table, texts
from lotflow.llm.tokens import encoder, public, version
from lotflow.session import scratch_path

CACHE = "digest binary, tokenizer string, n_tokens bigint"


def read_cache(spark, path: str, tokenizer: str) -> DataFrame | None:
    """The stored counts of a tokenizer version, one row per digest; None if there is no cache yet."""
    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    stored = stored.where(F.col("tokenizer") == tokenizer)
    # Two jobs may have stored the same content.
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row's whole text.

    ``tokenizer``: path of a tokenizer file that executors can read. ``cache``: a
    shared folder that outlives the job; without one the counts are kept in the
    session's scratch folder. Null text counts as empty (0 bytes, 0 tokens). Rows
    with equal ids or texts each get their row; null ids stay null; other columns
    are left out, whatever their names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    name, path = version(tokenizer), cache or scratch_path(spark, "token-counts")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), sha(text).alias("digest"))

    wanted = rows.groupBy("digest").agg(F.min("id").alias("id"))
    stored = read_cache(spark, path, name)
    misses = wanted if stored is None else wanted.join(stored, "digest", "left_anti")
    one = misses.select(F.col("digest").alias("d"), F.col("id").alias("i"))
    copies = rows.join(one.hint("shuffle_hash"), F.col("digest").eqNullSafe(F.col("d")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")

    def make():
        encode = encoder(tokenizer).encode

        def step(batch):
            ids = encode(texts(batch))
            return {"digest": batch.column("digest"), "n_tokens": np.array([len(x) // 4 for x in ids], dtype=np.int64)}

        return step

    counted = map_arrow(copies.select("digest", "text"), "digest binary, n_tokens bigint", make)
    counted = counted.dropDuplicates(["digest"]).select("digest", F.lit(name).alias("tokenizer"), "n_tokens")
    counted.write.mode("append").parquet(path)

    sizes = rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(read_cache(spark, path, name), "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents; the cache of a query run starts empty."""
    counts = count_tokens(table(spark, sf_dir, "documents"), public("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)
