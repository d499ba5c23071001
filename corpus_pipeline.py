"""The corpus pipeline: each stage's result is written as Parquet and read again as the documents of the next.

All stages but the last return the columns of the documents they are given. Null
and empty texts go with the first stage, as no language is found in them; every
later stage takes an empty table and returns one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotflow.llm.common import small_batches, table
from lotflow.llm.decontaminate import drop_contaminated
from lotflow.llm.langid import keep_identified
from lotflow.llm.neardup import keep_one
from lotflow.llm.packing import pack_documents
from lotflow.llm.secrets import redact
from lotflow.llm.tokens import public
from lotflow.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found."""
    small_batches(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words and a similarity of 0.8."""
    small_batches(spark)
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty lies in benchmark windows."""
    small_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    small_batches(spark)
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids."""
    small_batches(spark)
    return pack_documents(docs, public("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("packing", packing),
]

#: Models and tokenizers are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
