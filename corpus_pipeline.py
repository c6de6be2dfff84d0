"""The corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator on all that the stage before kept; its rows are
written and read again as the next stage's documents.  All stages but the last
return the columns of ``documents``; ``n_chars`` follows a changed text.

Null texts stay null until they are packed as empty texts; empty tables pass
through every stage; further columns of the documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.llm import hamming, line_runs, ordinal, packing, secrets
from oreline.llm.queries import vocabulary
from oreline.session import scratch_path

#: Least similarity of near duplicates on word shingles; the 85 of op9 is that query's own.
NEAR_PERCENT = 80
#: A line of more words is a repeated run by itself, whatever its neighbours.
ALONE_WORDS = 50


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def accept_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ordinal classifier fitted on the labelled documents; rejected documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal.select(docs, ordinal.train(docs, ordinal.graded(labels)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents that lose every line that way."""
    return _measured(line_runs.dedup(docs, alone_words=ALONE_WORDS).where(~F.col("_op7_empty")).select(*docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays."""
    return hamming.survivors(docs, percent=NEAR_PERCENT)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings of the secret scan are masked; every document stays."""
    return _measured(secrets.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary(), vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", accept_good),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_each_group),
    ("secret scan", mask_secrets),
    ("packing", pack_sequences),
]

#: Fitting, hashing and tokenising cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}")
        docs = spark.read.parquet(f"{base}/{number}")
    return docs
