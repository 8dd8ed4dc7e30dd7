"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.

Rows that are odd have the same fate in every stage as any other row: a null text counts as empty (it is scored, may be the
copy that stays of all empty texts, holds no personal data and is packed as its end id alone); a null id is kept apart from
all ids, is never linked as a near copy, and loses to a real id among equal texts; of rows that repeat id and text one
stays after ``exact_dedup``; empty tables stay empty, and columns that the stages do not know travel along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratum.llm.exact_dedup import keep_largest
from stratum.llm.minmax import keep_one
from stratum.llm.packing import pack, token_pieces
from stratum.llm.pii import redact
from stratum.llm.quality import keep_good
from stratum.session import kept, released


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z folded) the one with the largest id stays."""
    return keep_largest(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, similarity 0.8 or more."""
    return keep_one(docs, words=5, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows."""
    return redact(docs, count_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096."""
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", private), ("packing", packed)]

#: The fitted classifier, the min-max bands and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with released(spark):  # what a stage writes on its way goes when its result is there
            docs = kept(stage(spark, docs, sf_dir), f"llm-pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
