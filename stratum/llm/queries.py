"""Every operator of this package on its whole table, with production parameters; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import oracles
from .clusters import cluster_vectors
from .compact_windows import similar_passages
from .exact_dedup import exact_dedup
from .merkle import dataset_manifest
from .minmax import near_duplicates
from .mixing import mixed_documents
from .multiset import compare_with_edits
from .packing import pack, token_pieces
from .pieces import encode_decode_digests
from .pii import pii_digests
from .previous_factor import remove_repeats
from .quality import score_documents
from .sharding import lpt_shards

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query("op1_compact_windows")
def op1(spark, sf):
    return similar_passages(documents(spark, sf))


@query("op2_minmax_near_dedup")
def op2(spark, sf):
    return near_duplicates(documents(spark, sf), words=2, percent=80)


@query("op3_lpt_shards")
def op3(spark, sf):
    from pyspark.sql import functions as F

    out = lpt_shards(documents(spark, sf), shards=40)
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


@query("op4_pattern_packing")
def op4(spark, sf):
    pieces = token_pieces(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op5_exact_dedup", oracles.EXACT_DEDUP)
def op5(spark, sf):
    return exact_dedup(documents(spark, sf), batches=2)


@query("op6_previous_factor")
def op6(spark, sf):
    return remove_repeats(documents(spark, sf))


@query("op7_rule_ensemble")
def op7(spark, sf):
    return score_documents(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))[0]


@query("op8_pii_spans")
def op8(spark, sf):
    return pii_digests(documents(spark, sf))


@query("op9_multiset_fingerprints")
def op9(spark, sf):
    return compare_with_edits(documents(spark, sf))


@query("op10_piece_encoding")
def op10(spark, sf):
    return encode_decode_digests(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_merkle_manifest", oracles.merkle())
def op11(spark, sf):
    return dataset_manifest(documents(spark, sf))


@query("op12_threshold_clusters", oracles.clusters())
def op12(spark, sf):
    return cluster_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op13_low_discrepancy_mix", oracles.MIXING)
def op13(spark, sf):
    return mixed_documents(documents(spark, sf))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
