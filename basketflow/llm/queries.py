"""The training-data operators as named queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, ann, bpe, language, licenses, line_dedup, lm, mixing, near_dup, quality, runs,
               sharding, toxicity)
from . import texts as tx
from .shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TOXIC_FROM = 0.7
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 24


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", (tx.id_bucket(3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "n_hits", "n_misspelled", "n_quoted")


@query
def op6_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.references(docs))


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predicted(docs, language.learn(docs)).select(
        "doc_id", (tx.id_bucket(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op8_bpe(spark, sf_dir):
    return bpe.digested(table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op10_lm_scoring(spark, sf_dir):
    return lm.scored(table(spark, sf_dir, "documents"))


@query
def op1_near_dedup(spark, sf_dir):
    return near_dup.link(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated(docs).select(
        "doc_id", "text", F.coalesce(F.size("deleted"), F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce("deleted_words", F.lit(0)).cast("long").alias("deleted_words"), "partners")


@query
def op3_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query
def op4_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query
def op9_license_scan(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query
def op11_sharding(spark, sf_dir):
    return sharding.digested(table(spark, sf_dir, "documents"), SHARDS)


@query
def op12_periodic_runs(spark, sf_dir):
    return runs.reported(table(spark, sf_dir, "documents"), planted=True)


@query
def op13_token_alignment(spark, sf_dir):
    return alignment.aligned_documents(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)[0]
