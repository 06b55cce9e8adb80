"""A training corpus from raw documents: five stages, each a dealt operator with its decisions.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to
the shared checkpoint folder and hands the reread table to the next one. All but the last keep
the columns of documents.

Defined cases, stage by stage as in the operators' own modules: null and empty texts pass every stage
(they are not toxic, hold no lines or shingles, have size 0 and no tokens); very long texts are
treated whole; repeated rows share a verdict, and of equal documents the smallest doc_id stays; an id
that stands at several texts is judged text by text; ties go to the smaller id; an empty table gives
an empty one; extra columns, whatever their names, are carried through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import bpe, line_dedup, mixing, near_dup, toxicity
from basketflow.llm import texts as tx
from basketflow.llm.queries import TOXIC_FROM, WORD_BPE, table
from basketflow.llm.shipping import ship

# Learned lexicon, automata, near-duplicate components, Newton steps and merges: no SQL form.
# tests/llm holds near duplicates and BPE against brute force and library, the other stages against
# their operators' tests.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the lexicon is learned from the labelled ones."""
    ship(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, TOXIC_FROM)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are deleted; a text of nothing else goes."""
    ship(spark)
    edited = line_dedup.deduplicated(docs)
    return edited.filter("deleted IS NULL OR text <> ''").select(*docs.columns) \
        .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    ship(spark)
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that sources meet their shares of the words."""
    ship(spark)
    return mixing.repeat(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of every row, and digests of its ids and of the decoded text."""
    ship(spark)
    return bpe.digested(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tx.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
