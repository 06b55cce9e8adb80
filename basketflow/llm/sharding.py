"""Shards by jump consistent hashing (Lamping and Veach): a key and the number of shards decide.

The jump generator is seeded with the key and draws, from shard to shard, the next one the key
would move to if shards were appended; the last draw below the number of shards is the answer.
There is no ring or table of shards. With one shard more, a key either stays or moves into the new
one, and one in (n + 1) moves. A document's shard is a column computed where the row is read: no
shuffle, and a hot group costs nothing.

``placed`` also numbers the rows of every shard. Rows are counted by (shard, key, size, checksum)
first, so equal rows travel once however many there are; those counts are dealt into strips of about
``STRIP`` by a hash, numbered inside their strip by running totals, and moved by the totals of the
strips before. Equal rows are then written out again from their count, in pieces of ``COPIES`` that
are spread over the cluster. No shard meets in one task, and no row is sorted beyond its strip. The
order inside a shard is that of the hash, thus the same in every run and under any layout.

Defined cases: keys count by their decimal text, so an id is the same as a number and as text; all
null keys are one key of their own; null texts have no bytes and checksum 0; an empty text likewise;
very long texts are only measured; ties and repeated rows get slots one after the other; an empty
table gives no rows; extra columns are not looked at (``assigned`` keeps them, and refuses a table
that has its own column of a name it adds).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import texts as tx

STRIP = 50_000      # distinct rows of a strip, about
COPIES = 100_000    # equal rows written out by one task at a time
_STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key."""
    keys = keys.astype(np.uint64)
    shard = np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys)) if shards > 1 else np.empty(0, np.int64)
    while len(moving):
        keys[moving] = keys[moving] * _STEP + np.uint64(1)
        drawn = (keys[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        onward = ((shard[moving] + 1) * (2.0 ** 31 / drawn)).astype(np.int64)
        inside = onward < shards
        moving = moving[inside]
        shard[moving] = onward[inside]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard number of a column of any type, by the decimal or textual form of its values."""
    if shards < 1:
        raise ValueError("a table needs one shard at least")

    @F.pandas_udf("int")
    def drawn(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(np.int64).view(np.uint64), shards), dtype="int32")

    return drawn(F.xxhash64(key.cast("string")))


def assigned(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """The rows with their ``shard`` and, were there one shard more, ``grown_shard``."""
    taken = {"shard", "grown_shard"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns of the table are in the way: {sorted(taken)}")
    return docs.withColumns({"shard": shard_of(docs[key], shards),
                             "grown_shard": shard_of(docs[key], shards + 1)})


def placed(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its key, size (bytes of the text and 8), checksum, shard and slot there."""
    body = F.coalesce(docs[text], F.lit(""))
    found = docs.select(docs[key].alias("key"), (F.octet_length(body) + 8).cast("long").alias("size"),
                        F.crc32(body.cast("binary")).alias("checksum")) \
        .groupBy("key", "size", "checksum").agg(F.count("*").alias("copies"))
    found = tx.stored(found.select(
        "*", shard_of(F.col("key"), shards).alias("shard"),
        F.xxhash64(F.col("key").cast("string"), "checksum", "size").alias("at")), "shard-rows")
    # Strips are ranges of the hash (its first bits), so that numbers rise with it from strip to strip.
    bits = max(1, (found.count() // (shards * STRIP)).bit_length())
    rows = found.withColumn("strip", F.shiftrightunsigned("at", 64 - bits))
    totals = rows.groupBy("shard", "strip").agg(F.sum("copies").alias("held"))
    before = totals.select(
        "shard", "strip", (F.sum("held").over(W.partitionBy("shard").orderBy("strip"))
                           - F.col("held")).alias("before"))
    in_order = W.partitionBy("shard", "strip").orderBy("at", "key", "size", "checksum") \
        .rowsBetween(W.unboundedPreceding, 0)
    inside = F.sum("copies").over(in_order) - F.col("copies")
    numbered = tx.stored(rows.withColumn("inside", inside).join(before, ["shard", "strip"])
                         .withColumn("slot", F.col("inside") + F.col("before"))
                         .select("key", "size", "checksum", "shard", "slot", "copies"), "shard-slots")
    # What is there often is cut into pieces, and the pieces are spread before they are written out.
    pieces = numbered.filter(F.col("copies") > COPIES).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES))).alias("from"))
    pieces = pieces.repartition("key", "size", "checksum", "from").select(
        "key", "size", "checksum", "shard", (F.col("slot") + F.col("from")).alias("slot"),
        F.least(F.lit(COPIES), F.col("copies") - F.col("from")).alias("copies"))
    few = numbered.filter(F.col("copies") <= COPIES).unionByName(pieces)
    return few.select("key", "size", "checksum", "shard",
                      F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("copies") - 1))
                      .alias("slot"))


def digested(docs: DataFrame, shards: int) -> DataFrame:
    """``placed`` under the law of keys, with the shard each row would have were there one more."""
    return placed(docs, shards).select(
        F.col("key").alias("doc_id"), "size", F.col("checksum").alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot",
        shard_of(F.col("key"), shards + 1).alias("grown_shard"))


def written(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """The rows as Parquet under ``path/shard=<n>``; Spark cuts large shards into several files."""
    docs.withColumn("shard", shard_of(docs[key], shards)).hint("rebalance", "shard") \
        .write.partitionBy("shard").parquet(path)
