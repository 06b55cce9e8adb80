import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.llm import sharding
from llm_helpers import rows_by_id

MASK = (1 << 64) - 1


def brute_jump(key, shards):
    shard, onward = -1, 0
    while onward < shards:
        shard = onward
        key = (key * 2862933555777941757 + 1) & MASK
        onward = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


def gapless(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_jump_matches_one_key_at_a_time():
    keys = np.random.default_rng(3).integers(0, MASK, 3000, np.uint64, endpoint=True)
    for shards in (1, 2, 3, 24, 25, 1000):
        assert sharding.jump(keys, shards).tolist() == [brute_jump(int(k), shards) for k in keys]


def test_whole_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.digested(docs, 24).collect()
    want = {r.doc_id: (len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()))
            for r in docs.collect()}
    hashes = dict(docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"))).collect())
    assert len(rows) == len(want) and gapless(rows)
    for r in rows:
        assert (r.size, r.text_crc32, r.law) == (*want[r.doc_id], "key")
        assert r.shard == brute_jump(hashes[r.doc_id] & MASK, 24)
        assert r.grown_shard == brute_jump(hashes[r.doc_id] & MASK, 25)
        assert r.grown_shard in (r.shard, 24)
    moved = sum(r.grown_shard != r.shard for r in rows)
    assert 10 <= moved <= 80                                # one in 25 of 1,000
    assert max(Counter(r.shard for r in rows).values()) < 80


def test_slots_do_not_follow_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = sorted(sharding.placed(docs, 5).collect())
    assert sorted(sharding.placed(docs.repartition(7, "source"), 5).collect()) == first


def test_hot_keys_and_copies(make, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)              # so copies are written out in pieces
    monkeypatch.setattr(sharding, "STRIP", 2)
    rows = [(1, "same")] * 100 + [(1, f"t{i}") for i in range(100)] + [(i, "same") for i in range(100)]
    got = sharding.placed(make(*rows), 4).collect()
    assert gapless(got) and len(got) == 300
    assert len({r.shard for r in got if r.key == 1}) == 1


def test_odd_rows(odd, nothing):
    got = rows_by_id(sharding.digested(odd, 24))
    assert got[1][0].size == 8 and got[1][0].text_crc32 == 0
    assert len(got[5]) == 2 and got[5][0].shard == got[5][1].shard
    assert len(got[None]) == 1 and gapless([r for rows in got.values() for r in rows])
    assert sharding.digested(nothing, 24).count() == 0


def test_assigned_keeps_columns_and_refuses_its_own(odd):
    got = sharding.assigned(odd, 3)
    assert got.columns == [*odd.columns, "shard", "grown_shard"]
    with pytest.raises(ValueError):
        sharding.assigned(got, 3)
    with pytest.raises(ValueError):
        sharding.shard_of(odd.doc_id, 0)


def test_a_number_and_its_text_are_one_key(spark):
    row = spark.range(17, 18).select(sharding.shard_of(F.col("id"), 1000).alias("a"),
                                     sharding.shard_of(F.lit("17"), 1000).alias("b")).first()
    assert row.a == row.b


def test_written_shards_hold_their_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.written(docs, str(tmp_path / "out"), 6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert back.filter(F.col("shard") != sharding.shard_of(F.col("doc_id"), 6)).count() == 0
