"""Tables replaced as a whole or by key."""

import pytest
from pyspark.sql import functions as F

from basketflow.schema import Table
from basketflow.sources import versions

KV = Table("kv", "k bigint, v string", ("k",))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), KV.schema)


def held(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_failed_rewrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_table(spark, path, KV).count() == 0
    versions.replace_table(rows(spark, (1, "a"), (2, "b")), path)
    broken = rows(spark, (3, "c")).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        versions.replace_table(broken, path)
    assert held(versions.read_table(spark, path, KV)) == [(1, "a"), (2, "b")]
    versions.replace_table(rows(spark, (4, "d")), path)
    assert held(versions.read_table(spark, path, KV)) == [(4, "d")]


def test_a_reader_keeps_its_files_while_the_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(rows(spark, (1, "a")), path)
    reader = versions.read_table(spark, path, KV)
    versions.replace_table(rows(spark, (2, "b")), path)
    assert held(reader) == [(1, "a")]
    for i in range(4):
        versions.replace_table(rows(spark, (i, "x")), path)
    assert len(list((tmp_path / "t").glob("_version=*"))) == versions.KEPT


def test_a_version_without_its_mark_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_table(rows(spark, (1, "a")), path)
    versions.replace_table(rows(spark, (2, "b")), path)
    newest = max((tmp_path / "t").glob("_version=*"))
    (newest / "_SUCCESS").unlink()
    assert held(versions.read_table(spark, path, KV)) == [(1, "a")]
    versions.replace_table(rows(spark, (3, "c")), path)
    assert held(versions.read_table(spark, path, KV)) == [(3, "c")]


def test_keys_are_replaced_and_other_buckets_left_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(i, f"v{i}") for i in range(200)]
    assert versions.replace_keys(rows(spark, *first), path, KV, 16) == list(range(16))
    touched = versions.replace_keys(rows(spark, (7, "new"), (1000, "more")), path, KV, 16)
    assert 1 <= len(touched) <= 2
    want = sorted([(k, v) for k, v in first if k != 7] + [(7, "new"), (1000, "more")])
    assert held(versions.read_keys(spark, path, KV)) == want
    second = sorted((tmp_path / "t").glob("_version=*"))[1]
    assert {int(b.name.split("=")[1]) for b in second.glob("_bucket=*")} == set(touched)
    for i in range(4):                                      # replaced buckets do not pile up
        versions.replace_keys(rows(spark, (7, f"again{i}")), path, KV, 16)
    bucket = touched[0] if len(touched) == 1 else None
    sizes = [len(list((tmp_path / "t").glob(f"_version=*/_bucket={b}"))) for b in range(16)]
    assert max(sizes) <= versions.KEPT and min(sizes) == 1 or bucket is not None
    assert held(versions.read_keys(spark, path, KV)) == sorted(
        [(k, v) for k, v in want if k != 7] + [(7, "again3")])


def test_odd_changes_of_keyed_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.replace_keys(rows(spark), path, KV, 4) == []
    assert versions.read_keys(spark, path, KV).count() == 0
    versions.replace_keys(rows(spark, (1, None), (None, "null key")), path, KV, 4)
    versions.replace_keys(rows(spark, (1, "a")), path, KV, 4)
    assert held(versions.read_keys(spark, path, KV).filter("k IS NOT NULL")) == [(1, "a")]
    with pytest.raises(ValueError, match="4 buckets"):
        versions.replace_keys(rows(spark, (1, "b")), path, KV, 8)
