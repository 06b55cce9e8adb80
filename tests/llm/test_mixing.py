import pytest
from pyspark.sql import functions as F

from basketflow.llm import mixing


def shares(sizes):
    """Water filling step by step, over {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        out = {s: 3.0 * sizes[s] if s in full
               else left * weight[s] / sum(weight[o] for o in open_) for s in order}
        above = {s for s in open_ if out[s] > 3 * sizes[s]}
        if not above:
            return out
        full |= above


def per_source(rows):
    out = {}
    for r in rows:
        got = out.setdefault(r.source, [0, 0, r.target])
        got[0] += r.size
        got[1] += r.taken
    return out


def verify(docs, near):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count()
    by = per_source(rows)
    want = shares({s: v[0] for s, v in by.items()})
    for source, (size, taken, target) in by.items():
        assert target == pytest.approx(want[source], rel=1e-9)
        assert all(r.source_size == size for r in rows if r.source == source)
        assert abs(taken - target) <= near * max(target, 1), source
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rows)
    return rows


def test_small_table_meets_targets(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    first = verify(docs, 0.02)
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_rates_solve_the_dual(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mixed(docs).groupBy("source").agg(
        F.sum(F.col("rate") * F.col("size")).alias("words"), F.max("target").alias("target"))
    for r in got.collect():
        assert r.words == pytest.approx(r.target, rel=1e-6)


def test_limits_and_null_sources(make):
    rows = [(k, "w " * (k % 9 + 1), "en", "a") for k in range(6)]
    rows += [(100 + k, "w " * (k % 31 + 1), "en", "b") for k in range(900)]
    rows += [(2000 + k, "w " * (k % 17 + 1), "en", None) for k in range(300)]
    out = verify(make(*rows), 0.05)
    assert {r.copies for r in out if r.source == "a"} == {3}


def test_odd_rows(odd):
    rows = mixing.mixed(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.copies == 1 and r.taken == 0 for r in rows if r.size == 0)
    assert mixing.repeat(odd).columns == odd.columns


def test_repeat_follows_copies(make):
    docs = make(*[(k, f"t{k} " * (k % 5 + 1), "en", "abc"[k % 3]) for k in range(60)])
    copies = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    got = {r.doc_id: r["count"] for r in mixing.repeat(docs).groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in copies.items() if c}


def test_no_rows(nothing):
    assert mixing.mixed(nothing).count() == 0


def test_no_python_on_the_main_path(odd):
    plan = mixing.mixed(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
