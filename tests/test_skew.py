"""A third of all rows on one user, product, brand, day and instant must not change results or
land in one task."""

import collections
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketflow.operators.funnel import funnel_daily
from basketflow.operators.replay import replay_slices
from basketflow.operators.rollups import item_stats_daily
from basketflow.plans.serving import product_ranking
from basketflow.session import tune
from basketflow.sources.files import read_detail, write_detail
from builders import events, row

N = 6000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = []
    for i in range(N):
        kind = rng.choice(["view", "cart", "purchase"])
        if i % 3 == 0:
            made.append(row("2024-01-02 00:00:00", kind, user=1, product=1, price="2.50"))
        else:
            made.append(row(f"2024-01-0{rng.randrange(1, 6)} 0{rng.randrange(10)}:00:00", kind,
                            user=rng.randrange(50), product=rng.randrange(30),
                            price=f"{rng.randrange(1, 900)}.25", brand=f"b{rng.randrange(3)}"))
    return made


@pytest.fixture(scope="module")
def frame(spark, rows):
    return events(spark, rows).repartition(8)


def test_funnel_against_brute_force(frame, rows):
    want = collections.defaultdict(lambda: [0, set(), Decimal(0)])
    for r in rows:
        day = want[r[9]]
        if r[1] == "view":
            day[0] += 1
            day[1].add(r[7])
        elif r[1] == "purchase":
            day[2] += r[6]
    got = {r.event_date: (r.view_cnt, r.view_uv, r.gmv) for r in funnel_daily(frame).collect()}
    assert got == {d: (v, len(u), g) for d, (v, u, g) in want.items()}


def test_items_against_brute_force(frame, rows):
    want = collections.defaultdict(lambda: [set(), ""])
    for r in rows:
        item = want[(r[9], r[3], r[2])]
        item[1] = max(item[1], r[5])
        if r[1] == "view":
            item[0].add(r[7])
    got = {(r.event_date, r.category_id, r.product_id): (r.view_uv, r.brand)
           for r in item_stats_daily(frame).collect()}
    assert got == {k: (len(u), b) for k, (u, b) in want.items()}


def test_product_ranking_against_brute_force(frame, rows):
    gmv, users = collections.Counter(), collections.defaultdict(set)
    for r in rows:
        users[r[2]].add(r[7])
        if r[1] == "purchase":
            gmv[r[2]] += r[6]
    want = sorted(users, key=lambda p: (-gmv[p], p))[:20]
    got = product_ranking(frame).collect()
    assert [r.product_id for r in got] == want
    assert [r.uv for r in got] == [len(users[p]) for p in want]


def test_hot_day_becomes_several_files(spark, frame, tmp_path):
    path = str(tmp_path / "detail")
    write_detail(frame, path, files=8)
    assert len(list((tmp_path / "detail" / "event_date=2024-01-02").glob("*.parquet"))) >= 3
    assert read_detail(spark, path).exceptAll(frame).count() == 0
    assert read_detail(spark, path).count() == N


def test_hot_instant_is_spread_over_slices(frame):
    sizes = replay_slices(frame, 8).groupBy("slice").count().collect()
    assert sum(r["count"] for r in sizes) == N
    assert max(r["count"] for r in sizes) < N / 4


def test_map_side_combine_collapses_the_hot_user(frame):
    """Rows entering the first shuffle are bounded by distinct (day, user) per task."""
    pairs = frame.groupBy(F.spark_partition_id(), "event_date", "user_id").count().count()
    assert pairs < N
    plan = funnel_daily(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") > 0


def test_skewed_join_is_split_before_a_grouping_on_its_key(spark, sf_dir):
    """A product join already clusters by product. Only the forced split keeps a later grouping
    by product from leaving a hot product in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tune(spark)
        products = spark.read.parquet(f"{sf_dir}/part.parquet").select(
            F.col("p_partkey").alias("product_id"), "p_brand")
        spread = F.pmod(F.xxhash64("id"), F.lit(200))
        big = spark.range(0, 200_000, 1, 6).select(
            "id", F.when(F.col("id") % 3 == 0, 1).otherwise(spread).alias("product_id"))
        payload = F.xxhash64("id", "p_brand") % 1000
        counted = big.join(products, "product_id").groupBy("product_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(payload).alias("s"))
        assert sum(r.n for r in counted.collect()) == 200_000
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
