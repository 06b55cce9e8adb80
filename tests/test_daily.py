"""Tables brought up to date from new days and kept state."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from basketflow.operators import increments, rollups, sketches
from basketflow.operators.cleaning import filter_date_range
from basketflow.operators.retention import retention_matrix
from basketflow.plans import daily
from basketflow.plans.jobs import main
from basketflow.schema import BRAND_SKETCHES, USER_ACTIVITY
from basketflow.sources.files import read_detail, write_detail
from basketflow.sources.star import behavior
from builders import events, row
from test_plans import plan_of

D = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def detail(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily") / "detail")
    write_detail(behavior(spark, sf_dir), path)
    return path


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_day_by_day_equals_the_whole(spark, detail, tmp_path):
    frame = read_detail(spark, detail).filter("event_date < '2024-01-05'")
    out = str(tmp_path / "out")
    days = sorted(r[0] for r in frame.select("event_date").distinct().collect())
    for day in [*days[:3], *days[2:]]:          # one day twice
        daily.update(frame, out, day, day)
    assert same(daily.retention(spark, out), retention_matrix(frame))
    assert same(daily.active_users(spark, out), rollups.active_user_daily(frame))
    assert daily.sketches(spark, out).count() == frame.select("event_date", "brand").distinct().count()
    assert daily.users(spark, out).count() == frame.select("user_id").distinct().count()


def test_masks_take_days_in_any_order(spark, detail):
    frame = read_detail(spark, detail).filter("event_date < '2024-01-07'")
    days = sorted(r[0] for r in frame.select("event_date").distinct().collect())
    random.Random(3).shuffle(days)
    masks = spark.createDataFrame([], USER_ACTIVITY.schema)
    for day in days:
        rows = increments.merge_masks(masks, increments.activity_masks(
            filter_date_range(frame, day, day))).collect()
        masks = spark.createDataFrame(rows, USER_ACTIVITY.schema)
    assert same(masks, increments.activity_masks(frame))
    assert same(increments.retention_from_masks(masks), retention_matrix(frame))


def test_masks_at_their_edges(spark):
    far = [row("2024-01-01 00:00:00"), row("2024-03-02 00:00:00"), row("2024-03-03 00:00:00"),
           row("2024-01-31 00:00:00"), row("2025-06-01 00:00:00")]
    masks = increments.activity_masks(events(spark, far))
    assert masks.first().mask == 1 | 1 << 30 | 1 << 61      # 61 days later fits, 62 does not
    earlier = increments.activity_masks(events(spark, [row("2023-12-31 00:00:00")]))
    moved = increments.merge_masks(masks, earlier).first()
    assert (moved.cohort_date, moved.mask) == (dt.date(2023, 12, 31), 1 | 2 | 1 << 31)
    long_ago = increments.activity_masks(events(spark, [row("2020-01-01 00:00:00")]))
    assert increments.merge_masks(masks, long_ago).first().mask == 1
    with pytest.raises(ValueError):
        increments.retention_from_masks(masks, 62)


def test_a_new_day_reads_one_day_of_detail(spark, detail):
    day = filter_date_range(read_detail(spark, detail), D, D)
    for frame in (increments.activity_masks(day), rollups.active_counts(day),
                  sketches.brand_sketches(day)):
        plan = plan_of(frame)
        assert sum(x.startswith("(") and "Scan parquet" in x for x in plan.splitlines()) == 1
        assert "PartitionFilters: [isnotnull(event_date" in plan


def test_the_job_and_its_tables(spark, detail, tmp_path):
    out = str(tmp_path / "out")
    main(["days", "--detail", detail, "--out", out, "--end", "2024-01-05"], spark)
    main(["days", "--detail", detail, "--out", out, "--start", "2024-01-06", "--end", "2024-01-07"], spark)
    frame = read_detail(spark, detail).filter("event_date <= '2024-01-07'")
    assert same(daily.retention(spark, out), retention_matrix(frame))
    assert same(daily.active_users(spark, out), rollups.active_user_daily(frame))


def big(spark, users=60_000):
    """More users per brand than a sketch can list, over five days."""
    base = spark.range(users * 4).select(
        F.pmod(F.xxhash64("id"), F.lit(users)).alias("user_id"),
        F.date_add(F.lit(D), F.pmod("id", F.lit(5)).cast("int")).alias("event_date"),
        F.when(F.col("id") % 3 == 0, "purchase").otherwise("view").alias("event_type"),
        F.concat(F.lit("b"), (F.col("id") % 2).cast("string")).alias("brand"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 100).cast("decimal(10,2)").alias("price"))
    return base.persist()


def test_merged_sketches_of_many_users(spark):
    frame = big(spark)
    stored = BRAND_SKETCHES.conform(sketches.sketches_daily(frame, "brand")).persist()
    for dims in (["brand"], []):
        part = filter_date_range(frame, D, D + dt.timedelta(days=2))
        exact = defaultdict(lambda: [set(), set(), set()])
        for r in part.select("user_id", "event_type", "brand").collect():
            sets = exact[r.brand if dims else None]
            sets[0].add(r.user_id)
            sets[1 if r.event_type == "view" else 2].add(r.user_id)
        merged = sketches.uv_range(stored, *dims, start=D, end=D + dt.timedelta(days=2)).collect()
        assert len(merged) == len(exact)
        for r in merged:
            users, viewers, buyers = exact[r.brand if dims else None]
            assert len(users) > 2 ** sketches.LG_NOMINAL
            for got, want in ((r.uv, users), (r.view_uv, viewers), (r.buyer_uv, buyers),
                              (r.viewer_buyer_uv, viewers & buyers)):
                assert abs(got - len(want)) <= 0.03 * len(users)


def test_price_points_and_empty_sets(spark):
    stored = BRAND_SKETCHES.conform(sketches.sketches_daily(big(spark), "brand"))
    paid = sorted(r.price for r in big(spark).filter("event_type = 'purchase' AND brand = 'b0'").collect())
    points = {r.brand: r for r in sketches.price_points(stored, "brand").collect()}
    assert points["b0"].purchases == len(paid)
    for p, value in zip(sketches.PRICE_POINTS, points["b0"].prices):
        rank = sum(x <= value for x in paid) / len(paid)
        assert abs(rank - p) < 0.02
    none = sketches.brand_sketches(events(spark, [row("2024-01-01 00:00:00", "cart")]))
    r = sketches.uv_range(none, "brand").first()
    assert (r.uv, r.view_uv, r.buyer_uv, r.viewer_buyer_uv) == (1, 0, 0, 0)
    assert tuple(sketches.price_points(none, "brand").first())[1:] == (0, None)


def test_rolled_windows_count_a_viewer_once(spark):
    rows = [row("2024-01-01 10:00:10", user=1), row("2024-01-01 10:59:59", user=1),
            row("2024-01-01 10:30:00", user=2), row("2024-01-01 10:30:00", "purchase", user=3, price="2.50"),
            row("2024-01-01 11:00:00", user=1), row("2024-01-01 12:00:00", "cart", user=1)]
    minutes = sketches.window_sketches(events(spark, rows), "60 seconds", "brand")
    hours = sketches.wider_windows(minutes, "3600 seconds", "brand").orderBy("window_start").collect()
    assert [(r.pv, r.uv, r.purchase_cnt, str(r.gmv)) for r in hours] == [
        (3, 2, 1, "2.50"), (1, 1, 0, "0.00")]
