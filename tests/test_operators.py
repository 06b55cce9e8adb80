import bisect
import collections
import datetime as dt
import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketflow.functions.metrics import approx_uv
from basketflow.operators import quantiles, replay, retention, rfm, rollups
from basketflow.operators.clusters import fit_clusters
from basketflow.operators.dim_user import contradictions, dim_user
from basketflow.operators.funnel import funnel_daily, funnel_stages
from basketflow.operators.latest import latest_by_key
from basketflow.operators.quantiles import approx_quantiles, exact_quantiles
from basketflow.operators.windows import brand_windows, global_windows
from basketflow.plans import serving
from basketflow.sources.star import behavior, behavior_li
from builders import at, events, row

DAY = "2024-01-01"


def test_day_without_views_has_null_rates(spark):
    day = funnel_daily(events(spark, [row(f"{DAY} 01:00:00", "cart")])).first()
    assert (day.view_cnt, day.cart_cnt) == (0, 1)
    assert day.cart_rate is None and day.buy_rate is None
    assert day.gmv == Decimal("0.00")
    stages = funnel_stages(funnel_daily(events(spark, [row(f"{DAY} 01:00:00", "cart")]))).collect()
    assert [s.ratio for s in stages] == [1.0, 0.0, 0.0]


def test_cart_only_window_is_dropped_and_purchase_only_kept(spark):
    rows = [row(f"{DAY} 00:00:05", "cart"), row(f"{DAY} 00:01:05", "purchase", price="9.99"),
            row(f"{DAY} 00:02:05"), row(f"{DAY} 00:02:06"), row(f"{DAY} 00:02:07", user=2)]
    got = {(r.window_start.minute, r.pv, r.uv, r.purchase_cnt, str(r.gmv))
           for r in global_windows(events(spark, rows), "60 seconds").collect()}
    assert got == {(1, 0, 0, 1, "9.99"), (2, 3, 2, 0, "0.00")}


def test_users_do_not_add_across_brands(spark, sf_dir):
    frame = behavior(spark, sf_dir)
    everything = "3650 days"
    total = global_windows(frame, everything).first().uv
    by_brand = brand_windows(frame, everything).agg(F.sum("uv")).first()[0]
    assert by_brand > total


def test_latest_is_not_the_maximum(spark):
    rows = spark.createDataFrame(
        [("w", 243431, 1), ("w", 6373, 2), ("v", 5, 1), ("v", 5, 1)],
        "k string, pv bigint, _version bigint")
    got = {r.k: r.pv for r in latest_by_key(rows, ["k"]).collect()}
    assert got == {"w": 6373, "v": 5}


def test_ranking_ties_are_ordered_by_key(spark):
    rows = [row(f"{DAY} 00:00:0{i}", "purchase", product=p, price="5.00")
            for i, p in enumerate([3, 1, 2])]
    top = serving.product_ranking(events(spark, rows), limit=2).collect()
    assert [r.product_id for r in top] == [1, 2]


def test_dense_curve_counts_cohorts_nobody_returned_from(spark):
    rows = [row("2024-01-01 00:00:00", user=1), row("2024-01-02 00:00:00", user=1),
            row("2024-01-02 00:00:00", user=2), row("2024-01-03 00:00:00", user=3)]
    frame = events(spark, rows)
    matrix = retention.retention_matrix(frame)
    sparse = {r.day_offset: r.retention_rate for r in retention.retention_curve(matrix).collect()}
    dense = {r.day_offset: r.retention_rate for r in retention.retention_curve(
        retention.densify(matrix, rfm.ref_date(frame).scalar())).collect()}
    assert sparse == {0: 1.0, 1: 1.0}
    assert dense == {0: 1.0, 1: 0.5, 2: 0.0}


def test_far_offsets_are_left_out(spark):
    rows = [row("2024-01-01 00:00:00"), row("2024-01-31 00:00:00"), row("2024-02-01 00:00:00")]
    offsets = [r.day_offset for r in retention.retention_matrix(events(spark, rows)).collect()]
    assert sorted(offsets) == [0, 30]


def test_exact_quantiles_against_sorting(spark):
    rng = random.Random(7)
    values = [Decimal(rng.choice([0, 0, 0, rng.randrange(10**9), -rng.randrange(10**4)])) / 100
              for _ in range(3000)]
    frame = spark.createDataFrame([(v, i % 7) for i, v in enumerate(values)],
                                  "a decimal(18,2), b int").repartition(5)
    got = exact_quantiles(frame, ["a", "b"]).first()
    for name, column in (("a", values), ("b", [i % 7 for i in range(3000)])):
        ordered = sorted(column)
        want = [ordered[math.ceil(p * len(ordered) / 100) - 1] for p in (20, 40, 60, 80)]
        assert [Decimal(x) for x in got[name]] == [Decimal(x) for x in want]


@pytest.mark.parametrize("cells,margin", [(16_384, 0.01), (4, 0.01), (3, 0.0), (16, -0.2)])
def test_exact_quantiles_need_no_luck(spark, monkeypatch, cells, margin):
    """Few cells ask for many passes; brackets that are too narrow or reversed must be recovered from."""
    monkeypatch.setattr(quantiles, "CELLS", cells)
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    rng = random.Random(cells)
    a = [Decimal(int(rng.lognormvariate(5, 3))) / 100 for _ in range(2000)]
    b = [Decimal(rng.choice([5, 5, 5, 5, 7, -10**15, 10**15])) / 100 for _ in range(2000)]
    frame = spark.createDataFrame(list(zip(a, b, [None] * 2000)), "a decimal(18,2), b decimal(18,2), "
                                  "c decimal(18,2)").repartition(3)
    got = exact_quantiles(frame, ["a", "b", "c"]).first()
    for name, column in (("a", a), ("b", b)):
        assert got[name] == [sorted(column)[math.ceil(p * 2000 / 100) - 1] for p in (20, 40, 60, 80)]
    assert got.c == [None] * 4


def test_exact_quantiles_without_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "a int"), ["a"]).first().a == [None] * 4


def test_approximate_quantiles_stay_within_their_rank_error(spark):
    frame = spark.range(20_000).selectExpr("pmod(xxhash64(id), 1000003) AS a").repartition(6)
    ordered = sorted(r.a for r in frame.collect())
    got = approx_quantiles(frame, ["a"], 0.01).first().a
    for p, value in zip((0.2, 0.4, 0.6, 0.8), got):
        assert abs(bisect.bisect_right(ordered, int(value)) / 20_000 - p) <= 0.011


def test_tied_cuts_give_everyone_the_top_score_unless_strict(spark):
    rows = [row(f"{DAY} 00:00:00", user=u) for u in range(9)]
    rows.append(row(f"{DAY} 00:00:00", "purchase", user=9, price="50.00"))
    users = rfm.rfm_base(events(spark, rows))
    cuts = rfm.rfm_quantiles(users, 0)
    assert {r.m_score for r in rfm.rfm_scores(users, cuts).collect()} == {5}
    strict = {r.user_id: r.m_score for r in rfm.rfm_scores(users, cuts, True).collect()}
    assert strict.pop(9) == 5 and set(strict.values()) == {1}


@pytest.fixture(scope="module")
def profiles(spark, sf_dir):
    frame = behavior_li(spark, sf_dir)
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return [rfm.user_profile(source, computed_at=stamp).collect()
            for source in (frame, frame.repartition(7))]


def test_profile_covers_every_user_once(spark, sf_dir, profiles):
    users = behavior_li(spark, sf_dir).select("user_id").distinct().count()
    assert len(profiles[0]) == users == len({r.user_id for r in profiles[0]})
    assert len({r.cluster_id for r in profiles[0]}) <= 4
    assert {r.segment for r in profiles[0]} <= set(rfm.SEGMENT_NAMES)


def test_profile_does_not_depend_on_input_layout(profiles):
    first, second = [{r.user_id: (r.cluster_id, r.segment) for r in p} for p in profiles]
    assert first == second


def test_segments_are_named_best_first(profiles):
    groups = collections.defaultdict(list)
    for r in profiles[0]:
        groups[r.segment].append(r)

    def worth(rows):
        n = len(rows)
        mean_m = sum(float(r.monetary) for r in rows) / n
        return sum(r.frequency - r.recency_days for r in rows) / n + math.log1p(mean_m)

    scores = [worth(groups[s]) for s in rfm.SEGMENT_NAMES if s in groups]
    assert scores == sorted(scores, reverse=True)


def test_clusters_are_nearest_centres(spark, sf_dir):
    users = rfm.pinned(rfm.rfm_base(behavior_li(spark, sf_dir)))
    model = rfm.rfm_kmeans(users)
    z = model.clustered(users).selectExpr(*[f"{s} / 1000000 AS z{i}"
                                            for i, s in enumerate(model.scaled())], "cluster_id")
    groups = collections.defaultdict(list)
    for r in z.collect():
        distances = [sum((a - b) ** 2 for a, b in zip(r, c)) for c in model.centres]
        assert min(distances) == pytest.approx(distances[r.cluster_id])
        groups[r.cluster_id].append(r[:3])
    assert len(groups) == len(model.centres) == 4
    for cluster, rows in groups.items():        # rounds went on until centres were means
        for mean, c in zip(map(statistics.fmean, zip(*rows)), model.centres[cluster]):
            assert mean == pytest.approx(c, abs=0.05)


def test_clusters_are_the_same_under_any_layout(spark, sf_dir):
    users = rfm.rfm_base(behavior_li(spark, sf_dir)).persist()
    models = [rfm.rfm_kmeans(users.repartition(n, "user_id")) for n in (1, 32, 200)]
    assert models[0] == models[1] == models[2]
    assert rfm.rfm_kmeans(users, seed=7) != models[0]


def test_clusters_of_few_equal_or_no_rows(spark):
    def of(*values):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double")
        return fit_clusters(frame, ["x", "5.0D"], "id", 3)
    assert of().centres == ()
    assert of(2.0, 2.0).centres == ((0.0, 0.0),)
    assert len(of(1.0, 1.0, 9.0).centres) == 2
    far = of(*[0.0] * 50, *[10.0] * 50, *[30.0] * 50)
    assert sorted(round(c[0], 3) for c in far.centres) == pytest.approx([-1.067, -0.267, 1.334], abs=0.01)


def test_a_saved_model_scores_like_the_one_in_memory(spark, sf_dir, tmp_path):
    users = rfm.rfm_base(behavior_li(spark, sf_dir))
    model = rfm.rfm_kmeans(users)
    names = rfm.named_clusters(model, users)
    model.pipeline(names).save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model")).transform(users)
    want = {r.user_id: (r.cluster_id, names[r.cluster_id]) for r in model.clustered(users).collect()}
    assert {r.user_id: (r.cluster_id, r.segment) for r in loaded.collect()} == want


def test_high_value_share_falls_back_to_the_first_segment(spark):
    summary = spark.createDataFrame(
        [("x", 3, Decimal("90.00")), ("y", 1, Decimal("10.00"))],
        "segment string, users bigint, total_monetary decimal(18,2)")
    got = serving.high_value_share(summary).first()
    assert (got.segment, got.user_share, got.monetary_share) == ("x", 0.75, 0.9)


def test_day1_retention_falls_back_to_the_last_point(spark):
    curve = spark.createDataFrame([(0, 1.0), (3, 0.2)], "day_offset int, retention_rate double")
    assert tuple(serving.day1_retention(curve).first()) == (3, 0.2)


def test_approximate_users_stay_near_exact(spark):
    frame = spark.range(200_000).selectExpr("id % 3 AS g", "id AS user_id")
    for r in frame.groupBy("g").agg(
            approx_uv().alias("a"), F.count_distinct("user_id").alias("e")).collect():
        assert abs(r.a - r.e) / r.e < 0.03


def test_synthetic_users(spark):
    frame = spark.range(20_000).select(F.col("id").alias("user_id"))
    dim = dim_user(frame.union(frame))
    assert dim.count() == 20_000
    assert contradictions(dim).count() == 0
    share = {r.device: r["count"] / 20_000 for r in dim.groupBy("device").count().collect()}
    for device, want in (("iOS", 0.35), ("Android", 0.45), ("Web", 0.20)):
        assert abs(share[device] - want) < 0.02
    women = dim.groupBy("device").agg(F.avg(F.when(F.col("gender") == "女", 1).otherwise(0)))
    for r in women.collect():
        assert abs(r[1] - 0.58) < 0.03


def test_shift_lands_the_newest_event_on_the_anchor(spark):
    frame = events(spark, [row("2019-11-01 00:00:00"), row("2019-11-01 00:10:00")])
    anchor = replay.replay_anchor(at("2024-01-01 00:00:00"), dt.timedelta(minutes=5), 2.0)
    got = sorted(r.event_time for r in replay.shift_event_time(frame, F.lit(anchor)).collect())
    assert [t.strftime("%H:%M") for t in got] == ["00:00", "00:10"]
    lines = spark.createDataFrame(
        [("2019-11-01 00:00:00 UTC,view",), ("junk,x",), ("nocomma",)], "value string")
    assert {r.value for r in replay.shift_lines(lines, F.lit(anchor)).collect()} == {
        "2024-01-01 00:10:00 UTC,view", "junk,x", "nocomma"}


def test_replay_slices_are_in_time_order(spark, sf_dir):
    slices = replay.replay_slices(behavior(spark, sf_dir).repartition(5), 6)
    spans = slices.groupBy("slice").agg(
        F.min("event_time").alias("a"), F.max("event_time").alias("b")).orderBy("slice").collect()
    assert len(spans) > 1
    for earlier, later in zip(spans, spans[1:]):
        assert earlier.b <= later.a
    parts = slices.select("slice", "event_time").rdd.glom().collect()
    for part in parts:
        times = [r.event_time for r in part]
        assert times == sorted(times)


def test_a_viewer_of_an_item_under_two_brands_counts_once(spark):
    rows = [row("2024-01-01 00:00:01", brand="a"), row("2024-01-01 00:00:02", brand="b"),
            row("2024-01-01 00:00:03", user=2, brand="a"), row("2024-01-01 00:00:04", user=None, brand="a"),
            row("2024-01-01 00:00:05", "purchase", user=3, brand=None, price="2.50", session="s"),
            row("2024-01-01 00:00:06", "cart", product=2, brand=None)]
    got = {r.product_id: r for r in rollups.item_stats_daily(events(spark, rows)).collect()}
    assert (got[1].brand, got[1].view_cnt, got[1].view_uv, got[1].purchase_cnt) == ("b", 4, 2, 1)
    assert str(got[1].gmv) == "2.50"
    assert (got[2].brand, got[2].view_uv, got[2].cart_cnt, got[2].buy_rate) == (None, 0, 1, None)
