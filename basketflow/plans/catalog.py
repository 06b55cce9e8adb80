"""Every operator as a named query over the star-schema tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.metrics import (
    approx_uv, avg_order_value, cond_count, cond_distinct, cond_sum,
)
from ..operators import (
    cleaning, dim_user, funnel, grain, latest, replay, retention, rfm, rollups, sketches,
)
from ..operators import windows as win
from ..operators.clusters import Clusters
from ..schema import (
    CART, DETAIL, FUNNEL_DAILY, PURCHASE, REALTIME_BRAND, REALTIME_CATEGORY, REALTIME_GLOBAL,
    TABLES, USER_PROFILE, VIEW,
)
from ..session import scratch_path, streaming_session, tune
from ..sources import files, star, versions
from ..streaming import queries as streams
from . import daily, serving

Query = Callable[[SparkSession, str], DataFrame]

# The replay anchor used by the shift queries.
ANCHOR = datetime(2024, 6, 1, 12, 0, 0, tzinfo=timezone.utc)
RANGE = ("2024-01-05", "2024-01-14")

_QUERIES: dict[str, Query] = {}
# The same operators apart from the frame they read, for benches on prepared tables.
PARTS: dict[str, tuple[Callable, Callable]] = {}


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the checking engine returns them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name) for f in df.schema])


def query(source: Callable[[SparkSession, str], DataFrame] | None = star.behavior,
          name: str | None = None):
    """Register a query. With a source the function receives that frame, else (spark, sf_dir)."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            result = fn(source(spark, sf_dir)) if source else fn(spark, sf_dir)
            return _naive(result)

        _QUERIES[name or fn.__name__] = run
        if source:
            PARTS[name or fn.__name__] = source, fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and sinks -------------------------------------------------------------------

def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV history with dirt in every way a loader meets it, written as text and read back."""
    path = scratch_path(spark, "history")
    star.dirty_lines(spark, sf_dir).write.text(path)
    return files.read_raw_csv(spark, path, header=False)


@query(None)
def bulk_load(spark, sf_dir):
    return files.bulk_load(_history(spark, sf_dir))


@query(None)
def bulk_load_rejects(spark, sf_dir):
    return files.bulk_load_rejects(_history(spark, sf_dir))


@query()
def read_pruned(events):
    return files.read_pruned(events, *RANGE)


@query()
def read_user_days(events):
    return retention.user_days(events)


@query()
def read_user_rfm(events):
    return rfm.rfm_base(events)


@query()
def write_replace(events):
    """The same days written twice, then read: the second write replaced the first."""
    spark = events.sparkSession
    path = scratch_path(spark, "funnel")
    for _ in range(2):
        files.write_replace(funnel.funnel_daily(events), path, "event_date")
    return FUNNEL_DAILY.conform(spark.read.schema(FUNNEL_DAILY.schema).parquet(path))


@query()
def write_detail(events):
    spark = events.sparkSession
    path = scratch_path(spark, "detail")
    files.write_detail(events, path)
    return files.read_detail(spark, path)


@query()
def replay_write(events):
    """Replay slices written as text lines, read back and cleaned."""
    spark = events.sparkSession
    path = scratch_path(spark, "replay")
    lines = replay.replay_slices(replay.to_lines(events), 8)
    lines.select("value", "slice").write.partitionBy("slice").text(path)
    return cleaning.clean_events(spark.read.text(path))


# --- cleaning and predicates -------------------------------------------------------------

@query(star.raw_lines)
def clean_events(lines):
    return cleaning.clean_events(lines)


@query(star.raw_lines)
def parse_source_time(lines):
    head = F.substring_index("value", ",", 1)
    return lines.select("value", tx.parse_source_time(head).alias("event_time"))


@query(star.raw_lines)
def coarse_valid(lines):
    return cleaning.coarse_valid(lines)


@query(star.raw_columns)
def fill_unknown(raw):
    filled = cleaning.fill_unknown(raw)
    return filled.groupBy("category_code", "brand").agg(F.count(F.lit(1)).alias("event_cnt"))


@query()
def derive_event_date(events):
    return cleaning.derive_event_date(events.drop("event_date")).select(
        "event_time", "user_id", "event_date")


@query()
def filter_date_range(events):
    return cleaning.filter_date_range(events, *RANGE)


@query()
def filter_known_brand(events):
    return serving.known_brand(events).select("product_id", "brand", "user_id")


@query()
def shift_event_time(events):
    return replay.shift_event_time(events, F.lit(ANCHOR)).select(
        "event_time", "user_id", "product_id", "event_type")


@query(star.raw_lines)
def shift_lines(lines):
    return replay.shift_lines(lines, F.lit(ANCHOR))


@query()
def sort_replay(events):
    return replay.sort_replay(events).select("event_time", "user_id", "product_id", "event_type")


@query()
def select_contract(events):
    return FUNNEL_DAILY.conform(funnel.funnel_daily(events).select(*reversed(FUNNEL_DAILY.columns)))


# --- joins and retention -----------------------------------------------------------------

@query()
def cohort_assign(events):
    return retention.cohort_assign(retention.user_days(events))


@query()
def cohort_assign_join(events):
    return retention.cohort_assign_join(retention.user_days(events))


@query()
def cohort_rate_join(events):
    days = retention.user_days(events)
    cells = retention.retained_cells(retention.cohort_assign(days))
    return retention.cohort_rate_join(cells, retention.cohort_sizes(days))


@query()
def cohort_first_date(events):
    return retention.cohort_first_date(retention.user_days(events))


@query()
def retention_matrix(events):
    return retention.retention_matrix(events)


@query(star.behavior_li)
def retention_matrix_li(events):
    return retention.retention_matrix(events)


@query()
def retention_curve(events):
    return retention.retention_curve(retention.retention_matrix(events))


@query(star.behavior_li)
def retention_curve_dense(events):
    last = rfm.ref_date(events).scalar()
    return retention.retention_curve(
        retention.densify(retention.retention_matrix(events), last))


# --- aggregations ------------------------------------------------------------------------

@query()
def cond_count_daily(events):
    return events.groupBy("event_date").agg(
        cond_count(VIEW).alias("view_cnt"), cond_count(CART).alias("cart_cnt"),
        cond_count(PURCHASE).alias("purchase_cnt"))


@query()
def cond_distinct_daily(events):
    return events.groupBy("event_date").agg(
        cond_distinct(VIEW).alias("view_uv"), cond_distinct(CART).alias("cart_uv"),
        cond_distinct(PURCHASE).alias("purchase_uv"))


@query()
def cond_sum_daily(events):
    return events.groupBy("event_date").agg(cond_sum(PURCHASE).alias("gmv"))


@query()
def funnel_daily(events):
    return funnel.funnel_daily(events)


@query(star.behavior_li)
def funnel_daily_li(events):
    return funnel.funnel_daily(events)


@query()
def distinct_rows(events):
    return events.select("user_id").distinct()


@query()
def ref_date(events):
    return rfm.ref_date(events)


@query(star.behavior_li)
def rfm_base(events):
    return rfm.rfm_base(events)


@query(star.behavior_li)
def rfm_quantiles(events):
    cuts = rfm.rfm_quantiles(rfm.rfm_base(events), relative_error=0)
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("cuts"))
                     for c in rfm.RFM_COLUMNS])
    flat = cuts.select(F.inline(rows))
    return flat.select("metric", *[F.col("cuts")[i].alias(f"q{20 * (i + 1)}") for i in range(4)])


def exact_scores(events: DataFrame) -> DataFrame:
    users = rfm.rfm_base(events)
    return rfm.rfm_scores(users, rfm.rfm_quantiles(users, relative_error=0))


@query(star.behavior_li)
def rfm_scores(events):
    return exact_scores(events)


@query()
def active_user_daily(events):
    return rollups.active_user_daily(events)


@query(star.behavior_li)
def active_user_daily_li(events):
    return rollups.active_user_daily(events)


@query()
def item_stats_daily(events):
    return rollups.item_stats_daily(events)


@query(star.behavior_li)
def item_stats_daily_li(events):
    return rollups.item_stats_daily(events)


@query()
def category_stats_daily(events):
    return rollups.category_stats_daily(events)


@query(star.behavior_li)
def category_stats_daily_li(events):
    return rollups.category_stats_daily(events)


@query()
def brand_stats_daily(events):
    return rollups.brand_stats_daily(events)


@query(star.behavior_li)
def brand_stats_daily_li(events):
    return rollups.brand_stats_daily(events)


# Sketch estimates may be off by this share: four standard errors and a rounding unit.
SKETCH_BOUND = 0.04


def _within(estimate: str, exact: str) -> Column:
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * SKETCH_BOUND + 1


@query(star.behavior_li)
def approx_uv_by_brand(events):
    """The exact count, and whether the sketch came close to it."""
    both = events.groupBy("brand").agg(
        approx_uv().alias("approx_uv"), F.count_distinct("user_id").alias("uv"))
    return both.select("brand", "uv", _within("approx_uv", "uv").alias("approx_within_bound"))


@query()
def any_brand(events):
    return rollups.any_brand(events)


@query()
def user_uv_by_brand(events):
    return grain.user_uv_by_dim(events, "brand")


@query(star.behavior_li)
def user_uv_by_category(events):
    return grain.user_uv_by_dim(events, "category_id")


# --- segments ----------------------------------------------------------------------------

def scored_segments(events: DataFrame) -> DataFrame:
    """A repeatable stand-in for clusters: the m score picks the cluster."""
    return exact_scores(events).withColumn(
        "cluster_id", F.when(F.col("m_score") == 5, 0).when(F.col("m_score") >= 4, 1)
        .when(F.col("m_score") >= 2, 2).otherwise(3))


@query(star.behavior_li)
def rfm_features(events):
    users = rfm.rfm_features(rfm.rfm_base(events))
    scaled = Pipeline(stages=rfm.feature_stages()).fit(users).transform(users)
    z = vector_to_array("features")
    return scaled.select(
        "user_id", F.round("log_f", 6).alias("log_f"), F.round("log_m", 6).alias("log_m"),
        *[F.round(z[i], 5).alias(n) for i, n in enumerate(("z_recency", "z_log_f", "z_log_m"))])


def _clustered(events: DataFrame) -> tuple[DataFrame, Clusters]:
    users = rfm.rfm_base(events)
    model = rfm.rfm_kmeans(users)
    return model.clustered(users), model


@query(star.behavior_li)
def rfm_kmeans(events):
    """What must hold of any k-means result: each user's own centre is the nearest one."""
    clustered, model = _clustered(events)
    far = [F.expr(d) for d in model.distances()]
    own = F.element_at(F.array(*far), F.col("cluster_id") + 1)
    return clustered.select("user_id", (own <= F.least(*far) + 1e-9).alias("own_centre_nearest"))


@query(star.behavior_li)
def cluster_stats(events):
    """Cluster sizes and averages weighted by them add up to the averages over all users."""
    clustered, model = _clustered(events)
    stats = rfm.cluster_stats(clustered)
    total = F.sum("cnt")
    return stats.agg(
        (F.count(F.lit(1)) == len(model.centres)).alias("every_cluster_used"), total.alias("users"),
        *[F.round(F.sum(F.col(c) * F.col("cnt")) / total, 4).alias(c)
          for c in ("avg_r", "avg_f", "avg_m")])


@query(star.behavior_li)
def segment_names(events):
    return rfm.segment_names(rfm.cluster_stats(scored_segments(events)))


@query(star.behavior_li)
def user_profile(events):
    """The whole job with exact cut points; the cluster's number and name depend on the seed, so
    only whether they agree with each other is shown."""
    profiles = rfm.user_profile(events, computed_at=F.lit(ANCHOR).cast("timestamp"),
                                relative_error=0)
    names = profiles.select("cluster_id", "segment").distinct().groupBy("cluster_id") \
        .agg((F.count(F.lit(1)) == 1).alias("one_name"))
    return profiles.join(names, "cluster_id").drop("cluster_id", "segment")


@query(star.behavior_li)
def profile_from_saved_model(events):
    """Clusters learned from earlier users, saved, loaded and applied to all users."""
    spark = events.sparkSession
    users = rfm.rfm_base(events)
    earlier = users.filter(F.col("user_id") % 2 == 0)
    model = rfm.rfm_kmeans(earlier)
    names = rfm.named_clusters(model, earlier)
    path = scratch_path(spark, "segments")
    model.pipeline(names).save(path)
    scored = PipelineModel.load(path).transform(users)
    fresh = F.element_at(F.array(*[F.lit(n) for n in names]), F.expr(model.nearest()) + 1)
    return scored.select(
        "user_id", "recency_days", "frequency", "monetary",
        ((F.col("cluster_id") == F.expr(model.nearest())) & (F.col("segment") == fresh))
        .alias("as_the_model_says"))


def _segmented(events: DataFrame) -> DataFrame:
    return rfm.attach_segments(scored_segments(events))


@query(star.behavior_li)
def segment_summary(events):
    return rfm.segment_summary(_segmented(events))


@query(star.behavior_li)
def segment_totals(events):
    return rfm.segment_totals(_segmented(events))


# --- latest-wins, ordering ---------------------------------------------------------------

@query()
def latest_by_key(events):
    """Each user's last event per brand."""
    columns = ["user_id", "brand", "event_time", "event_type", "product_id", "price"]
    return latest.latest_by_key(events.select(*columns), ["user_id", "brand"], "event_time")


@query(None)
def latest_of_replays(spark, sf_dir):
    """Hourly brand windows written twice, purchases only the second time: the smaller, newer
    values win where both exist."""
    events = star.behavior(spark, sf_dir)
    path = scratch_path(spark, "brand-windows")
    files.append_version(win.brand_windows(events, "1 hour"), path, 1)
    files.append_version(
        win.brand_windows(events.filter(F.col("event_type") == PURCHASE), "1 hour"), path, 2)
    return files.read_latest(spark, path, REALTIME_BRAND)


@query(star.behavior_li)
def order_limit(events):
    order = [F.col("price").desc(), F.col("user_id"), F.col("product_id"), F.col("event_date")]
    rows = events.select("user_id", "product_id", "event_date", "price")
    return latest.order_limit(rows, order, 30)


@query()
def rank_position(events):
    return serving.ranking_table(serving.brand_ranking(win.brand_windows(events)), "brand").select(
        "rank", "brand", "gmv")


@query()
def global_sort(events):
    return retention.retention_matrix(events).orderBy("cohort_date", "day_offset")


# --- windows (batch) ---------------------------------------------------------------------

@query()
def win_global(events):
    return win.global_windows(events)


@query()
def win_global_minute(events):
    return win.global_windows(events, "60 seconds")


@query()
def win_category(events):
    return win.category_windows(events)


@query()
def win_brand(events):
    return win.brand_windows(events)


@query()
def pv_uv_agg(events):
    """Windows of a year: the measures over everything, a row for each side of a boundary."""
    return win.brand_windows(events, "365 days").select(
        "window_start", "brand", "pv", "uv", "purchase_cnt", "gmv")


@query()
def drop_empty_window(events):
    """Minutes that exist in the log but have no row because they hold carts only."""
    minutes = events.select(F.window("event_time", "60 seconds").start.alias("window_start"))
    kept = win.global_windows(events, "60 seconds").select("window_start")
    return minutes.distinct().join(kept, "window_start", "left_anti")


# --- streaming ---------------------------------------------------------------------------

def _run_windows(spark: SparkSession, sf_dir: str, table: str, runs: int = 1) -> DataFrame:
    """Run one windowed stream to the end of the available data and read its table back."""
    sibling = streaming_session(spark)
    out, checkpoint = scratch_path(spark, table), scratch_path(spark, f"{table}-checkpoint")
    for _ in range(runs):
        stats = streams.windowed_outputs(star.behavior_stream(sibling, sf_dir))[table]
        running = streams.start_windows(
            stats, f"{table}-{out[-8:]}", out, checkpoint, {"availableNow": True})
        running.awaitTermination()
    return files.read_latest(spark, out, TABLES[table])


@query(None)
def stream_source(spark, sf_dir):
    """Rows delivered by the file stream, appended with no aggregation."""
    return _run_detail(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_cnt"))


def _run_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    sibling = streaming_session(spark)
    out, checkpoint = scratch_path(spark, "dwd"), scratch_path(spark, "dwd-checkpoint")
    running = streams.start_detail(
        star.behavior_stream(sibling, sf_dir), out, checkpoint, {"availableNow": True})
    running.awaitTermination()
    return files.read_detail(spark, out)


@query(None)
def stream_detail(spark, sf_dir):
    return _run_detail(spark, sf_dir)


@query(None)
def stream_global(spark, sf_dir):
    return _run_windows(spark, sf_dir, "ads_realtime_pv_uv")


@query(None)
def stream_category(spark, sf_dir):
    return _run_windows(spark, sf_dir, "ads_realtime_category_stats")


@query(None)
def stream_brand(spark, sf_dir):
    return _run_windows(spark, sf_dir, "ads_realtime_brand_stats")


@query(None)
def stream_late(spark, sf_dir):
    """Events of another year arrive after the rest: far behind the watermark, they are dropped.
    Those of a few seconds before the newest event still count."""
    frame = star.behavior(spark, sf_dir)
    newest = frame.agg(F.max("event_time")).scalar()
    late = frame.withColumn("event_time", F.col("event_time") - F.expr("INTERVAL 400 DAYS"))
    fresh = (frame.filter("event_type = 'view'").limit(50).withColumn(
        "event_time", newest - F.expr("INTERVAL 10 SECONDS")).withColumn("user_id", F.lit(-1)))
    closing = frame.limit(1).withColumn("event_time", newest + F.expr("INTERVAL 1 DAY")) \
        .withColumn("event_type", F.lit("cart"))
    sibling = streaming_session(spark)
    inbox, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    checkpoint = scratch_path(spark, "late-ck")
    # The stream goes on after each part and takes all its files as one batch, so parts are written
    # and read in parallel; the watermark moves between batches.
    # Lateness is judged by the watermark of the batch before, hence the two batches between.
    quiet = frame.limit(1).withColumn("event_time", newest).withColumn("event_type", F.lit("cart"))
    for part in (frame, quiet, quiet, late.unionByName(fresh), closing):
        DETAIL.conform(part).write.mode("append").parquet(inbox)
        source = sibling.readStream.schema(DETAIL.schema).parquet(inbox)
        stats = streams.windowed_outputs(source, "60 seconds")[REALTIME_GLOBAL.name]
        streams.start_windows(stats, f"late-{out[-8:]}", out, checkpoint,
                              {"availableNow": True}).awaitTermination()
    return files.read_latest(spark, out, REALTIME_GLOBAL)


@query(None)
def stream_idle_source(spark, sf_dir):
    """Two sources, one of which goes quiet after a few early rows: windows close all the same."""
    sibling = streaming_session(spark)
    events = star.behavior(spark, sf_dir)
    first = events.agg(F.min("event_time")).scalar()
    early = F.col("event_time") <= first + F.expr("INTERVAL 1 HOUR")
    sources = []
    for name, rows in (("busy", events.filter(~early)), ("quiet", events.filter(early))):
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        sources.append(sibling.readStream.schema(DETAIL.schema).parquet(path))
    out = scratch_path(spark, "idle")
    stats = streams.windowed_outputs(streams.one_of_many(*sources), "60 seconds", delay=None)
    streams.start_windows(stats[REALTIME_GLOBAL.name], f"idle-{out[-8:]}", out,
                          scratch_path(spark, "idle-ck"), {"availableNow": True}).awaitTermination()
    return files.read_latest(spark, out, REALTIME_GLOBAL)


@query(None)
def replay_published(spark, sf_dir):
    """Slices published in order, read by a stream one file a batch: no row comes too late."""
    sibling = streaming_session(spark)
    inbox, out = scratch_path(spark, "published"), scratch_path(spark, "published-out")
    files.publish_slices(replay.replay_slices(replay.to_lines(star.behavior(spark, sf_dir)), 6), inbox)
    lines = sibling.readStream.option("maxFilesPerTrigger", 1).text(inbox)
    stats = streams.windowed_outputs(cleaning.clean_events(lines), "60 seconds")
    streams.start_windows(stats[REALTIME_GLOBAL.name], f"published-{out[-8:]}", out,
                          scratch_path(spark, "published-ck"), {"availableNow": True}).awaitTermination()
    return files.read_latest(spark, out, REALTIME_GLOBAL)


@query(None)
def stream_fan_out(spark, sf_dir):
    """All four outputs of one stream: rows per table."""
    sibling = streaming_session(spark)
    out = scratch_path(spark, "fan-out")
    streams.await_all(streams.start_all(
        star.behavior_stream(sibling, sf_dir), out, scratch_path(spark, "fan-out-ck"),
        {"availableNow": True}))
    tables = [files.read_latest(spark, f"{out}/{t.name}", t).select(F.lit(t.name).alias("name"))
              for t in (REALTIME_GLOBAL, REALTIME_CATEGORY, REALTIME_BRAND)]
    tables.append(files.read_detail(spark, f"{out}/{DETAIL.name}").select(
        F.lit(DETAIL.name).alias("name")))
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.union(t)
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))


@query(None)
def stream_compacted(spark, sf_dir):
    """The brand table written by two checkpoints one after the other, then compacted."""
    sibling = streaming_session(spark)
    out = scratch_path(spark, "compacted")
    for turn in range(2):
        stats = streams.windowed_outputs(star.behavior_stream(sibling, sf_dir))[REALTIME_BRAND.name]
        streams.start_windows(stats, f"compacted-{turn}-{out[-8:]}", out,
                              scratch_path(spark, "compacted-ck"),
                              {"availableNow": True}).awaitTermination()
    files.compact(spark, out, REALTIME_BRAND, "9999-12-31")
    return REALTIME_BRAND.conform(spark.read.schema(REALTIME_BRAND.schema).parquet(out))


@query()
def windows_backfill(events):
    """The brand windows built from detail by day, without a stream."""
    path = scratch_path(events.sparkSession, "backfill")
    files.append_version(win.brand_windows(events), path, 0)
    return files.read_latest(events.sparkSession, path, REALTIME_BRAND)


@query(None)
def exactly_once_resume(spark, sf_dir):
    """The brand stream started twice on one checkpoint: the second start adds nothing."""
    return _run_windows(spark, sf_dir, "ads_realtime_brand_stats", runs=2)


# --- tables kept day by day --------------------------------------------------------------

LAST_DAYS = 3


def _kept(events: DataFrame, update: Callable) -> str:
    """A table built from all but the last days at once, and brought up to date day by day."""
    out = scratch_path(events.sparkSession, "kept")
    newest = events.agg(F.max("event_date").alias("d")).first().d
    days = [newest - timedelta(days=k) for k in reversed(range(LAST_DAYS))]
    update(cleaning.filter_date_range(events, None, days[0] - timedelta(days=1)), out, None)
    for day in days:
        update(cleaning.filter_date_range(events, day, day), out, day)
    return out


@query()
def retention_incremental(events):
    """The cohort matrix from kept activity masks; new days are merged in one at a time."""
    out = _kept(events, lambda days, path, start: daily.update_retention(days, path))
    return daily.retention(events.sparkSession, out)


@query()
def active_user_incremental(events):
    """The active-user table with first days from a kept table; detail of new days only."""
    out = _kept(events, daily.update_active_users)
    return daily.active_users(events.sparkSession, out)


@query()
def users_by_key(events):
    """The user table grown by key: each day adds the users it saw first."""
    out = _kept(events, daily.update_active_users)
    return daily.users(events.sparkSession, out)


def _stored_sketches(events: DataFrame) -> DataFrame:
    out = _kept(events, lambda days, path, start: daily.update_sketches(days, path))
    return daily.sketches(events.sparkSession, out)


@query()
def uv_range_sketch(events):
    """Distinct users of a range of days from the stored sketches alone, beside the exact counts."""
    merged = sketches.uv_range(_stored_sketches(events), "brand", start=RANGE[0], end=RANGE[1])
    names = ["uv", "view_uv", "buyer_uv", "viewer_buyer_uv"]
    merged = merged.select("brand", *[F.col(n).alias(f"approx_{n}") for n in names])
    users = grain.per_user(cleaning.filter_date_range(events, *RANGE), "brand")
    viewed, bought = F.col("view_cnt") > 0, F.col("purchase_cnt") > 0
    exact = users.groupBy("brand").agg(
        F.count(F.lit(1)).alias("uv"), F.count_if(viewed).alias("view_uv"),
        F.count_if(bought).alias("buyer_uv"), F.count_if(viewed & bought).alias("viewer_buyer_uv"))
    # The error of an intersection goes with the size of the union.
    near = [F.abs(F.col(f"approx_{n}") - F.col(n)) <= F.col("uv") * SKETCH_BOUND + 1 for n in names]
    return exact.join(merged, "brand").select(
        "brand", *names, (near[0] & near[1] & near[2] & near[3]).alias("approx_within_bound"))


@query()
def uv_total_sketch(events):
    """The same over all brands: users of several brands count once."""
    merged = sketches.uv_range(_stored_sketches(events), start=RANGE[0], end=RANGE[1])
    exact = cleaning.filter_date_range(events, *RANGE).agg(F.count_distinct("user_id")).scalar()
    return merged.withColumn("exact", exact).select(
        F.col("exact").alias("uv"), _within("uv", "exact").alias("approx_within_bound"))


@query()
def price_points_sketch(events):
    """Price quantiles of a range of days from stored sketches: is their rank close to the asked?"""
    points = sketches.price_points(_stored_sketches(events), "brand", start=RANGE[0], end=RANGE[1])
    paid = cleaning.filter_date_range(events, *RANGE).filter(F.col("event_type") == PURCHASE)
    ranked = paid.join(points, "brand").groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"), F.max("purchases").alias("purchases"),
        *[f(F.col("price"), F.col("prices")[i]).alias(f"{k}{i}")
          for i in range(len(sketches.PRICE_POINTS))
          for k, f in (("below", lambda p, q: F.count_if(p < q)),
                       ("upto", lambda p, q: F.count_if(p <= q)))])
    close = F.lit(True)
    for i, p in enumerate(sketches.PRICE_POINTS):
        close = close & (F.col(f"below{i}") <= F.col("n") * (p + 0.02) + 1) \
            & (F.col(f"upto{i}") >= F.col("n") * (p - 0.02) - 1)
    return ranked.select("brand", "purchases", close.alias("ranks_within_bound"))


@query()
def win_hour_rolled(events):
    """Hour windows from stored minute windows, viewers from their sketches."""
    minutes = sketches.window_sketches(events, "60 seconds", "brand")
    path = scratch_path(events.sparkSession, "minutes")
    minutes.write.parquet(path)
    stored = events.sparkSession.read.schema(minutes.schema).parquet(path)
    hours = sketches.wider_windows(stored, "3600 seconds", "brand") \
        .withColumnRenamed("uv", "approx_uv")
    exact = win.brand_windows(events, "3600 seconds").select("window_start", "brand", "uv")
    return hours.join(exact, ["window_start", "brand"]).select(
        "window_start", "window_end", "brand", "pv", "uv", "purchase_cnt", "gmv",
        _within("approx_uv", "uv").alias("approx_within_bound"))


@query(star.behavior_li)
def profiles_by_key(events):
    """A table replaced by key: all users, then another version of some of them."""
    spark = events.sparkSession
    path = scratch_path(spark, "by-key")
    profiles = USER_PROFILE.conform(scored_segments(events).withColumns({
        "segment": F.lit(""), "computed_at": F.lit(ANCHOR).cast("timestamp")}))
    versions.replace_keys(profiles, path, USER_PROFILE)
    changed = versions.read_keys(spark, path, USER_PROFILE).filter(F.col("user_id") % 7 == 0)
    versions.replace_keys(changed.withColumn("segment", F.lit("again")), path, USER_PROFILE)
    return versions.read_keys(spark, path, USER_PROFILE)


# --- synthetic users ---------------------------------------------------------------------

@query(star.behavior_li)
def salted_buckets(events):
    return dim_user.salted_buckets(events.select("user_id").distinct())


@query(star.behavior_li, "dim_user")
def dim_user_table(events):
    return dim_user.dim_user(events)


@query(star.behavior_li)
def dim_checks(events):
    return dim_user.dim_checks(dim_user.dim_user(events))


# --- serving -----------------------------------------------------------------------------

@query()
def overview(events):
    return serving.overview(win.global_windows(events))


@query()
def category_stats(events):
    return serving.category_stats(win.category_windows(events))


@query()
def brand_stats(events):
    return serving.brand_stats(win.brand_windows(events))


@query()
def brand_ranking(events):
    return serving.brand_ranking(win.brand_windows(events))


@query()
def category_ranking(events):
    return serving.category_ranking(win.category_windows(events))


@query()
def product_ranking(events):
    return serving.product_ranking(events)


@query(star.behavior_li)
def product_ranking_li(events):
    return serving.product_ranking(events)


@query(star.behavior_li)
def product_ranking_from_items(events):
    return serving.product_ranking(events, items=rollups.item_stats_daily(events))


@query(star.behavior_li)
def product_ranking_seeking(events):
    """The ranking whose second read looks for the winners only."""
    spark = events.sparkSession
    path = scratch_path(spark, "detail")
    # By year: the line items spread over thousands of days, too many folders for a small table.
    files.write_detail(events.withColumn("event_date", F.trunc("event_date", "year")), path)
    return serving.product_ranking_seeking(files.read_detail(spark, path))


@query(star.behavior_li)
def product_ranking_approx(events):
    """The ranking with sketched users beside the exact one."""
    exact = serving.product_ranking(events)
    sketched = serving.product_ranking(events, exact_uv=False).select(
        "product_id", F.col("uv").alias("approx_uv"))
    return exact.join(sketched, "product_id").select(
        *exact.columns, _within("approx_uv", "uv").alias("approx_within_bound"))


@query(star.behavior_li)
def product_metrics(events):
    return serving.product_metrics(events)


@query()
def funnel_report(events):
    return serving.funnel_report(funnel.funnel_daily(events))


@query(name="retention")
def retention_report(events):
    return serving.retention(retention.retention_matrix(events))


@query(star.behavior_li)
def user_segments(events):
    return serving.user_segments(_segmented(events))


@query(star.behavior_li)
def user_segments_summary(events):
    return serving.user_segments_summary(_segmented(events))


@query(name="avg_order_value")
def order_value(events):
    ranking = serving.category_ranking(win.category_windows(events))
    return ranking.select("category_id", F.round(avg_order_value(), 2).alias("avg_order_value"))


@query()
def funnel_stages(events):
    return funnel.funnel_stages(funnel.funnel_daily(events))


@query(star.behavior_li)
def high_value_share(events):
    return serving.high_value_share(serving.user_segments(_segmented(events)))


@query()
def day1_retention(events):
    return serving.day1_retention(serving.retention(retention.retention_matrix(events)))


def _newest_of(windows: Callable, table) -> Callable[[DataFrame, int], DataFrame]:
    """Windows stored in day folders, then only the newest days read."""
    def read(events: DataFrame, rows: int) -> DataFrame:
        path = scratch_path(events.sparkSession, "windows")
        files.append_version(windows(events), path, 0)
        return files.read_newest(events.sparkSession, path, table, rows)
    return read


_global_newest = _newest_of(win.global_windows, REALTIME_GLOBAL)
_category_newest = _newest_of(win.category_windows, REALTIME_CATEGORY)
_brand_newest = _newest_of(win.brand_windows, REALTIME_BRAND)


@query()
def overview_stored(events):
    return serving.overview(_global_newest(events, 30))


@query()
def category_stats_stored(events):
    return serving.category_stats(_category_newest(events, 20))


@query()
def brand_stats_stored(events):
    return serving.brand_stats(_brand_newest(events, 20))


@query()
def latest_kpi_stored(events):
    return serving.latest_kpi(_global_newest(events, 1))


@query()
def pv_trend_stored(events):
    return serving.pv_trend(_global_newest(events, serving.TREND_WINDOWS))


@query()
def latest_kpi(events):
    return serving.latest_kpi(win.global_windows(events))


@query()
def pv_trend(events):
    return serving.pv_trend(win.global_windows(events))
