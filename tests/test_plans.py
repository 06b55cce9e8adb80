"""Physical plans that must hold at scale."""

import pytest

import __spark_entry__ as contract
from pyspark.sql import functions as F

from basketflow.operators import rollups
from basketflow.operators.funnel import funnel_daily
from basketflow.operators.retention import retention_matrix
from basketflow.operators.windows import brand_windows
from basketflow.plans.serving import overview, product_ranking, product_ranking_seeking
from basketflow.operators.rfm import last_days, rfm_base
from basketflow.schema import REALTIME_BRAND, REALTIME_GLOBAL
from basketflow.sources import files
from basketflow.sources.files import (
    append_version, read_detail, read_latest, read_newest, read_pruned, write_detail,
)
from basketflow.sources.star import behavior, behavior_li


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def detail(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "detail")
    write_detail(behavior(spark, sf_dir), path)
    return read_detail(spark, path)


def test_range_prunes_partitions_and_columns(detail):
    plan = plan_of(read_pruned(detail, "2024-01-05", "2024-01-14"))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<event_type:string,price:decimal(10,2),user_id:bigint>" in plan


def test_window_metrics_push_the_type_filter(detail):
    plan = plan_of(brand_windows(detail))
    assert "In(event_type, [purchase,view])" in plan
    assert "session_id" not in plan


def test_funnel_has_two_exchanges_and_no_expand(detail):
    plan = plan_of(funnel_daily(detail))
    assert plan.count("\n(") and "Expand" not in plan
    assert sum("Exchange" in line and line.startswith("(") for line in plan.splitlines()) == 2


def test_profiles_read_events_once(detail):
    users = last_days(detail)
    plan = plan_of(users)
    assert sum(line.startswith("(") and "Scan parquet" in line for line in plan.splitlines()) == 1


def test_rfm_base_reads_pinned_users_only(spark, detail):
    """Whatever is made of the users, events are not read and joined again."""
    users = rfm_base(detail)
    assert not set(users.inputFiles()) & set(detail.inputFiles())
    assert "event_type" not in plan_of(users)


def test_a_day_range_of_a_stream_table_prunes_folders(spark, tmp_path_factory, detail):
    path = str(tmp_path_factory.mktemp("plans") / "windows")
    append_version(brand_windows(detail), path, 3)
    plan = plan_of(read_latest(spark, path, REALTIME_BRAND, "2024-01-05", "2024-01-06"))
    assert "PartitionFilters: [isnotnull(_day" in plan


def test_retention_reads_once(detail):
    plan = plan_of(retention_matrix(detail))
    assert sum(line.startswith("(") and "Scan parquet" in line for line in plan.splitlines()) == 1


def test_product_ranking_reads_twice(detail):
    plan = plan_of(product_ranking(detail))
    assert sum(line.startswith("(") and "Scan parquet" in line for line in plan.splitlines()) == 2
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("stats", [
    rollups.item_stats_daily, rollups.category_stats_daily, rollups.brand_stats_daily,
    rollups.active_counts])
def test_daily_tables_read_detail_once(detail, stats):
    plan = plan_of(stats(detail))
    assert sum(line.startswith("(") and "Scan parquet" in line for line in plan.splitlines()) == 1
    assert "Join" not in plan


def test_items_do_not_double_events(detail):
    """Behind a product join both steps of the item table take its partitions as they are."""
    assert "Expand" not in plan_of(rollups.item_stats_daily(detail))
    dealt = detail.repartition(4, "product_id")
    plan = plan_of(rollups.item_stats_daily(dealt))
    assert sum("Exchange" in line and line.startswith("(") for line in plan.splitlines()) == 1


def test_ranking_from_items_does_not_double_events(detail):
    plan = plan_of(product_ranking(detail, items=rollups.item_stats_daily(detail)))
    assert "Expand" not in plan


def test_ranking_from_items_does_not_shuffle_viewers(detail):
    """Events go to their items and items to their products; viewers are the item table's own."""
    items = rollups.item_stats_daily(detail)
    totals = plan_of(items.groupBy("product_id").agg(F.sum("view_cnt"), F.sum("gmv")))
    assert "user_id" not in totals
    assert sum("Exchange" in line and line.startswith("(") for line in totals.splitlines()) == 2
    assert "user_id" in plan_of(items)


def test_newest_rows_read_few_days(spark, tmp_path_factory):
    """Months of windows, of which some were written several times."""
    path = str(tmp_path_factory.mktemp("plans") / "months")
    year = spark.range(120 * 24).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("window_start")).select(
        "window_start", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"),
        F.lit(1).cast("bigint").alias("pv"), F.lit(1).cast("bigint").alias("uv"),
        F.lit(0).cast("bigint").alias("purchase_cnt"), F.lit(0).cast("decimal(18,2)").alias("gmv"))
    for batch in range(3):
        late = year.filter(F.col("window_start") >= "2024-04-20") if batch else year
        append_version(late.withColumn("pv", F.lit(batch).cast("bigint")), path, batch)
    newest = read_newest(spark, path, REALTIME_GLOBAL, 30)
    want = read_latest(spark, path, REALTIME_GLOBAL).orderBy(F.col("window_start").desc()).limit(30)
    assert overview(newest).collect() == overview(want).collect()
    days = newest.select(F.to_date("window_start")).distinct().count()
    assert days == 3                            # one day, then two more: 24 + 48 rows
    assert "/_day=2024-04-29" in plan_of(newest) and len(newest.inputFiles()) <= 9
    assert read_newest(spark, path, REALTIME_GLOBAL, 10 ** 6).count() == 120 * 24
    assert read_newest(spark, path + "-none", REALTIME_GLOBAL, 5).count() == 0


def scan_rows(df) -> int:
    """Rows that came out of the file scans of an executed frame."""
    def leaves(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return leaves(plan.executedPlan())
        if "QueryStageExec" in name:
            return leaves(plan.plan())
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        return sum(map(leaves, below)) if below else (
            plan.metrics().apply("numOutputRows").value() if "Scan" in name else 0)

    df.collect()
    return leaves(df._jdf.queryExecution().executedPlan())


def test_winners_skip_pages_and_row_groups(spark, tmp_path_factory, monkeypatch):
    monkeypatch.setattr(files, "PAGE_ROWS", 100)
    path = str(tmp_path_factory.mktemp("plans") / "skip")
    rows = behavior_li(spark, "/root/testdata/sf0.01").withColumn("event_date", F.lit("2024-01-01").cast("date"))
    write_detail(rows.coalesce(1), path)
    detail = read_detail(spark, path)
    total = detail.count()
    ranking = product_ranking_seeking(detail, 5)
    assert ranking.collect() == product_ranking(detail, 5).collect()
    assert scan_rows(ranking) < total / 10
    items = rollups.item_stats_daily(detail)
    assert product_ranking_seeking(detail, 5, items=items).collect() == ranking.collect()
    assert product_ranking_seeking(detail.filter("false"), 5).count() == 0
    absent = detail.filter("product_id = -5").select("user_id")
    assert scan_rows(absent) == 0               # not one row group has it


EAGER = {"stream_idle_source", "replay_published", "retention_incremental", "active_user_incremental",
         "users_by_key", "uv_range_sketch", "uv_total_sketch", "price_points_sketch",
         "profiles_by_key", "profile_from_saved_model", "bulk_load", "bulk_load_rejects", "stream_late", "stream_fan_out", "stream_compacted",
         "windows_backfill", "write_replace", "write_detail", "replay_write", "latest_of_replays",
         "stream_source", "stream_detail", "stream_global", "stream_category", "stream_brand",
         "exactly_once_resume", "user_profile", "rfm_kmeans", "cluster_stats"}


OWN = {q for q in contract.queries() if q == "pipeline" or q.startswith("op") and q[2].isdigit()}


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - EAGER - OWN))
def test_no_python_workers_and_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    for refused in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
        assert refused not in plan
