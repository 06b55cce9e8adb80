"""The whole path: history and replay in, result tables out, as a user would run it."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketflow.operators.windows import brand_windows
from basketflow.plans import serving
from basketflow.plans.jobs import main
from basketflow.schema import (
    DETAIL, FUNNEL_DAILY, REALTIME_BRAND, REALTIME_GLOBAL, RETENTION_DAILY, USER_PROFILE,
)
from basketflow.session import checkpoint_root, is_local, scratch_path
from basketflow.sources.files import read_detail, read_latest
from basketflow.sources.star import raw_columns
from basketflow.sources.versions import read_table
from basketflow.streaming.queries import await_all, start_all

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def work(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    raw_columns(spark, sf_dir).write.option("header", True).csv(f"{root}/history")
    main(["load", "--csv", f"{root}/history", "--out", f"{root}/detail",
          "--max-unreadable", "0"], spark)
    return root


def test_batch_tables(spark, work):
    detail = read_detail(spark, f"{work}/detail")
    for job, table in (("funnel", FUNNEL_DAILY), ("retention", RETENTION_DAILY),
                       ("profiles", USER_PROFILE)):
        for _ in range(2):
            main([job, "--detail", f"{work}/detail", "--out", f"{work}/{job}"], spark)
        path = f"{work}/{job}"
        stored = table.conform(spark.read.parquet(path)) if job == "funnel" \
            else read_table(spark, path, table)
        assert stored.count() == stored.dropDuplicates(list(table.key)).count() > 0
    profiles = read_table(spark, f"{work}/profiles", USER_PROFILE)
    assert profiles.count() == detail.select("user_id").distinct().count()
    assert serving.user_segments_summary(profiles).first().total_users == profiles.count()


def test_funnel_range_leaves_other_days(spark, work):
    out = f"{work}/funnel-range"
    main(["funnel", "--detail", f"{work}/detail", "--out", out], spark)
    main(["funnel", "--detail", f"{work}/detail", "--out", out,
          "--start", "2024-01-05", "--end", "2024-01-06"], spark)
    assert spark.read.parquet(out).count() == 30


def test_replay_then_stream(spark, work):
    main(["replay", "--csv", f"{work}/history", "--out", f"{work}/slices", "--slices", "4"], spark)
    replayed = spark.read.text(f"{work}/slices")
    assert replayed.count() == read_detail(spark, f"{work}/detail").filter("event_type <> 'error'").count()
    main(["stream", "--lines", f"{work}/slices/*", "--out", f"{work}/live",
          "--checkpoints", f"{work}/ck", "--once", "--global-seconds", "60"], spark)
    detail = read_detail(spark, f"{work}/live/{DETAIL.name}")
    assert {r[0] for r in detail.select("event_type").distinct().collect()} == {
        "view", "cart", "purchase"}
    minutes = read_latest(spark, f"{work}/live/{REALTIME_GLOBAL.name}", REALTIME_GLOBAL)
    brands = read_latest(spark, f"{work}/live/{REALTIME_BRAND.name}", REALTIME_BRAND)
    totals = [t.agg(F.sum("pv"), F.sum("gmv")).first() for t in (minutes, brands)]
    assert totals[0] == totals[1]
    assert serving.overview(minutes).count() == 30


def test_backfill_then_stream_from_the_cut_over_day(spark, work):
    """History by the windows job, the rest by the stream: together they equal one batch."""
    cut = "2024-01-20"
    main(["windows", "--detail", f"{work}/detail", "--out", f"{work}/mix", "--end", "2024-01-19"], spark)
    detail = read_detail(spark, f"{work}/detail").filter("event_type <> 'error'")
    later = detail.filter(F.col("event_date") >= cut)
    inbox = f"{work}/mix-in"
    later.coalesce(1).write.parquet(inbox)
    stream = spark.readStream.schema(DETAIL.schema).parquet(inbox)
    await_all(start_all(stream, f"{work}/mix", f"{work}/mix-ck", {"availableNow": True}))
    newest = later.agg(F.max("event_time")).first()[0]
    want = brand_windows(detail).filter(
        (F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 30 SECONDS"))
        | (F.col("window_start") < F.lit(cut).cast("timestamp")))
    got = read_latest(spark, f"{work}/mix/{REALTIME_BRAND.name}", REALTIME_BRAND)
    assert got.exceptAll(REALTIME_BRAND.conform(want)).count() == 0
    assert got.count() == want.count()
    main(["compact", "--out", f"{work}/mix", "--end", cut], spark)
    again = read_latest(spark, f"{work}/mix/{REALTIME_BRAND.name}", REALTIME_BRAND)
    assert again.count() == want.count()


def test_a_backfill_does_not_outrank_a_stream_that_may_run(spark, work):
    out = f"{work}/guarded"
    job = ["windows", "--detail", f"{work}/detail", "--out", out]
    main(job, spark)
    with pytest.raises(ValueError, match="--stream-stopped"):
        main(job, spark)
    main([*job, "--end", "2024-01-10"], spark)
    main([*job, "--stream-stopped"], spark)


def test_replay_publishes_slices_for_a_stream(spark, work):
    main(["replay", "--csv", f"{work}/history", "--out", f"{work}/inbox", "--slices", "3", "--publish"], spark)
    assert len(list((work / "inbox").glob("*.txt"))) == 3


def test_options_that_do_not_apply_are_refused(spark):
    with pytest.raises(SystemExit):
        main(["retention", "--detail", "x", "--out", "y", "--start", "2024-01-01"], spark)
    with pytest.raises(SystemExit):
        main(["replay", "--csv", "x", "--servers", "h:1"], spark)


def test_only_a_local_master_may_do_without_a_shared_folder():
    assert is_local("local") and is_local("local[4]") and is_local("local[*]")
    assert not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    assert not is_local("spark://host:7077")


def test_slices_stay_in_time_order_when_the_sort_spills(tmp_path, sf_dir):
    """In a session that spills every 200 rows, each written slice file ascends in time."""
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from basketflow.session import build_session
from basketflow.plans.jobs import main
from basketflow.sources.star import raw_columns
from basketflow.sources.versions import read_table
spark = build_session("spill", "local[2]", {{
    "spark.shuffle.spill.numElementsForceSpillThreshold": "200", "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "3", "spark.checkpoint.dir": {str(tmp_path / 'ck')!r}}})
raw_columns(spark, {sf_dir!r}).write.option("header", True).csv({str(tmp_path / 'h')!r})
main(["replay", "--csv", {str(tmp_path / 'h')!r}, "--out", {str(tmp_path / 's')!r},
      "--slices", "3"], spark)
"""
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True, timeout=240)
    files = list((tmp_path / "s").glob("slice=*/part-*"))
    lines = [f.read_text().splitlines() for f in files]
    assert sum(map(len, lines)) > 600
    assert all(own == sorted(own, key=lambda line: line[:19]) for own in lines)


def test_scratch_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured
    assert scratch_path(spark, "x").startswith(configured)
    assert configured.rstrip("/") in spark.sparkContext.getCheckpointDir()
