"""Streams fed by time-ordered file slices, compared with the batch definition."""

import time

import pytest
from pyspark.sql import functions as F

from basketflow.operators.replay import replay_slices
from basketflow.operators.windows import brand_windows, category_windows, global_windows
from basketflow.plans import catalog
from basketflow.schema import DETAIL, REALTIME_BRAND, REALTIME_CATEGORY, REALTIME_GLOBAL
from basketflow.session import scratch_path
from basketflow.sources import files, star
from basketflow.sources.files import append_version, compact, read_detail, read_latest
from basketflow.sources.star import behavior
from basketflow.streaming.queries import (
    LateRows, await_all, start_all, start_windows, windowed_outputs, with_event_time,
)
from basketflow.streaming.sinks import versioned_sink
from builders import events, row

ONCE = {"availableNow": True}


def feed(frame, folder):
    """Write one more input file; the stream takes files by modification time."""
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def source(spark, folder, per_batch=1):
    return (spark.readStream.schema(DETAIL.schema).option("maxFilesPerTrigger", per_batch)
            .parquet(str(folder)))


def closed(stats, newest):
    return stats.filter(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 30 SECONDS"))


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def slices(spark, sf_dir):
    frame = behavior(spark, sf_dir)
    cut = replay_slices(frame, 4).persist()
    yield [cut.filter(F.col("slice") == i).drop("slice") for i in range(4)], frame
    cut.unpersist()


def finish(running):
    for query in running.values():
        query.awaitTermination()


def test_fan_out_equals_batch_and_resumes(spark, tmp_path, slices):
    parts, frame = slices
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    for part in parts[:2]:
        feed(part, inbox)
    finish(start_all(source(spark, inbox), out, ck, ONCE))
    for part in parts[2:]:
        feed(part, inbox)
    finish(start_all(source(spark, inbox), out, ck, ONCE))
    # A third start finds nothing new and must not add rows.
    finish(start_all(source(spark, inbox), out, ck, ONCE))

    newest = frame.agg(F.max("event_time")).first()[0]
    same(read_detail(spark, f"{out}/{DETAIL.name}"), frame)
    for table, batch in ((REALTIME_GLOBAL, global_windows), (REALTIME_CATEGORY, category_windows),
                         (REALTIME_BRAND, brand_windows)):
        stored = spark.read.parquet(f"{out}/{table.name}")
        latest = read_latest(spark, f"{out}/{table.name}", table)
        same(latest, table.conform(closed(batch(frame), newest)))
        assert stored.count() == latest.count()


def test_lost_sink_commit_is_replayed_into_the_same_version(spark, tmp_path, slices):
    parts, frame = slices
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), tmp_path / "ck"
    for part in parts:
        feed(part, inbox)

    def run():
        stats = windowed_outputs(source(spark, inbox))[REALTIME_BRAND.name]
        query = start_windows(stats, "replayed", out, str(ck), ONCE)
        query.awaitTermination()

    run()
    before = spark.read.parquet(out).count()
    last = max(int(p.name) for p in (ck / "commits").iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        target = ck / "commits" / name
        if target.exists():
            target.unlink()
    run()
    assert spark.read.parquet(out).count() == before


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    on_time = [row("2024-01-01 00:00:01"), row("2024-01-01 00:00:02", user=2)]
    batches = [on_time, [row("2024-01-01 00:05:00")], [row("2024-01-01 00:06:00")],
               [row("2024-01-01 00:00:03", user=3)], [row("2024-01-01 00:07:00")]]
    for rows in batches:
        feed(events(spark, rows), inbox)
    stats = windowed_outputs(source(spark, inbox), "60 seconds")[REALTIME_GLOBAL.name]
    late = LateRows().attach(spark)
    query = start_windows(stats, "late", out, ck, ONCE)
    query.awaitTermination()
    deadline = time.monotonic() + 20
    while late.of(query) < 1 and time.monotonic() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(late)
    first = read_latest(spark, out, REALTIME_GLOBAL).orderBy("window_start").first()
    assert (first.pv, first.uv) == (2, 2)
    assert late.of(query) == 1


def test_rows_within_the_delay_are_kept(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    batches = [[row("2024-01-01 00:01:20")], [row("2024-01-01 00:00:59", user=2)],
               [row("2024-01-01 00:09:00")]]
    for rows in batches:
        feed(events(spark, rows), inbox)
    stats = windowed_outputs(source(spark, inbox), "60 seconds")[REALTIME_GLOBAL.name]
    start_windows(stats, "kept", out, ck, ONCE).awaitTermination()
    got = {r.window_start.minute: r.pv for r in read_latest(spark, out, REALTIME_GLOBAL).collect()}
    assert got == {0: 1, 1: 1}


def test_carts_move_the_watermark(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    feed(events(spark, [row("2024-01-01 00:00:01"), row("2024-01-01 00:10:00", "cart")]), inbox)
    stats = windowed_outputs(source(spark, inbox), "60 seconds")[REALTIME_GLOBAL.name]
    start_windows(stats, "carts", out, ck, ONCE).awaitTermination()
    assert read_latest(spark, out, REALTIME_GLOBAL).count() == 1


def test_approximate_viewers_in_a_stream(spark, tmp_path, slices):
    parts, frame = slices
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    for part in parts:
        feed(part, inbox)
    stats = brand_windows(with_event_time(source(spark, inbox)), "1 day", exact_uv=False)
    start_windows(stats, "approx", out, ck, ONCE).awaitTermination()
    newest = frame.agg(F.max("event_time")).first()[0]
    same(read_latest(spark, out, REALTIME_BRAND),
         REALTIME_BRAND.conform(closed(brand_windows(frame, "1 day"), newest)))


def test_late_rows_outlive_the_progress_reports(spark, tmp_path):
    """The count goes on although Spark keeps two reports only."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    inbox, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    feed(events(spark, [row("2024-01-01 01:00:00")]), inbox)
    feed(events(spark, [row("2024-01-01 02:00:00")]), inbox)
    for k in range(6):
        feed(events(spark, [row("2024-01-01 00:00:03", user=k)]), inbox)
    stats = windowed_outputs(source(spark, inbox), "60 seconds")[REALTIME_GLOBAL.name]
    late = LateRows().attach(spark)
    query = start_windows(stats, "late-long", out, ck, ONCE)
    query.awaitTermination()
    deadline = time.monotonic() + 20
    while late.of(query) < 6 and time.monotonic() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(late)
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert late.of(query) == 6 and len(query.recentProgress) <= 3


def test_a_new_checkpoint_outranks_the_old_one(spark, tmp_path, slices):
    parts, frame = slices
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    for part in parts:
        feed(part, inbox)
    for turn, only in enumerate(("view", "purchase")):
        source_ = source(spark, inbox).filter(F.col("event_type").isin(only, "cart"))
        stats = windowed_outputs(source_)[REALTIME_BRAND.name]
        start_windows(stats, f"turn{turn}", out, str(tmp_path / f"ck{turn}"), ONCE).awaitTermination()
    got = read_latest(spark, out, REALTIME_BRAND).filter("purchase_cnt > 0")
    assert got.count() > 0 and got.filter("pv > 0").count() == 0


def test_a_failed_branch_stops_the_rest(spark, tmp_path, slices):
    parts, _ = slices
    inbox = tmp_path / "in"
    feed(parts[0], inbox)
    good = windowed_outputs(source(spark, inbox))[REALTIME_BRAND.name]
    bad = source(spark, inbox).withColumn("event_type", F.raise_error(F.lit("broken")).cast("string"))
    running = {
        "good": start_windows(good, "good", str(tmp_path / "a"), str(tmp_path / "cka"),
                              {"processingTime": "1 second"}),
        "bad": start_windows(windowed_outputs(bad)[REALTIME_BRAND.name], "bad", str(tmp_path / "b"),
                             str(tmp_path / "ckb"), {"processingTime": "1 second"})}
    with pytest.raises(Exception, match="broken"):
        await_all(running)
    assert not running["good"].isActive


def test_compaction_leaves_one_row_per_key(spark, tmp_path, slices):
    parts, frame = slices
    path = str(tmp_path / "t")
    for batch, part in enumerate(parts):
        append_version(brand_windows(part, "1 day"), path, batch)
    append_version(brand_windows(frame, "1 day"), path, 0, generation=1)
    before = read_latest(spark, path, REALTIME_BRAND)
    want = before.collect()
    assert compact(spark, path, REALTIME_BRAND, "2024-01-15") > 0
    after = read_latest(spark, path, REALTIME_BRAND)
    assert sorted(map(str, after.collect())) == sorted(map(str, want))
    early = spark.read.parquet(path).filter("_day < '2024-01-15'")
    assert early.count() == early.select("window_start", "brand").distinct().count()
    assert compact(spark, path, REALTIME_BRAND, "2024-01-15") == 0


def test_an_empty_batch_is_looked_at_in_one_pass(spark, tmp_path):
    """A first row is not searched for in one partition, then four, then more."""
    none = spark.range(0, 400, 1, 200).filter("id < 0").select(
        F.timestamp_seconds("id").alias("window_start"), "id")
    context = spark.sparkContext
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # as streams with state run
    context.setJobGroup("look", "look")
    versioned_sink(str(tmp_path / "t"))(none, 0)
    context.setLocalProperty("spark.jobGroup.id", None)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(context.statusTracker().getJobIdsForGroup("look")) <= 2
    assert not (tmp_path / "t").exists()


def test_compaction_merges_all_days_at_once(spark, tmp_path, monkeypatch):
    """Days whose newest versions differ go into one write, each with its own version."""
    path = str(tmp_path / "t")
    for batch, times in enumerate((["2024-01-01", "2024-01-02"], ["2024-01-01"], ["2024-01-02", "2024-01-03"])):
        rows = events(spark, [row(f"{day} 00:00:0{batch}") for day in times])
        append_version(brand_windows(rows, "1 day"), path, batch, generation=batch % 2)
    want = sorted(map(str, read_latest(spark, path, REALTIME_BRAND).collect()))
    writes, write = [], files._write_versions
    monkeypatch.setattr(files, "_write_versions", lambda *a: (writes.append(a), write(*a)))
    assert compact(spark, path, REALTIME_BRAND, "2024-01-09") == 2
    assert len(writes) == 1
    stored = spark.read.parquet(path)
    kept = {(str(r["_day"]), r["_generation"], r["_batch"], r["_pass"]) for r in stored.collect()}
    assert kept == {("2024-01-01", 1, 1, 1), ("2024-01-02", 0, 2, 1), ("2024-01-03", 0, 2, 0)}
    assert sorted(map(str, read_latest(spark, path, REALTIME_BRAND).collect())) == want


@pytest.mark.parametrize("name, inboxes", [("stream_idle_source", ["busy"]), ("stream_late", ["late-in"])])
def test_input_of_streams_is_written_in_parallel(spark, sf_dir, monkeypatch, name, inboxes):
    monkeypatch.setattr(star, "behavior", lambda *a: behavior(*a).repartition(3))
    made = []
    monkeypatch.setattr(catalog, "scratch_path", lambda s, n: made.append(scratch_path(s, n)) or made[-1])
    catalog.queries()[name](spark, sf_dir).collect()
    for inbox in inboxes:
        path = next(p for p in made if p.rsplit("/", 1)[1].startswith(inbox))
        sizes = [r.n for r in spark.read.parquet(path).groupBy(F.input_file_name())
                 .agg(F.count("*").alias("n")).collect()]
        assert len(sizes) >= 3 and max(sizes) < sum(sizes) / 2
