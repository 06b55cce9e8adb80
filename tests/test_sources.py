import pytest
from pyspark.sql import functions as F

from basketflow.operators.rollups import item_stats_daily
from basketflow.operators.funnel import funnel_daily
from basketflow.schema import FUNNEL_DAILY, REALTIME_BRAND
from basketflow.operators.windows import brand_windows
from basketflow.sources import external, files
from basketflow.sources.star import behavior, raw_columns
from builders import events, row


def test_rerun_of_a_range_replaces_only_its_days(spark, sf_dir, tmp_path):
    path = str(tmp_path / "funnel")
    everything = behavior(spark, sf_dir)
    files.write_replace(funnel_daily(everything), path, "event_date")
    few = events(spark, [row("2024-01-03 00:00:00")])
    files.write_replace(funnel_daily(few), path, "event_date")
    table = FUNNEL_DAILY.conform(spark.read.schema(FUNNEL_DAILY.schema).parquet(path))
    assert table.count() == 30
    assert table.filter("event_date = '2024-01-03'").first().view_cnt == 1
    assert table.filter("event_date = '2024-01-04'").first().view_cnt > 1


def test_rewriting_a_version_replaces_it(spark, tmp_path):
    path = str(tmp_path / "windows")
    frame = brand_windows(events(spark, [row("2024-01-01 00:00:00")]))
    for version in (1, 2, 2):
        files.append_version(frame, path, version)
    assert spark.read.parquet(path).count() == 2
    assert files.read_latest(spark, path, REALTIME_BRAND).count() == 1


def test_error_budget(spark):
    raw = spark.createDataFrame(
        [("2019-11-01 00:00:00 UTC", "view", "1", "2", "", "", "1.5", "3", "s"),
         ("-1", "odd", "x", "2", "", "", "", "3", "s")],
        "event_time string, event_type string, product_id string, category_id string, "
        "category_code string, brand string, price string, user_id string, user_session string")
    assert files.bulk_load(raw, max_unreadable=1).count() == 1
    with pytest.raises(ValueError):
        files.bulk_load(raw, max_unreadable=0)


def test_bulk_load_keeps_unknown_types_and_bad_numbers(spark, sf_dir, tmp_path):
    path = str(tmp_path / "csv")
    raw_columns(spark, sf_dir).write.option("header", True).csv(path)
    loaded = files.bulk_load(files.read_raw_csv(spark, path))
    kinds = {r.event_type for r in loaded.select("event_type").distinct().collect()}
    assert kinds == {"view", "cart", "purchase", "error", "signup"}
    broken = loaded.filter("event_type = 'error'")
    assert broken.filter("user_id <> 0 OR price <> 0").count() == 0 < broken.count()


def test_lines_with_wrong_field_counts_and_values_too_large_are_refused(spark, tmp_path):
    path = tmp_path / "h.csv"
    good = "2019-11-01 00:00:00 UTC,view,1,2,c,{brand},{price},3,s"
    path.write_text("\n".join([
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session",
        good.format(brand='"a ""q"" z"', price="1.50"),
        "2019-11-01 00:00:00 UTC,view,1",
        good.format(brand="b", price="1") + ",extra,fields",
        "never,view,1,2,c,b,1,3,s",
        good.replace(",2,", ",18446744073709551615,").format(brand="b", price="1"),
        good.format(brand="b", price="123456789.00"),
        good.format(brand="b", price="n/a")]) + "\n")
    raw = files.read_raw_csv(spark, str(path))
    assert {r.reason: r.rows for r in files.bulk_load_rejects(raw).collect()} == {
        "fields": 2, "time": 1, "id": 1, "price": 1}
    loaded = sorted((r.brand, str(r.price)) for r in files.bulk_load(raw).collect())
    assert loaded == [('a "q" z', "1.50"), ("b", "0.00")]
    with pytest.raises(ValueError, match="5 rows"):
        files.bulk_load(raw, max_unreadable=4)


def test_days_are_written_as_few_files(spark, sf_dir, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        stats = item_stats_daily(behavior(spark, sf_dir))
        files.write_replace(stats, str(tmp_path / "items"), "event_date")
        files.write_detail(behavior(spark, sf_dir), str(tmp_path / "detail"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("items", "detail"):
        assert len(list((tmp_path / name).glob("*/*.parquet"))) == 30


def test_published_slices_appear_in_order(spark, tmp_path):
    inbox = tmp_path / "inbox"
    rows = spark.createDataFrame([(f"{i:04d}", i // 10) for i in range(40)], "value string, slice int")
    assert files.publish_slices(rows.coalesce(1), str(inbox)) == 4
    assert files.publish_slices(rows.coalesce(1).selectExpr("'9' || value AS value", "slice"),
                                str(inbox)) == 4
    found = sorted(inbox.glob("*.txt"), key=lambda f: f.stat().st_mtime_ns)
    assert len({f.stat().st_mtime_ns // 10**6 for f in found}) == 8
    text = "".join(f.read_text() for f in found).split()
    assert text == [f"{i:04d}" for i in range(40)] + [f"9{i:04d}" for i in range(40)]
    assert not list(inbox.glob("_aside*"))


def test_slices_are_sent_to_a_broker_one_after_the_other(spark):
    rows = spark.createDataFrame([("k", str(i), i // 3) for i in range(9)],
                                 "key string, value string, slice int").repartition(4)
    sent = []
    assert external.write_kafka_in_order(
        rows, "h:1", "t", lambda part, *_: sent.append({r.value for r in part.collect()})) == 3
    assert sent == [{"0", "1", "2"}, {"3", "4", "5"}, {"6", "7", "8"}]


def test_connector_options():
    kafka = external.kafka_options("h:1", "t", 100)
    assert kafka["startingOffsets"] == "earliest" and kafka["maxOffsetsPerTrigger"] == "100"
    jdbc = external.jdbc_options("jdbc:x", "SELECT 1", "user_id", 0, 9, 4)
    assert jdbc["dbtable"] == "(SELECT 1) AS src" and jdbc["numPartitions"] == "4"
