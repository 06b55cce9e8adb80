"""The batch jobs on a detail table of about 110 million rows.

The table is made from ``behavior_li``: every row is repeated with shifted users and its day
folded into 61 days. ``--hot`` then gives a third of all rows to one user, product, brand and
day, which is the case the operators must survive.

    python bench_scale.py --work /tmp/run-x [--copies 184] [--hot] [--jobs funnel,retention]
"""

from __future__ import annotations

import argparse
import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators.funnel import funnel_daily
from basketflow.operators.increments import activity_masks
from basketflow.operators.latest import latest_by_key
from basketflow.operators.replay import sort_replay
from basketflow.operators.retention import retention_matrix
from basketflow.operators.rfm import user_profile
from basketflow.operators.rollups import (
    active_user_daily, brand_stats_daily, category_stats_daily, item_stats_daily,
)
from basketflow.operators.windows import brand_windows, global_windows
from basketflow.operators.sketches import brand_sketches
from basketflow.plans.serving import product_metrics, product_ranking, product_ranking_seeking
from basketflow.schema import DETAIL
from basketflow.session import build_session
from basketflow.sources.files import read_detail, write_detail
from basketflow.sources.star import behavior_li

JOBS = {
    "funnel": funnel_daily,
    "retention": retention_matrix,
    "profiles": user_profile,
    "product_ranking": product_ranking,
    "product_ranking_seeking": product_ranking_seeking,
    "product_ranking_approx": lambda d: product_ranking(d, exact_uv=False),
    "product_metrics": product_metrics,
    "items": item_stats_daily,
    "categories": category_stats_daily,
    "brands": brand_stats_daily,
    "active_users": active_user_daily,
    "global_windows": lambda d: global_windows(d, "60 seconds"),
    "brand_windows": brand_windows,
    "latest": lambda d: latest_by_key(
        d.select("user_id", "product_id", "event_time", "event_type"), ["user_id"], "event_time"),
    "sort_replay": sort_replay,
    "activity_masks": activity_masks,
    "brand_sketches": brand_sketches,
    "one_day_masks": lambda d: activity_masks(d.filter("event_date = '2019-11-10'")),
}


def enlarge(events: DataFrame, copies: int, hot: bool) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    day = F.date_add(F.lit("2019-10-01").cast("date"),
                     F.pmod(F.datediff("event_date", F.lit("1992-01-01").cast("date")), F.lit(61)))
    second = F.pmod(F.xxhash64("user_id", "product_id", "copy"), F.lit(86400))
    rows = (events.withColumn("copy", copy)
            .withColumn("user_id", F.col("user_id") + F.col("copy") * 100_000)
            .withColumn("event_date", day)
            .withColumn("event_time", F.timestamp_seconds(
                F.unix_seconds(F.col("event_date").cast("timestamp")) + second)))
    if hot:
        chosen = F.pmod(F.xxhash64("user_id", "product_id", "event_time"), F.lit(3)) == 0
        fixed = {
            "user_id": F.lit(7).cast("bigint"),
            "product_id": F.lit(11).cast("bigint"),
            "category_id": F.lit(2053013555631882655),
            "brand": F.lit("Brand#1"),
            "event_date": F.lit("2019-11-11").cast("date"),
            "event_time": F.lit("2019-11-11 00:00:00").cast("timestamp"),
        }
        rows = rows.withColumn("chosen", chosen).withColumns(
            {c: F.when(F.col("chosen"), v).otherwise(F.col(c)) for c, v in fixed.items()})
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_date").cast("string"))
    return DETAIL.conform(rows.withColumn("session_id", session))


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--work", required=True)
    parser.add_argument("--source", default="/root/testdata/sf0.1")
    parser.add_argument("--copies", type=int, default=184)
    parser.add_argument("--hot", action="store_true")
    parser.add_argument("--jobs", default=",".join(JOBS))
    parser.add_argument("--cpus", default="8")
    args = parser.parse_args()

    spark: SparkSession = build_session("bench-scale", f"local[{args.cpus}]", {
        "spark.sql.shuffle.partitions": "64",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"{args.work}/checkpoints",
        "spark.local.dir": f"{args.work}/local",
    })
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{args.work}/detail-{args.copies}{'-hot' if args.hot else ''}"
    if not os.path.exists(path):
        began = time.perf_counter()
        write_detail(enlarge(behavior_li(spark, args.source).repartition(32), args.copies, args.hot), path)
        print(json.dumps({"job": "write_detail", "seconds": round(time.perf_counter() - began, 1)}),
              flush=True)
    detail = read_detail(spark, path)
    rows = detail.count()
    for name in args.jobs.split(","):
        began = time.perf_counter()
        JOBS[name](detail).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - began
        print(json.dumps({"job": name, "hot": args.hot, "rows": rows, "seconds": round(took, 2),
                          "rows_per_sec": round(rows / took)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
