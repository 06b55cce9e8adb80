"""Headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The events, line-item events and raw lines are written once, as a user's detail table and log files
would lie there, so that the operators are timed and not the joins that make the fixture. Every
operator runs once unmeasured, then BENCH_RUNS times into a sink that computes every column and
keeps nothing; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from basketflow.operators.rollups import item_stats_daily
from basketflow.plans.catalog import PARTS
from basketflow.plans.serving import product_ranking, product_ranking_seeking
from basketflow.session import build_session, tune
from basketflow.sources import star
from basketflow.sources.files import read_detail, write_detail

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Query -> the table whose rows it consumes.
HEADLINE = {
    "funnel_daily_li": "lineitem",
    "retention_matrix_li": "lineitem",
    "rfm_scores": "lineitem",
    "user_profile": "lineitem",
    "product_ranking_li": "lineitem",
    "product_ranking_from_items": "lineitem",
    "product_ranking_seeking": "lineitem",
    "product_ranking_approx": "lineitem",
    "item_stats_daily_li": "lineitem",
    "category_stats_daily_li": "lineitem",
    "brand_stats_daily_li": "lineitem",
    "active_user_daily_li": "lineitem",
    "win_global": "events",
    "win_category": "events",
    "win_brand": "events",
    "brand_ranking": "events",
    "clean_events": "events",
    "latest_by_key": "events",
}


def prepare(spark: SparkSession, root: str) -> dict[object, DataFrame]:
    """Each source written once and read back."""
    out = {}
    for source in (star.behavior, star.behavior_li):
        path = f"{root}/{source.__name__}"
        write_detail(source(spark, SF_DIR), path)
        out[source] = read_detail(spark, path)
    items = f"{root}/items"
    item_stats_daily(out[star.behavior_li]).write.parquet(items)
    out["items"] = spark.read.parquet(items)
    star.raw_lines(spark, SF_DIR).repartition(int(CPUS)).write.text(f"{root}/lines")
    out[star.raw_lines] = spark.read.text(f"{root}/lines")
    return out


def main() -> None:
    spark: SparkSession = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    prepared = prepare(spark, tempfile.mkdtemp(prefix="bench-"))
    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count()
            for t in sorted(set(HEADLINE.values()))}

    # Operators that rest on a table another job has written.
    detail = prepared[star.behavior_li]
    kept = {
        "product_ranking_from_items": lambda: product_ranking(detail, items=prepared["items"]),
        "product_ranking_seeking": lambda: product_ranking_seeking(detail, items=prepared["items"]),
    }

    def result(name: str) -> DataFrame:
        if name in kept:
            return kept[name]()
        source, operator = PARTS[name]
        return operator(prepared[source])

    def run(name: str) -> float:
        began = time.perf_counter()
        result(name).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "headline query time, median, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {n: round(rows[t] / seconds[n]) for n, t in HEADLINE.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
