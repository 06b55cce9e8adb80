"""The jobs behind ``run_job.py``: history load, batch tables, stream and replay."""

from __future__ import annotations

import argparse
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_events, coarse_valid, filter_date_range
from ..operators.dim_user import dim_user
from ..operators.funnel import funnel_daily
from ..operators.replay import replay_slices, shift_lines
from ..operators.retention import retention_matrix
from ..operators.rfm import user_profile
from ..operators.rollups import (
    active_user_daily, brand_stats_daily, category_stats_daily, item_stats_daily,
)
from ..operators.windows import brand_windows, category_windows, global_windows
from ..functions.text import parse_source_time
from ..schema import REALTIME_BRAND, REALTIME_CATEGORY, REALTIME_GLOBAL
from ..session import build_session, clear_scratch
from ..sources.external import kafka_lines, write_kafka_in_order
from ..sources.files import (
    append_version, bulk_load, compact, next_generation, publish_slices, read_detail, read_raw_csv,
    stored_days, write_detail, write_replace,
)
from ..sources.versions import replace_table
from ..streaming.queries import WATERMARK, await_all, start_all
from . import daily

# Tables a rerun over a date range replaces day by day.
DAILY = {
    "funnel": funnel_daily,
    "items": item_stats_daily,
    "categories": category_stats_daily,
    "brands": brand_stats_daily,
}
# Tables that need the whole history and get a new version (read them with ``versions.read_table``).
WHOLE = {
    "retention": retention_matrix,
    "profiles": user_profile,
    "active-users": active_user_daily,
    "users": dim_user,
}


def run_load(spark: SparkSession, args: argparse.Namespace) -> None:
    write_detail(bulk_load(read_raw_csv(spark, args.csv), args.max_unreadable), args.out)


def run_table(spark: SparkSession, args: argparse.Namespace) -> None:
    detail = read_detail(spark, args.detail)
    if args.job in DAILY:
        days = filter_date_range(detail, args.start, args.end)
        write_replace(DAILY[args.job](days), args.out, "event_date")
    else:
        replace_table(WHOLE[args.job](detail), args.out)


def run_days(spark: SparkSession, args: argparse.Namespace) -> None:
    """Retention, active users, first days and sketches up to date, from the days given alone."""
    daily.update(read_detail(spark, args.detail), args.out, args.start, args.end)


def run_windows(spark: SparkSession, args: argparse.Namespace) -> None:
    """History into the three window tables without a stream: days from detail, in bounded memory.

    The rows form a generation of their own, so they replace what a stream wrote for these
    days; a stream started later outranks them from its first window on. They would also outrank
    the later windows of a stream that is still running, so the newest stored day, which a stream
    may be writing, is refused unless ``--stream-stopped`` says that none is.
    """
    for table in (REALTIME_GLOBAL, REALTIME_CATEGORY, REALTIME_BRAND):
        newest = next(iter(stored_days(spark, f"{args.out}/{table.name}")), None)
        if newest and not args.stream_stopped and (args.end is None or args.end >= newest):
            raise ValueError(f"{table.name} holds windows up to {newest}, which a stream may still be "
                             "writing: end before that day, or pass --stream-stopped")
    days = filter_date_range(read_detail(spark, args.detail), args.start, args.end)
    wide = f"{args.global_seconds} seconds", f"{args.dimension_seconds} seconds"
    for table, stats in ((REALTIME_GLOBAL, global_windows(days, wide[0])),
                         (REALTIME_CATEGORY, category_windows(days, wide[1])),
                         (REALTIME_BRAND, brand_windows(days, wide[1]))):
        path = f"{args.out}/{table.name}"
        append_version(stats, path, 0, next_generation(spark, path))


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """One row per key for every day before ``--end`` in the window tables under ``--out``."""
    for table in (REALTIME_GLOBAL, REALTIME_CATEGORY, REALTIME_BRAND):
        compact(spark, f"{args.out}/{table.name}", table, args.end)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Lines from a topic or from text files arriving in a folder, into four tables.

    ``--max-files`` and ``--max-offsets`` bound a batch, and with it the state that a start over
    a long backlog builds. Bounded batches need input in time order within ``--watermark``; for
    history use the windows job instead.
    """
    if args.servers:
        lines = kafka_lines(spark, args.servers, args.topic, args.max_offsets)
    else:
        reader = spark.readStream
        if args.max_files:
            reader = reader.option("maxFilesPerTrigger", args.max_files)
        lines = reader.text(args.lines)
    await_all(start_all(
        clean_events(lines), args.out, args.checkpoints,
        {"availableNow": True} if args.once else None, delay=args.watermark,
        global_width=f"{args.global_seconds} seconds",
        dimension_width=f"{args.dimension_seconds} seconds"))


def replay_lines(spark: SparkSession, path: str, anchor: datetime | None) -> DataFrame:
    """Valid raw lines, optionally moved so the newest lands on ``anchor``."""
    lines = coarse_valid(spark.read.text(path))
    return lines if anchor is None else shift_lines(lines, F.lit(anchor))


def run_replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """Ordered lines to a topic keyed by user, or to one folder per time slice."""
    anchor = datetime.now(timezone.utc) if args.shift_to_now else None
    lines = replay_lines(spark, args.csv, anchor).select(
        "value", F.split("value", ",")[7].alias("key"),
        parse_source_time(F.substring_index("value", ",", 1)).alias("event_time"))
    ordered = replay_slices(lines, args.slices)
    if args.servers:
        write_kafka_in_order(ordered, args.servers, args.topic)
    elif args.publish:
        publish_slices(ordered, args.out)
    else:
        ordered.select("value", "slice").write.mode("overwrite").partitionBy("slice").text(args.out)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="run_job.py")
    parser.add_argument("job", choices=[
        "load", "stream", "replay", "windows", "compact", "days", *DAILY, *WHOLE])
    parser.add_argument("--csv", help="raw history with a header line")
    parser.add_argument("--detail", help="detail table folder")
    parser.add_argument("--out", help="folder of the result")
    parser.add_argument("--start", help="first day, inclusive")
    parser.add_argument("--end", help="last day, inclusive")
    parser.add_argument("--max-unreadable", type=int, help="error budget of the load")
    parser.add_argument("--lines", help="folder the stream reads text files from")
    parser.add_argument("--servers", help="message broker, instead of folders")
    parser.add_argument("--topic", help="topic at the broker")
    parser.add_argument("--checkpoints", help="checkpoint folder of the stream")
    parser.add_argument("--once", action="store_true", help="stop after the available data")
    parser.add_argument("--max-files", type=int, help="input files of a batch at most")
    parser.add_argument("--max-offsets", type=int, help="broker records of a batch at most")
    parser.add_argument("--watermark", default=WATERMARK, help="how late an event may be")
    parser.add_argument("--global-seconds", type=int, default=1)
    parser.add_argument("--dimension-seconds", type=int, default=60)
    parser.add_argument("--shift-to-now", action="store_true")
    parser.add_argument("--slices", type=int, default=64)
    parser.add_argument("--publish", action="store_true",
                        help="slices become visible one after the other, for a stream that is reading")
    parser.add_argument("--stream-stopped", action="store_true",
                        help="no stream is writing the window tables")
    args = parser.parse_args(argv)
    if args.job in WHOLE and (args.start or args.end):
        parser.error(f"{args.job} always covers the whole history; leave --start and --end out")
    if args.servers and not args.topic:
        parser.error("--servers needs --topic")
    if args.job == "compact" and not args.end:
        parser.error("compact needs --end, the first day that is left alone")

    own = spark is None
    spark = spark or build_session(f"basketflow-{args.job}")
    began = time.monotonic()
    job = {"load": run_load, "stream": run_stream, "replay": run_replay, "windows": run_windows,
           "compact": run_compact, "days": run_days}.get(args.job, run_table)
    try:
        job(spark, args)
    finally:
        if own:
            clear_scratch(spark)
    print(f"{args.job}: {time.monotonic() - began:.1f} s")
