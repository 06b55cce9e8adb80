"""File readers and writers: CSV history, the day-partitioned detail table, result tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.cleaning import filter_date_range
from ..operators.latest import latest_by_key
from ..schema import DETAIL, RAW, Table
from ..session import delete_path, file_system

CORRUPT = "_corrupt"

# Different products of a row group that its bloom filter is sized for (about 120 KB).
BLOOM_PRODUCTS = 100_000
PAGE_ROWS = 4_000

# A stored row's version: the generation of the checkpoint that wrote it, the batch, and how often
# it has been compacted. Compared in this order.
DAY, GENERATION, BATCH, PASS = "_day", "_generation", "_batch", "_pass"
VERSION = [GENERATION, BATCH, PASS]
LAYOUT = [DAY, *VERSION]
LAYOUT_DDL = f"{DAY} date, {GENERATION} int, {BATCH} bigint, {PASS} int"


def read_raw_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Nine text columns, declared rather than inferred.

    Lines with fewer or more fields are kept whole in ``_corrupt``. Column pruning is off because
    a pruned parser no longer notices them.
    """
    return (spark.read.schema(f"{RAW.ddl}, {CORRUPT} string").option("header", header)
            .option("emptyValue", "").option("escape", '"').option("columnPruning", False)
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def type_raw(raw: DataFrame) -> DataFrame:
    """Typed rows plus ``reject``: why a row cannot be loaded, null if it can.

    Bad numbers become 0 and empty labels unknown. Rows with the wrong number of fields, without
    a readable time, with an id beyond LONG or a price beyond its type are refused: any
    value put in their place would be counted as a real one.
    """
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    typed = raw.select(
        broken.alias("broken"),
        tx.best_effort_time(F.col("event_time")).alias("event_time"),
        F.coalesce("event_type", F.lit("")).alias("event_type"),
        tx.unsigned_or_zero(F.col("product_id"), 32).alias("product_id"),
        tx.unsigned_or_zero(F.col("category_id"), 64).alias("category_id"),
        _or_unknown("category_code"), _or_unknown("brand"),
        tx.price_or_zero(F.col("price")).alias("price"),
        tx.unsigned_or_zero(F.col("user_id"), 32).alias("user_id"),
        F.coalesce("user_session", F.lit("")).alias("session_id"),
    )
    return typed.withColumn(
        "reject", F.when(F.col("broken"), "fields")
        .when(F.col("event_time").isNull(), "time")
        .when(F.col("category_id").isNull(), "id")
        .when(F.col("price").isNull(), "price")).drop("broken")


def _or_unknown(name: str) -> Column:
    return F.when(F.coalesce(F.col(name), F.lit("")) == "", "unknown") \
        .otherwise(F.col(name)).alias(name)


def bulk_load_rejects(raw: DataFrame) -> DataFrame:
    """(reason, rows) of what ``bulk_load`` leaves out."""
    return (type_raw(raw).filter("reject IS NOT NULL").groupBy(F.col("reject").alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def bulk_load(raw: DataFrame, max_unreadable: int | None = None) -> DataFrame:
    """History into the detail table's columns, without the rows that are refused.

    ``max_unreadable`` is the error budget over all reasons: it counts them first (one extra
    pass) and refuses the load beyond it.
    """
    typed = type_raw(raw)
    if max_unreadable is not None:
        bad = {r.reason: r.rows for r in bulk_load_rejects(raw).collect()}
        if sum(bad.values()) > max_unreadable:
            raise ValueError(f"{sum(bad.values())} rows refused, {max_unreadable} allowed: {bad}")
    rows = typed.filter("reject IS NULL").withColumn("event_date", F.to_date("event_time"))
    return DETAIL.conform(rows)


def write_detail(events: DataFrame, path: str, mode: str = "overwrite",
                 files: int | None = None) -> None:
    """Day folders, files sorted by category and product.

    Rows are rebalanced by day: the input is read once, small days share a task and a hot day is
    split by size. With ``files`` the rows are range-partitioned over the whole sort key instead
    (plus the input partition number, so that one product may fill several files); every file
    then covers a narrow range that min/max statistics can skip, at the price of reading the
    input once more for the range boundaries.
    """
    order = ["event_date", "category_id", "product_id"]
    rows = DETAIL.conform(events)
    # A read of few products skips row groups by their bloom filters, and small pages by their
    # smallest and largest category and product.
    skips = {"parquet.page.row.count.limit": str(PAGE_ROWS),
             "parquet.bloom.filter.enabled#product_id": "true",
             "parquet.bloom.filter.expected.ndv#product_id": str(BLOOM_PRODUCTS)}
    if files:
        rows = rows.withColumn("_tie", F.spark_partition_id())
        rows = rows.repartitionByRange(files, *order, "_tie").drop("_tie")
    else:
        rows = rows.hint("rebalance", "event_date")
    (rows.sortWithinPartitions(*order)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").options(**skips)
     .partitionBy("event_date").parquet(path))


def read_detail(spark: SparkSession, path: str) -> DataFrame:
    return DETAIL.conform(spark.read.schema(DETAIL.schema).parquet(path))


def read_pruned(events: DataFrame, start=None, end=None) -> DataFrame:
    """The four funnel columns of a date range; both reach the scan."""
    return filter_date_range(events, start, end).select(
        "event_date", "event_type", "user_id", "price")


def write_replace(rows: DataFrame, path: str, partition: str) -> None:
    """Write so that a rerun replaces the partitions it touches (whole tables: ``versions``).

    Partitions are rebalanced first, so files follow their size and not tasks times partitions.
    """
    (rows.hint("rebalance", partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def publish_slices(sliced: DataFrame, path: str) -> int:
    """Replay slices as text files that appear one after the other; returns how many.

    ``sliced`` holds ``value`` and ``slice`` as ``replay_slices`` makes them. All slices are written
    aside in parallel, where no reader looks, and then renamed into ``path`` in their order, each with
    a later modification time than the one before. A file stream takes files by that time, so one
    that reads a file a batch meets no row behind its watermark. Stores that set the time themselves
    keep the order as well, since renames follow one another.
    """
    spark, path = sliced.sparkSession, path.rstrip("/")
    aside = f"{path}/_aside-{uuid.uuid4().hex}"
    sliced.select("value", "slice").write.partitionBy("slice").text(aside)
    system, root = file_system(spark, path)
    now = max([int(time.time() * 1000)] + [
        s.getModificationTime() + 1 for s in system.listStatus(root) if not s.isDirectory()])
    number = lambda name: int(name.partition("=")[2])
    folders = sorted((s.getPath() for s in system.listStatus(file_system(spark, aside)[1])
                      if s.getPath().getName().startswith("slice=")),
                     key=lambda p: number(p.getName()))
    count = 0
    for folder in folders:
        for part in sorted(s.getPath().toString() for s in system.listStatus(folder)):
            target = f"{path}/{now}-{count:06d}.txt"
            _rename(spark, part, target)
            system.setTimes(file_system(spark, target)[1], now + count, -1)
            count += 1
    delete_path(spark, aside)
    return count


def _rename(spark: SparkSession, source: str, target: str) -> None:
    system, old = file_system(spark, source)
    if not system.rename(old, file_system(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


# --- tables written by streams -------------------------------------------------------------

def append_version(rows: DataFrame, path: str, batch: int, generation: int = 0,
                   compacted: int = 0) -> None:
    """Write one batch into its own folders under every day it touches.

    The same batch written again replaces itself. An empty batch writes nothing.
    """
    _write_versions(rows.withColumns({
        DAY: F.to_date("window_start"), GENERATION: F.lit(generation).cast("int"),
        BATCH: F.lit(batch).cast("bigint"), PASS: F.lit(compacted).cast("int")}), path)


def _write_versions(rows: DataFrame, path: str) -> None:
    (rows.hint("rebalance", DAY).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(path))


def _stored(spark: SparkSession, path: str, table: Table,
            days: list[str] | None = None) -> DataFrame:
    """What is stored; with ``days`` other day folders are not even listed."""
    reader = spark.read.schema(f"{table.ddl}, {LAYOUT_DDL}")
    if days is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(*[f"{path}/{DAY}={day}" for day in days])


def read_latest(spark: SparkSession, path: str, table: Table, start=None, end=None) -> DataFrame:
    """The last written row per key, of the days from ``start`` to ``end`` (both optional)."""
    rows = _stored(spark, path, table)
    if start is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.filter(F.col(DAY) <= F.lit(end).cast("date"))
    return table.conform(latest_by_key(rows, table.key, VERSION))


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """Days that have a folder, newest first. Only the top level is listed."""
    system, target = file_system(spark, path)
    names = [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []
    return sorted((n.partition("=")[2] for n in names if n.startswith(f"{DAY}=")), reverse=True)


def read_newest(spark: SparkSession, path: str, table: Table, rows: int) -> DataFrame:
    """The last written row per key of the newest days, as many as hold ``rows`` rows for sure.

    Day folders are walked from the newest backwards, one, then two, then four at a time. What was
    walked is counted after replaced versions are gone, so that a day rewritten many times does not
    pass for a full one. The newest rows of the table are all in what is returned, because a row
    lies in the folder of its own day; older days are neither read nor listed below their name.
    """
    days = stored_days(spark, path.rstrip("/"))
    taken, step, found = 0, 1, 0
    while taken < len(days) and found < rows:
        part = days[taken:taken + step]
        found += latest_by_key(_stored(spark, path, table, part), table.key, VERSION).count()
        taken, step = taken + len(part), 2 * step
    if not taken:
        return spark.createDataFrame([], table.schema)
    return table.conform(latest_by_key(
        _stored(spark, path, table, days[:taken]), table.key, VERSION))


def _folders(spark: SparkSession, path: str) -> list[tuple[str, tuple[int, int, int], str]]:
    """(day, version, folder) of everything stored: folder names only, no data is read."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return []
    found = system.globStatus(file_system(
        spark, "/".join([path, *[f"{c}=*" for c in LAYOUT]]))[1])
    out = []
    for status in found:
        folder = status.getPath().toString()
        day, *version = [part.partition("=")[2] for part in folder.split("/")[-len(LAYOUT):]]
        out.append((day, tuple(map(int, version)), folder))
    return out


def next_generation(spark: SparkSession, path: str) -> int:
    """One above what the table holds."""
    return 1 + max((version[0] for _, version, _ in _folders(spark, path)), default=-1)


def compact(spark: SparkSession, path: str, table: Table, before: str) -> int:
    """Leave one row per key in every day before ``before``; returns the days rewritten.

    The merged rows carry the newest version of their day plus one pass, so readers that see
    both old and new rows still take the right ones. All days are merged by one job, which costs
    as much as their rows and not a job a day. Old folders go only after the new ones are complete.
    Meant for days the stream no longer writes to.
    """
    days: dict[str, list] = {}
    for day, version, folder in _folders(spark, path):
        if day < before:
            days.setdefault(day, []).append((version, folder))
    busy = {day: held for day, held in days.items() if len(held) > 1}
    if not busy:
        return 0
    newest = {day: max(version for version, _ in held) for day, held in busy.items()}
    merged = latest_by_key(_stored(spark, path, table, sorted(busy)), table.key, VERSION)
    marks = spark.createDataFrame(          # a row a day
        [(day, generation, batch, done + 1) for day, (generation, batch, done) in newest.items()],
        LAYOUT_DDL.replace(f"{DAY} date", f"{DAY} string")).withColumn(DAY, F.col(DAY).cast("date"))
    rows = table.conform(merged).withColumn(DAY, F.to_date("window_start"))
    _write_versions(rows.join(F.broadcast(marks), DAY), path)
    for held in busy.values():
        for _, folder in held:
            delete_path(spark, folder)
    return len(busy)
