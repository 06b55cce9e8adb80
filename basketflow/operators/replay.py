"""Preparing historical data for replay as a stream."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_source_time


def replay_anchor(started: datetime, elapsed: timedelta, time_scale: float = 1.0) -> datetime:
    """Where the newest event should land: the start plus the elapsed time at ``time_scale``."""
    return started + elapsed * time_scale


def _offset_micros(times: DataFrame, anchor: Column) -> Column:
    newest = times.agg(F.max("event_time").alias("t"))
    return newest.select(F.unix_micros(anchor.cast("timestamp")) - F.unix_micros("t")).scalar()


def shift_event_time(events: DataFrame, anchor: Column) -> DataFrame:
    """Move every event by one constant so the newest lands on ``anchor``."""
    offset = _offset_micros(events.select(F.col("event_time").cast("timestamp")), anchor)
    moved = F.timestamp_micros(F.unix_micros(F.col("event_time").cast("timestamp")) + offset)
    return events.withColumn("event_time", moved)


def shift_lines(lines: DataFrame, anchor: Column, column: str = "value") -> DataFrame:
    """The same on raw lines: only the first field changes, unreadable lines pass untouched."""
    line = F.col(column)
    head = F.substring_index(line, ",", 1)
    tail = F.substr(line, F.length(head) + 1)
    parsed = parse_source_time(head)
    time = F.when(line.contains(",") & (F.unix_micros(parsed) > 0), parsed)
    offset = _offset_micros(lines.select(time.alias("event_time")), anchor)
    moved = F.timestamp_micros(F.unix_micros(time) + offset)
    text = F.concat(F.date_format(moved, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"), tail)
    return lines.withColumn(column, F.coalesce(text, line))


def sort_replay(events: DataFrame, slices: int | None = None,
                time: str = "event_time") -> DataFrame:
    """Event-time order over the whole set: slices ascend and are sorted inside.

    The input partition number breaks ties in the range boundaries, so one instant (or copies
    of one row) holding a third of the data is spread over several slices. It is stable when a
    task is retried, unlike a random salt.
    """
    salted = events.withColumn("_tie", F.spark_partition_id())
    bounds = [F.col(time), F.col("_tie")]
    ranged = salted.repartitionByRange(slices, *bounds) if slices \
        else salted.repartitionByRange(*bounds)
    return ranged.sortWithinPartitions(*bounds).drop("_tie")


def replay_slices(events: DataFrame, slices: int, time: str = "event_time") -> DataFrame:
    """Sorted events with their slice number, ready to be written one folder per slice.

    The sort starts with the slice and comes last: a writer that wants rows by slice then finds
    them so and does not sort again, which would lose the time order once it spills.
    """
    salted = events.withColumn("_tie", F.spark_partition_id())
    ranged = salted.repartitionByRange(slices, F.col(time), F.col("_tie"))
    return (ranged.withColumn("slice", F.spark_partition_id())
            .sortWithinPartitions("slice", time, "_tie").drop("_tie"))


def to_lines(events: DataFrame) -> DataFrame:
    """Detail rows back to nine-field raw lines, keyed for an ordered partition per user."""
    line = F.concat_ws(
        ",",
        F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")),
        "event_type", F.col("product_id").cast("string"), F.col("category_id").cast("string"),
        "category_code", "brand", F.col("price").cast("string"),
        F.col("user_id").cast("string"), "session_id")
    return events.select("event_time", F.col("user_id").cast("string").alias("key"),
                         line.alias("value"))
