"""Tumbling event-time metrics, one definition for batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import approx_uv, cond_cents, cond_count, is_type, money
from ..schema import PURCHASE, VIEW

GLOBAL_WIDTH = "1 second"
DIMENSION_WIDTH = "60 seconds"


def window_metrics(events: DataFrame, width: str, *keys: str, exact_uv: bool = True) -> DataFrame:
    """Views, distinct viewers, purchases and sales per window and key.

    Windows without a view or a purchase are left out; a cart alone does not make a row.
    A streaming frame must carry its watermark already.
    """
    if not events.isStreaming:
        # Streams keep cart events: they still move the watermark.
        events = events.filter(F.col("event_type").isin(VIEW, PURCHASE))
    window = F.window("event_time", width)
    viewer = F.when(is_type(VIEW), F.col("user_id"))
    measures = [cond_count(VIEW).alias("pv"), cond_count(PURCHASE).alias("purchase_cnt"),
                cond_cents(PURCHASE).alias("cents")]
    if exact_uv:
        # One row per viewer and one for everything else: this is also the stream's state.
        viewers = events.groupBy(window.alias("w"), *keys, viewer.alias("viewer")).agg(*measures)
        outer = F.window(F.window_time("w"), width) if events.isStreaming else F.col("w")
        stats = viewers.groupBy(outer.alias("w"), *keys).agg(
            F.sum("pv").alias("pv"),
            F.count("viewer").alias("uv"),
            F.sum("purchase_cnt").alias("purchase_cnt"),
            F.sum("cents").alias("cents"))
    else:
        stats = events.groupBy(window.alias("w"), *keys).agg(
            *measures, approx_uv(viewer).alias("uv"))
    filled = stats.filter((F.col("pv") > 0) | (F.col("purchase_cnt") > 0))
    return filled.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *keys, "pv", "uv", "purchase_cnt", money(F.col("cents")).alias("gmv"))


def global_windows(events: DataFrame, width: str = GLOBAL_WIDTH, **options) -> DataFrame:
    return window_metrics(events, width, **options)


def category_windows(events: DataFrame, width: str = DIMENSION_WIDTH, **options) -> DataFrame:
    return window_metrics(events, width, "category_id", **options)


def brand_windows(events: DataFrame, width: str = DIMENSION_WIDTH, **options) -> DataFrame:
    return window_metrics(events, width, "brand", **options)
