"""The queries dashboards ask, as DataFrames over result tables.

Inputs hold one row per replace key: read versioned tables with ``read_latest`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import approx_uv, as_gmv, avg_order_value, cond_count, cond_sum
from ..operators.latest import order_limit, rank_position
from ..operators.retention import MAX_OFFSET, retention_curve
from ..operators.rfm import HIGH_VALUE, segment_summary, segment_totals
from ..operators.rollups import any_brand
from ..schema import PURCHASE, UNKNOWN, VIEW

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TREND_WINDOWS = 60


def _newest(stats: DataFrame, limit: int, *keys: str) -> DataFrame:
    order = [F.col("window_start").desc()]
    if keys:
        order += [F.col("gmv").desc(), *[F.col(k) for k in keys]]
    top = order_limit(stats, order, limit)
    return top.select(
        F.date_format("window_start", TIME_FORMAT).alias("window_start"),
        *keys, "pv", "uv", "purchase_cnt", as_gmv(F.col("gmv")).alias("gmv"))


def overview(stats: DataFrame, limit: int = 30) -> DataFrame:
    return _newest(stats, limit)


def category_stats(stats: DataFrame, limit: int = 20) -> DataFrame:
    return _newest(stats, limit, "category_id")


def brand_stats(stats: DataFrame, limit: int = 20) -> DataFrame:
    return _newest(stats, limit, "brand")


def _ranking(stats: DataFrame, key: str, limit: int) -> DataFrame:
    """Totals over windows. No user counts: they do not add across windows."""
    totals = stats.groupBy(key).agg(
        F.sum("pv").alias("pv"), F.sum("purchase_cnt").alias("purchase_cnt"),
        as_gmv(F.sum("gmv")).alias("gmv"))
    return order_limit(totals, [F.col("gmv").desc(), F.col(key)], limit)


def known_brand(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("brand") != UNKNOWN)


def brand_ranking(stats: DataFrame, limit: int = 10) -> DataFrame:
    return _ranking(known_brand(stats), "brand", limit)


def category_ranking(stats: DataFrame, limit: int = 10) -> DataFrame:
    return _ranking(stats, "category_id", limit)


def product_ranking(events: DataFrame, limit: int = 20, exact_uv: bool = True,
                    items: DataFrame | None = None) -> DataFrame:
    """Best sellers from detail; ``uv`` counts users of any behaviour.

    A limited side has a known number of rows, so Spark's own threshold decides on a broadcast.
    With ``items``, the daily item table over the same events, the winners come from its far
    fewer rows (daily counts and sales add up) and detail is read once.

    Only the winners' users are counted: sales are totalled per product first, then the few
    winners, carrying their totals, select the rows whose users matter. Pairs of product and
    user for the rest of the catalogue never reach a shuffle, and detail is read twice in all.
    """
    order = [F.col("gmv").desc(), F.col("product_id")]
    top = order_limit(_product_totals(events, items), order, limit)
    winners = events.select("product_id", "brand", "user_id").join(top, "product_id")
    measures = ["product_id", "pv", "purchase_cnt", "gmv"]
    if exact_uv:
        uv = F.count_distinct("user_id")
        winners = winners.select(*measures, "brand", "user_id").distinct()
    else:
        uv = approx_uv()
    described = winners.groupBy(*measures).agg(uv.alias("uv"), F.max("brand").alias("brand"))
    return described.select(
        "product_id", "brand", "pv", "purchase_cnt", "uv", "gmv").orderBy(*order)


def _product_totals(events: DataFrame, items: DataFrame | None, *more: Column) -> DataFrame:
    """Totals per product, from detail or from the daily item table."""
    if items is None:
        return events.groupBy("product_id").agg(
            cond_count(VIEW).alias("pv"), cond_count(PURCHASE).alias("purchase_cnt"),
            cond_sum(PURCHASE).alias("gmv"), *more)
    return items.groupBy("product_id").agg(
        F.sum("view_cnt").alias("pv"), F.sum("purchase_cnt").alias("purchase_cnt"),
        as_gmv(F.sum("gmv")).alias("gmv"), *more)


def product_ranking_seeking(events: DataFrame, limit: int = 20, exact_uv: bool = True,
                            items: DataFrame | None = None) -> DataFrame:
    """The same ranking, with the winners known before the second read is planned.

    The ``limit`` winners come to the driver and go into the second read as constants, each with the
    categories it stands in, as detail is written sorted by category and product. They reach the
    files as predicates, so page statistics skip pages, and blooms row groups, that hold no winner;
    a join would read every row to drop nearly all. Runs one job at once.
    """
    order = [F.col("gmv").desc(), F.col("product_id")]
    totals = _product_totals(events, items, F.min("category_id").alias("low"),
                             F.max("category_id").alias("high"))
    top = order_limit(totals, order, limit).collect()
    rows = events.sparkSession.createDataFrame(
        [tuple(r)[:4] for r in top],
        "product_id bigint, pv bigint, purchase_cnt bigint, gmv decimal(18,2)")
    found = events.filter(_winners(top)).select("product_id", "brand", "user_id")
    uv = F.count_distinct("user_id") if exact_uv else approx_uv()
    if exact_uv:
        found = found.distinct()
    described = found.groupBy("product_id").agg(uv.alias("uv"), F.max("brand").alias("brand"))
    return described.join(F.broadcast(rows), "product_id").select(
        "product_id", "brand", "pv", "purchase_cnt", "uv", "gmv").orderBy(*order)


def _winners(top: list) -> Column:
    """Rows of the given products. Equalities, because a long IN list is only pushed as a range."""
    wanted = F.lit(False)
    for r in top:
        of = F.col("product_id") == r.product_id
        if r.low is not None:
            # Rows without a category would fail the comparison, so they are asked for by name.
            of = of & (F.col("category_id").between(r.low, r.high) | F.col("category_id").isNull())
        wanted = wanted | of
    return wanted


def product_metrics(events: DataFrame) -> DataFrame:
    """The same measures for the whole catalogue."""
    stats = events.groupBy("product_id").agg(
        cond_count(VIEW).alias("pv"), cond_count(PURCHASE).alias("purchase_cnt"),
        F.count_distinct("user_id").alias("uv"), cond_sum(PURCHASE).alias("gmv"))
    return stats.join(any_brand(events), "product_id")


def ranking_table(ranking: DataFrame, key: str) -> DataFrame:
    """A ranking with its displayed position and average order value."""
    ordered = rank_position(ranking, [F.col("gmv").desc(), F.col(key)])
    return ordered.withColumn("avg_order_value", F.round(avg_order_value(), 2))


def funnel_report(funnel: DataFrame, limit: int = 30) -> DataFrame:
    newest = order_limit(funnel, [F.col("event_date").desc()], limit)
    return newest.select(
        F.col("event_date").cast("string").alias("event_date"),
        "view_cnt", "cart_cnt", "purchase_cnt", "view_uv", "purchase_uv",
        as_gmv(F.col("gmv")).alias("gmv"),
        F.round(F.col("cart_rate") * 100, 3).alias("cart_rate_pct"),
        F.round(F.col("buy_rate") * 100, 3).alias("buy_rate_pct"))


def retention(matrix: DataFrame, max_day: int = MAX_OFFSET) -> DataFrame:
    """The curve over the cells that exist, as dashboards show it. Days on which nobody of a
    cohort returned are absent from the matrix and so from the average, which lies too high for
    sparse cohorts; ``retention_curve`` over a densified matrix does not."""
    return retention_curve(matrix, max_day).orderBy("day_offset")


def user_segments(profiles: DataFrame) -> DataFrame:
    return segment_summary(profiles)


def user_segments_summary(profiles: DataFrame) -> DataFrame:
    return segment_totals(profiles)


def high_value_share(summary: DataFrame) -> DataFrame:
    """Share of users and of money held by the high-value segment, or by the first listed
    segment when there is none; 0 when the total is 0."""
    preferred = F.struct(
        F.when(F.col("segment") == HIGH_VALUE, 1).otherwise(0), "total_monetary")
    totals = summary.agg(
        F.max_by(F.struct("segment", "users", "total_monetary"), preferred).alias("best"),
        F.sum("users").alias("all_users"), F.sum("total_monetary").alias("all_monetary"))

    def share(part: str, whole: str):
        total = F.col(whole)
        ratio = F.col(f"best.{part}").cast("double") / total.cast("double")
        return F.when(total == 0, F.lit(0.0)).otherwise(F.round(ratio, 6))

    return totals.select(
        F.col("best.segment").alias("segment"),
        share("users", "all_users").alias("user_share"),
        share("total_monetary", "all_monetary").alias("monetary_share"))


def day1_retention(curve: DataFrame) -> DataFrame:
    """The point at offset 1, else the last point."""
    preferred = F.struct(F.when(F.col("day_offset") == 1, 1).otherwise(0), "day_offset")
    best = curve.agg(F.max_by(F.struct("day_offset", "retention_rate"), preferred).alias("best"))
    return best.select("best.day_offset", "best.retention_rate")


def latest_kpi(stats: DataFrame) -> DataFrame:
    return overview(stats, 1).select("window_start", "pv", "uv", "gmv")


def pv_trend(stats: DataFrame, windows: int = TREND_WINDOWS) -> DataFrame:
    """The newest windows, oldest first."""
    newest = overview(stats, windows)
    return newest.select("window_start", "pv").orderBy("window_start")
