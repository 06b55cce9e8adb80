"""Stored sketches: distinct users and price quantiles of any range of days, without the detail.

A day's sketches are written once; a range merges them. User sets are theta sketches, which also
intersect, so "viewed and bought" needs no detail either. A sketch lists its hashes while a group is
small (and is then exact), and never holds more than 2^LG_NOMINAL of them, 128 KB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import cents, cond_cents, cond_count, is_type, money
from ..schema import BRAND_SKETCHES, PURCHASE, VIEW
from .cleaning import filter_date_range

LG_NOMINAL = 14     # relative standard error 1 / sqrt(2^14) = 0.8 %
LG_WINDOW = 14      # of a window's viewers, at most about 10 KB
RANKS = 800         # size of a quantile sketch; rank error about 0.6 % at 99 % confidence
PRICE_POINTS = (0.25, 0.5, 0.75, 0.95)


def _users(of: str | None = None) -> Column:
    user = F.col("user_id") if of is None else F.when(is_type(of), F.col("user_id"))
    return F.theta_sketch_agg(user, LG_NOMINAL)


def sketches_daily(events: DataFrame, *dims: str) -> DataFrame:
    """Per day and dimensions the sets of users, viewers and buyers, and the prices paid."""
    paid = F.when(is_type(PURCHASE), cents())
    return events.groupBy("event_date", *dims).agg(
        _users().alias("users"), _users(VIEW).alias("viewers"), _users(PURCHASE).alias("buyers"),
        F.kll_sketch_agg_bigint(paid, RANKS).alias("prices"))


def brand_sketches(events: DataFrame) -> DataFrame:
    return BRAND_SKETCHES.conform(sketches_daily(events, "brand"))


def uv_range(daily: DataFrame, *dims: str, start=None, end=None) -> DataFrame:
    """Distinct users, viewers, buyers and viewers who bought, over a range of stored days.

    Estimates are rounded to whole users. Days and dimensions that are left out merge the same way:
    ``uv_range(daily)`` is the total over all brands, in which a user counts once.
    """
    merged = filter_date_range(daily, start, end).groupBy(*dims).agg(
        *[F.theta_union_agg(c, LG_NOMINAL).alias(c) for c in ("users", "viewers", "buyers")])
    both = F.theta_intersection("viewers", "buyers")
    return merged.select(*dims, *[
        F.round(F.theta_sketch_estimate(sketch)).cast("bigint").alias(name)
        for name, sketch in (("uv", F.col("users")), ("view_uv", F.col("viewers")),
                             ("buyer_uv", F.col("buyers")), ("viewer_buyer_uv", both))])


def price_points(daily: DataFrame, *dims: str, start=None, end=None,
                 points: tuple[float, ...] = PRICE_POINTS) -> DataFrame:
    """Quantiles of the prices paid, over a range of stored days; null where nothing was bought."""
    merged = filter_date_range(daily, start, end).groupBy(*dims).agg(
        F.kll_merge_agg_bigint("prices", RANKS).alias("prices"))
    bought = F.kll_sketch_get_n_bigint("prices")
    return merged.select(*dims, bought.alias("purchases"), F.when(bought > 0, F.transform(
        F.array(*[F.kll_sketch_get_quantile_bigint("prices", F.lit(p)) for p in points]),
        money)).alias("prices"))


def window_sketches(events: DataFrame, width: str, *keys: str) -> DataFrame:
    """Window metrics that still add up: the viewers of each window are kept as a sketch."""
    seen = events.filter(F.col("event_type").isin(VIEW, PURCHASE))
    return seen.groupBy(F.window("event_time", width).alias("w"), *keys).agg(
        cond_count(VIEW).alias("pv"), cond_count(PURCHASE).alias("purchase_cnt"),
        cond_cents(PURCHASE).alias("cents"),
        F.hll_sketch_agg(F.when(is_type(VIEW), F.col("user_id")), F.lit(LG_WINDOW)).alias("viewers")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
             "pv", "purchase_cnt", "cents", "viewers")


def wider_windows(windows: DataFrame, width: str, *keys: str) -> DataFrame:
    """The same metrics over windows that hold whole stored ones; users are not counted twice."""
    return windows.groupBy(F.window("window_start", width).alias("w"), *keys).agg(
        F.sum("pv").alias("pv"),
        F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("uv"),
        F.sum("purchase_cnt").alias("purchase_cnt"), money(F.sum("cents")).alias("gmv")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
             "pv", "uv", "purchase_cnt", "gmv")
