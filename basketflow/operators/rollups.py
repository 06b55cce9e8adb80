"""Daily item, category, brand and active-user tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import cond_cents, cond_count, cond_distinct, is_type, money, rate
from ..schema import (
    ACTIVE_USER_DAILY, BRAND_STATS, CATEGORY_STATS, EVENT_TYPES, ITEM_STATS, PURCHASE, VIEW,
)


def carried_label(events: DataFrame, key: list[str], label: str) -> DataFrame:
    """One label per key, the largest when several occur.

    The distinct comes first because a hash aggregate can group by strings but not keep a
    running maximum of them; the maximum then sees a handful of rows per key.
    """
    return (events.select(*key, label).distinct()
            .groupBy(*key).agg(F.max(label).alias(label)))


def _sides(events: DataFrame, key: list[str], *marks: str) -> DataFrame:
    """Counts per (key, mark) for each mark alone, out of one read and one shuffle.

    ``is_<mark>`` says which side a row is of. Each side combines map-side by itself, so a row
    of the shuffle stands for a distinct user, product or label of a key and task, and the counts of
    a key are the sums over any one side.
    """
    counts = [cond_count(t).alias(f"{t}_cnt") for t in EVENT_TYPES]
    return events.groupingSets([[*key, m] for m in marks], *key, *marks).agg(
        *counts, cond_cents(PURCHASE).alias("cents"),
        *[(F.grouping(m) == 0).alias(f"is_{m}") for m in marks])


def _summed(side: str) -> list[Column]:
    """Sums over one side: every event is counted there once."""
    own = lambda c: F.sum(F.when(F.col(f"is_{side}"), F.col(c)))
    return [own(c).alias(c) for c in ("view_cnt", "cart_cnt", "purchase_cnt", "cents")]


def _distinct(mark: str, where: Column | None = None) -> Column:
    held = F.col(f"is_{mark}") & F.col(mark).isNotNull()
    return F.count_if(held if where is None else held & where)


def _labelled(rows: DataFrame, key: list[str], label: str, *measures: Column) -> DataFrame:
    """Measures per key with its largest label.

    Rows are first folded by hash per (key, label); the running maximum of strings, which only a
    sorted aggregate can keep, then sees one row per label of a key and one for all else.
    """
    folded = rows.groupBy(*key, label).agg(*measures)
    names = [c for c in folded.columns if c not in (*key, label)]
    return folded.groupBy(*key).agg(*[F.sum(c).alias(c) for c in names], F.max(label).alias(label))


def _viewers(events: DataFrame) -> DataFrame:
    return events.withColumn("viewer", F.when(is_type(VIEW), F.col("user_id")))


def item_stats_daily(events: DataFrame) -> DataFrame:
    """Items have about as many rows as events, so no event is doubled for a second side.

    The only distinct count goes by one row per viewer, which carries all other measures. Both of its
    steps group by columns that include the product, so behind a product join neither shuffles again.
    Who does not ask for viewers, as the ranking, is spared that step.
    """
    key = list(ITEM_STATS.key)
    stats = events.groupBy(*key).agg(
        *[cond_count(t).alias(f"{t}_cnt") for t in EVENT_TYPES],
        cond_cents(PURCHASE).alias("cents"), cond_distinct(VIEW).alias("view_uv"),
        F.max("brand").alias("brand"))
    return ITEM_STATS.conform(stats.withColumns({
        "gmv": money(F.col("cents")), "buy_rate": rate(F.col("purchase_cnt"), F.col("view_cnt"))}))


def category_stats_daily(events: DataFrame) -> DataFrame:
    key = list(CATEGORY_STATS.key)
    sides = _sides(_viewers(events), key, "category_code", "viewer", "product_id")
    stats = _labelled(
        sides, key, "category_code", *_summed("category_code"),
        _distinct("viewer").alias("view_uv"), _distinct("product_id").alias("product_cnt"))
    return CATEGORY_STATS.conform(stats.withColumns({
        "gmv": money(F.col("cents")), "buy_rate": rate(F.col("purchase_cnt"), F.col("view_cnt"))}))


def brand_stats_daily(events: DataFrame) -> DataFrame:
    key = list(BRAND_STATS.key)
    # Users who only filled carts are not counted, so their rows need no user of their own.
    counted = events.withColumn(
        "counted", F.when(F.col("event_type").isin(VIEW, PURCHASE), F.col("user_id")))
    stats = _sides(counted, key, "counted", "product_id").groupBy(*key).agg(
        *_summed("product_id"),
        _distinct("counted", F.col("view_cnt") > 0).alias("view_uv"),
        _distinct("counted", F.col("purchase_cnt") > 0).alias("buyer_uv"),
        _distinct("product_id").alias("product_cnt"))
    bought = F.col("purchase_cnt")
    return BRAND_STATS.conform(stats.withColumn("gmv", money(F.col("cents"))).withColumns({
        "avg_price": F.when(bought > 0, (F.col("gmv") / bought).cast("decimal(10,2)")),
        "buy_rate": rate(bought, F.col("view_cnt")),
    }))


def active_counts(events: DataFrame) -> DataFrame:
    """Active users, viewers, buyers and sessions per day, out of one read."""
    return _sides(events, ["event_date"], "user_id", "session_id").groupBy("event_date").agg(
        F.count_if(F.col("is_user_id")).alias("dau"),
        F.count_if(F.col("is_user_id") & (F.col("view_cnt") > 0)).alias("view_uv"),
        F.count_if(F.col("is_user_id") & (F.col("purchase_cnt") > 0)).alias("purchase_uv"),
        _distinct("session_id").alias("session_cnt"))


def active_user_daily(events: DataFrame) -> DataFrame:
    """Active users, viewers, buyers, first-seen users and sessions per day.

    Over the whole history first days come from the history too: a second read of two columns.
    Day by day, ``increments`` takes them from a kept table instead.
    """
    first = events.groupBy("user_id").agg(F.min("event_date").alias("event_date"))
    new = first.groupBy("event_date").agg(F.count(F.lit(1)).alias("new_user"))
    days = active_counts(events).join(new, "event_date", "left")
    return ACTIVE_USER_DAILY.conform(days.fillna(0, ["new_user"]))


def any_brand(events: DataFrame) -> DataFrame:
    return carried_label(events, ["product_id"], "brand")
