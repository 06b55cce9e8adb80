"""Counts and exact distinct users per dimensions, in two steps.

Both shapes below first aggregate per (dimensions, counted value) and then per dimensions. The
first step combines map-side, so a user, product or day holding a third of all rows reaches the
shuffle as one partial row per task.

``per_user`` + ``fold_users`` suit several user counts over the same users: one row per user
carries them all. ``type_counts`` with ``cond_distinct`` suits one user count: only the users
being counted travel, all other rows collapse per dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import cond_cents, cond_count, money
from ..schema import CART, PURCHASE, VIEW


def per_user(events: DataFrame, *dims: str | Column) -> DataFrame:
    return events.groupBy(*dims, "user_id").agg(
        cond_count(VIEW).alias("view_cnt"),
        cond_count(CART).alias("cart_cnt"),
        cond_count(PURCHASE).alias("purchase_cnt"),
        cond_cents(PURCHASE).alias("cents"),
    )


def fold_users(users: DataFrame, *dims: str | Column) -> DataFrame:
    """Counts, exact user counts and sales per dimensions.

    ``any_uv`` counts users with any behaviour, the others users with that behaviour.
    """
    return users.groupBy(*dims).agg(
        F.sum("view_cnt").alias("view_cnt"),
        F.sum("cart_cnt").alias("cart_cnt"),
        F.sum("purchase_cnt").alias("purchase_cnt"),
        F.count(F.lit(1)).alias("any_uv"),
        F.count_if(F.col("view_cnt") > 0).alias("view_uv"),
        F.count_if(F.col("cart_cnt") > 0).alias("cart_uv"),
        F.count_if(F.col("purchase_cnt") > 0).alias("purchase_uv"),
        money(F.sum("cents")).alias("gmv"),
    )


def type_counts() -> list[Column]:
    """Counts per event type and sales in cents."""
    return [
        cond_count(VIEW).alias("view_cnt"),
        cond_count(CART).alias("cart_cnt"),
        cond_count(PURCHASE).alias("purchase_cnt"),
        money(cond_cents(PURCHASE)).alias("gmv"),
    ]


def distinct_count(rows: DataFrame, dims: list[str], column: str, name: str) -> DataFrame:
    """Exact distinct of one column per dimensions, as a distinct followed by a count."""
    return (rows.select(*dims, column).distinct()
            .groupBy(*dims).agg(F.count(column).alias(name)))


def user_uv_by_dim(events: DataFrame, *dims: str) -> DataFrame:
    """Distinct users of any behaviour over the whole range; window counts would not add up."""
    return distinct_count(events, list(dims), "user_id", "uv")
