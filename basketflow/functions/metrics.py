"""Conditional counts, sums and rates over behaviour events."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import GMV_TYPE


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def cond_count(event_type: str) -> Column:
    return F.count_if(is_type(event_type))


def cond_distinct(event_type: str, column: str = "user_id") -> Column:
    """Exact distinct of ``column`` over events of one type."""
    return F.count_distinct(F.when(is_type(event_type), F.col(column)))


def cents(amount: str = "price") -> Column:
    """A two-digit amount as whole cents.

    Sums of LONG stay in generated arithmetic; sums of decimals this wide build an object per
    row and cost about as much as the rest of a daily aggregate together.
    """
    return (F.col(amount) * 100).cast("bigint")


def cond_cents(event_type: str, amount: str = "price") -> Column:
    """Sum in cents over events of one type; 0, not null, when there are none."""
    total = F.sum(F.when(is_type(event_type), cents(amount)).otherwise(F.lit(0).cast("bigint")))
    return F.coalesce(total, F.lit(0).cast("bigint"))


def money(total_cents: Column) -> Column:
    """Cents back to an exact decimal amount."""
    return (total_cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(GMV_TYPE)


def cond_sum(event_type: str, amount: str = "price") -> Column:
    return money(cond_cents(event_type, amount))


def approx_uv(user: str | Column = "user_id", lg_k: int = 14) -> Column:
    """Approximate distinct users, standard error 1.04 / sqrt(2^14) = 0.8 %.

    The sketch stays a short list while a group is small, so millions of small groups cost
    bytes each where a dense register array would cost about 13 KB each.
    """
    return F.hll_sketch_estimate(F.hll_sketch_agg(user, F.lit(lg_k)))


def as_gmv(amount: Column) -> Column:
    return amount.cast(GMV_TYPE)


def rate(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Ratio rounded to ``digits``; null where the denominator is 0."""
    return F.when(denominator > 0, F.round(numerator / denominator, digits))


def avg_order_value(gmv: str = "gmv", purchases: str = "purchase_cnt") -> Column:
    """gmv per purchase; 0 when nothing was bought."""
    count = F.col(purchases)
    return F.when(count == 0, F.lit(0.0)).otherwise(F.col(gmv).cast("double") / count)
