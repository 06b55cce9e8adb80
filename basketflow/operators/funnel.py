"""Daily conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import rate
from ..schema import FUNNEL_DAILY
from .grain import fold_users, per_user


def funnel_daily(events: DataFrame) -> DataFrame:
    """Event-level view / cart / purchase counts, users and rates per day."""
    daily = fold_users(per_user(events, "event_date"), "event_date")
    views = F.col("view_cnt")
    return FUNNEL_DAILY.conform(daily.withColumns({
        "cart_rate": rate(F.col("cart_cnt"), views),
        "buy_rate": rate(F.col("purchase_cnt"), views),
    }))


def funnel_stages(funnel: DataFrame) -> DataFrame:
    """The newest day as three stage rows.

    ``ratio`` is against views; ``loss_pct`` is what is missing by the next stage, null on the last.
    """
    views = F.col("view_cnt")
    latest = funnel.orderBy(F.col("event_date").desc()).limit(1)
    share = {name: F.when(views == 0, F.lit(0.0)).otherwise(F.col(name) / views)
             for name in ("cart_cnt", "purchase_cnt")}

    def stage(position, name, count, ratio, next_ratio):
        loss = F.lit(None).cast("double") if next_ratio is None \
            else F.round(100 - next_ratio * 100, 1)
        return F.struct(
            F.lit(position).alias("position"), F.lit(name).alias("stage"),
            F.col(count).alias("event_cnt"), F.round(ratio, 6).alias("ratio"),
            loss.alias("loss_pct"))

    stages = F.array(
        stage(1, "view", "view_cnt", F.lit(1.0), share["cart_cnt"]),
        stage(2, "cart", "cart_cnt", share["cart_cnt"], share["purchase_cnt"]),
        stage(3, "purchase", "purchase_cnt", share["purchase_cnt"], None),
    )
    return latest.select("event_date", F.inline(stages))
