"""Daily tables brought up to date from new days and a small kept state, not from the history.

Two states are kept. ``FIRST_SEEN`` only grows: a new day adds the users who stand in no earlier
part. ``USER_ACTIVITY`` holds a user's first day and a mask whose bit k says the user was active k days
later, so a new day is one bit. Merging masks is commutative and repeatable: days may come in any
order and more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import rate
from ..schema import ACTIVE_USER_DAILY, FIRST_SEEN, RETENTION_DAILY, USER_ACTIVITY
from .retention import MAX_OFFSET, cohort_assign, user_days
from .rollups import active_counts

MASK_BITS = 62      # days a mask reaches; the sign bit and the one below stay free


def newly_seen(events: DataFrame, known: DataFrame) -> DataFrame:
    """(user_id, first_day) of the users of new days who are not in the ``known`` part of the table.

    ``known`` must end before the first new day, also when a day is run again.
    """
    first = events.groupBy("user_id").agg(F.min("event_date").alias("first_day"))
    return FIRST_SEEN.conform(first.join(known.select("user_id"), "user_id", "left_anti"))


def active_user_increment(events: DataFrame, fresh: DataFrame) -> DataFrame:
    """The active-user rows of new days, given their newly seen users.

    The join is of one row a day on either side.
    """
    new = fresh.groupBy(F.col("first_day").alias("event_date")) \
        .agg(F.count(F.lit(1)).alias("new_user"))
    days = active_counts(events).join(new, "event_date", "left")
    return ACTIVE_USER_DAILY.conform(days.fillna(0, ["new_user"]))


def _shifted(mask: Column, days: Column) -> Column:
    """Bits moved up by a number of days; what leaves the mask is beyond any offset it is asked for."""
    inside = F.call_function("shiftleft", mask, days).bitwiseAND(F.lit((1 << MASK_BITS) - 1))
    return F.when(mask.isNull() | (days >= MASK_BITS), F.lit(0).cast("bigint")).otherwise(inside)


def activity_masks(events: DataFrame) -> DataFrame:
    """First day and mask per user over the given days alone."""
    days = cohort_assign(user_days(events))
    one = _shifted(F.lit(1).cast("bigint"), F.datediff("event_date", "cohort_date"))
    return USER_ACTIVITY.conform(days.groupBy("user_id").agg(
        F.min("cohort_date").alias("cohort_date"), F.bit_or(one).alias("mask")))


def merge_masks(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Both states in one: the earlier first day, and both masks counted from it."""
    old, add = kept.alias("old"), new.alias("add")
    first = F.least("old.cohort_date", "add.cohort_date")
    mask = _shifted(F.col("old.mask"), F.datediff("old.cohort_date", first)) \
        .bitwiseOR(_shifted(F.col("add.mask"), F.datediff("add.cohort_date", first)))
    both = old.join(add, F.col("old.user_id") == F.col("add.user_id"), "full_outer")
    return USER_ACTIVITY.conform(both.select(
        F.coalesce("old.user_id", "add.user_id").alias("user_id"), first.alias("cohort_date"),
        mask.alias("mask")))


def retention_from_masks(masks: DataFrame, max_offset: int = MAX_OFFSET) -> DataFrame:
    """Cohort x day offset from the masks: one count per bit, one row per cohort in the shuffle."""
    if max_offset >= MASK_BITS:
        raise ValueError(f"masks reach {MASK_BITS - 1} days, not {max_offset}")

    def active(k: int) -> Column:
        return F.count_if(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0)

    cohorts = masks.groupBy("cohort_date").agg(
        F.array(*[active(k) for k in range(max_offset + 1)]).alias("active"))
    cells = cohorts.select(
        "cohort_date", F.col("active")[0].alias("cohort_users"),
        F.posexplode("active").alias("day_offset", "retained_users"))
    return RETENTION_DAILY.conform(cells.filter("retained_users > 0").withColumn(
        "retention_rate", rate(F.col("retained_users"), F.col("cohort_users"))))
