"""Cohort retention by first active day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import rate
from ..schema import RETENTION_DAILY

MAX_OFFSET = 30


def user_days(events: DataFrame) -> DataFrame:
    return events.select("user_id", F.col("event_date").cast("date").alias("event_date")).distinct()


def cohort_first_date(days: DataFrame) -> DataFrame:
    return days.groupBy("user_id").agg(F.min("event_date").alias("cohort_date"))


def cohort_assign(days: DataFrame) -> DataFrame:
    """Each user day with the user's first day.

    ``days`` must be distinct, so a window partition holds at most one row per calendar day.
    The window needs one exchange on user_id; joining the first dates back needs two.
    """
    first = F.min("event_date").over(Window.partitionBy("user_id"))
    return days.withColumn("cohort_date", first)


def cohort_assign_join(days: DataFrame) -> DataFrame:
    """The same rows by joining the first dates back; AQE splits or broadcasts as sizes demand."""
    return days.join(cohort_first_date(days), "user_id")


def cohort_sizes(days: DataFrame) -> DataFrame:
    return (cohort_first_date(days).groupBy("cohort_date")
            .agg(F.count(F.lit(1)).alias("cohort_users")))


def retained_cells(assigned: DataFrame, max_offset: int = MAX_OFFSET) -> DataFrame:
    offset = F.datediff("event_date", "cohort_date")
    return (assigned.select("cohort_date", offset.alias("day_offset"))
            .filter(F.col("day_offset") <= max_offset)
            .groupBy("cohort_date", "day_offset")
            .agg(F.count(F.lit(1)).alias("retained_users")))


def cohort_rate_join(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rates by joining cells to cohort sizes; sizes hold one row per calendar day."""
    joined = cells.join(sizes, "cohort_date")
    return RETENTION_DAILY.conform(joined.withColumn(
        "retention_rate", rate(F.col("retained_users"), F.col("cohort_users"))))


def retention_matrix(events: DataFrame, max_offset: int = MAX_OFFSET) -> DataFrame:
    """Cohort x day offset; cells nobody returned in are absent.

    A cohort's size is its own offset-0 cell, so the user days are read and shuffled once.
    """
    cells = retained_cells(cohort_assign(user_days(events)), max_offset)
    day_zero = F.max(F.when(F.col("day_offset") == 0, F.col("retained_users")))
    sized = cells.withColumn("cohort_users", day_zero.over(Window.partitionBy("cohort_date")))
    return RETENTION_DAILY.conform(sized.withColumn(
        "retention_rate", rate(F.col("retained_users"), F.col("cohort_users"))))


def densify(matrix: DataFrame, last_date, max_offset: int = MAX_OFFSET) -> DataFrame:
    """Add the zero cells of offsets that a cohort could have reached by ``last_date``.

    ``last_date`` is a column, literal or scalar subquery. The grid is generated per cohort
    (at most ``max_offset`` + 1 rows each), not by pairing tables.
    """
    reach = F.least(F.lit(max_offset), F.datediff(last_date, F.col("cohort_date")))
    grid = (matrix.filter(F.col("day_offset") == 0)
            .select("cohort_date", "cohort_users",
                    F.explode(F.sequence(F.lit(0), reach)).alias("day_offset")))
    cells = matrix.select("cohort_date", "day_offset", "retained_users", "retention_rate")
    filled = grid.join(cells, ["cohort_date", "day_offset"], "left").fillna(
        {"retained_users": 0, "retention_rate": 0.0})
    return RETENTION_DAILY.conform(filled)


def retention_curve(matrix: DataFrame, max_day: int = MAX_OFFSET) -> DataFrame:
    """Size-weighted average retention per day offset."""
    totals = matrix.filter(F.col("day_offset") <= max_day).groupBy("day_offset").agg(
        F.sum("retained_users").alias("retained_total"),
        F.sum("cohort_users").alias("cohort_total"))
    return totals.withColumn(
        "retention_rate", F.round(F.col("retained_total") / F.col("cohort_total"), 4))
