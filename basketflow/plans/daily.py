"""Tables kept up to date day by day, under one folder.

| folder | how a new day enters |
|---|---|
| first_seen | a partition with the users seen in no earlier one |
| active_users, brand_sketches | the day's partition is replaced |
| users | attributes of newly seen users, replaced by key |
| activity | every user's mask merged with the day's, as a new version |
| retention | counted from the masks, as a new version |

Only the days given are read from detail. Days go in order: who is new on a day depends on the days
before it, so after an earlier day is run again, the later ones are too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import filter_date_range
from ..operators.dim_user import dim_user
from ..operators.increments import (
    active_user_increment, activity_masks, merge_masks, newly_seen, retention_from_masks,
)
from ..operators.sketches import brand_sketches
from ..schema import (
    ACTIVE_USER_DAILY, BRAND_SKETCHES, DIM_USER, FIRST_SEEN, RETENTION_DAILY, Table, USER_ACTIVITY,
)
from ..session import file_system
from ..sources.files import write_replace
from ..sources.versions import read_keys, read_table, replace_keys, replace_table


def read_partitions(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A table of day folders; empty before the first day."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return spark.createDataFrame([], table.schema)
    return table.conform(spark.read.schema(table.schema).parquet(path))


def update_active_users(days: DataFrame, out: str, start=None) -> None:
    """First-seen users and active-user rows of the given days, which begin at ``start``."""
    spark = days.sparkSession
    path = f"{out}/first_seen"
    known = read_partitions(spark, path, FIRST_SEEN)
    before = known.filter(F.lit(False) if start is None
                          else F.col("first_day") < F.lit(start).cast("date"))
    write_replace(newly_seen(days, before), path, "first_day")
    seen = read_partitions(spark, path, FIRST_SEEN)
    fresh = seen if start is None else seen.filter(F.col("first_day") >= F.lit(start).cast("date"))
    write_replace(active_user_increment(days, fresh), f"{out}/active_users", "event_date")
    replace_keys(dim_user(fresh), f"{out}/users", DIM_USER)


def update_retention(days: DataFrame, out: str) -> None:
    spark = days.sparkSession
    kept = read_table(spark, f"{out}/activity", USER_ACTIVITY)
    replace_table(merge_masks(kept, activity_masks(days)), f"{out}/activity")
    masks = read_table(spark, f"{out}/activity", USER_ACTIVITY)
    replace_table(retention_from_masks(masks), f"{out}/retention")


def update_sketches(days: DataFrame, out: str) -> None:
    write_replace(brand_sketches(days), f"{out}/brand_sketches", "event_date")


def update(detail: DataFrame, out: str, start=None, end=None) -> None:
    """Bring every table under ``out`` up to date with the days from ``start`` to ``end``."""
    days = filter_date_range(detail, start, end)
    update_active_users(days, out, start)
    update_retention(days, out)
    update_sketches(days, out)


def active_users(spark: SparkSession, out: str) -> DataFrame:
    return read_partitions(spark, f"{out}/active_users", ACTIVE_USER_DAILY)


def users(spark: SparkSession, out: str) -> DataFrame:
    return read_keys(spark, f"{out}/users", DIM_USER)


def retention(spark: SparkSession, out: str) -> DataFrame:
    return read_table(spark, f"{out}/retention", RETENTION_DAILY)


def sketches(spark: SparkSession, out: str) -> DataFrame:
    return read_partitions(spark, f"{out}/brand_sketches", BRAND_SKETCHES)
