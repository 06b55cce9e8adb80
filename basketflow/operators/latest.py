"""Latest-wins reads, top-n and rank positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import VERSION_COL


def latest_by_key(rows: DataFrame, key: list[str] | tuple[str, ...],
                  version: str | list[str] = VERSION_COL) -> DataFrame:
    """The last written row per key, never a per-column maximum.

    Written as a maximum over (version, remaining columns) so it combines map-side: a key that
    holds a third of all versions is reduced before the shuffle, where ranking rows in a window
    would bring all of them to one task. Equal versions are broken by the remaining columns.
    """
    versions = [version] if isinstance(version, str) else list(version)
    rest = [c for c in rows.columns if c not in key and c not in versions]
    newest = rows.groupBy(*key).agg(F.max(F.struct(*versions, *rest)).alias("newest"))
    return newest.select(*[F.col(c) if c in key else F.col("newest")[c].alias(c)
                           for c in rows.columns])


def order_limit(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Top n; each task keeps n rows, so only n per task travel."""
    return rows.orderBy(*order).limit(n)


def rank_position(top: DataFrame, order: list[Column]) -> DataFrame:
    """1-based position. Only for frames already limited: the window is one partition."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
