"""Stable pseudo-random buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salted_bucket(value: Column, salt: str, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from md5(value, salt); a different salt gives an independent bucket."""
    digest = F.md5(F.concat_ws(":", value.cast("string"), F.lit(salt)))
    head = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return (head % buckets).cast("int")
