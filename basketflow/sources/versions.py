"""Result tables that are replaced as a whole or by key, without a moment in which they are missing.

A table is a folder of numbered versions. A version counts once its ``_SUCCESS`` file is there, which
Spark writes last; until then readers keep to the version before, and a failed job leaves the table
as it was. Readers that have started keep their files: the newest ``KEPT`` versions stay.

A table by key is cut into buckets by a hash of its key. A change rewrites the buckets it touches
and no others; the newest version that has a bucket holds it.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import Table
from ..session import delete_path, file_system

VERSION, BUCKET = "_version", "_bucket"
KEPT = 2


def _listed(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Numbered folders ``name=<n>`` under a path."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return {}
    out = {}
    for status in system.listStatus(target):
        head, _, number = status.getPath().getName().partition("=")
        if head == name and number.isdigit():
            out[int(number)] = status.getPath().toString()
    return out


def _complete(spark: SparkSession, path: str) -> dict[int, str]:
    found = _listed(spark, path, VERSION)
    return {n: folder for n, folder in found.items()
            if file_system(spark, folder)[0].exists(file_system(spark, f"{folder}/_SUCCESS")[1])}


def _next(spark: SparkSession, path: str) -> str:
    """Above every number that was ever begun, so that a failed version is never written into."""
    number = 1 + max(_listed(spark, path, VERSION), default=0)
    return f"{path}/{VERSION}={number:06d}"


def replace_table(rows: DataFrame, path: str) -> None:
    """A new version of the whole table."""
    spark, path = rows.sparkSession, path.rstrip("/")
    rows.write.parquet(_next(spark, path))
    for number in sorted(_complete(spark, path))[:-KEPT]:
        delete_path(spark, _complete(spark, path)[number])


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The newest complete version; without one an empty table."""
    done = _complete(spark, path.rstrip("/"))
    if not done:
        return spark.createDataFrame([], table.schema)
    return table.conform(spark.read.schema(table.schema).parquet(done[max(done)]))


# --- tables by key -------------------------------------------------------------------------

def _bucket(table: Table, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*table.key), F.lit(buckets)).cast("int")


def _holders(spark: SparkSession, path: str) -> dict[int, str]:
    """For every bucket the folder of the newest complete version that has it."""
    held: dict[int, str] = {}
    for _, folder in sorted(_complete(spark, path).items()):
        held |= _listed(spark, folder, BUCKET)
    return held


def replace_keys(rows: DataFrame, path: str, table: Table, buckets: int = 64) -> list[int]:
    """Put ``rows`` (one per key) in the place of stored rows of the same keys; others stay.

    Only buckets with a new row are read and rewritten; their numbers are returned. ``buckets`` is
    fixed by the first call on a table: another number is refused, since keys would move.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    new = table.conform(rows).withColumn(BUCKET, _bucket(table, buckets))
    # At most one number per bucket comes to the driver.
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    mark = f"{path}/_buckets={buckets}"
    known = _listed(spark, path, "_buckets")
    if known and buckets not in known:
        raise ValueError(f"the table has {min(known)} buckets, not {buckets}")
    system, target = file_system(spark, mark)
    system.mkdirs(target)
    if not touched:
        return []
    old = _read(spark, [f for b, f in _holders(spark, path).items() if b in set(touched)], table)
    merged = new if old is None else new.unionByName(
        old.withColumn(BUCKET, _bucket(table, buckets))
        .join(new.select(*table.key), list(table.key), "left_anti"))
    merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(_next(spark, path))
    _drop_covered(spark, path)
    return touched


def _read(spark: SparkSession, folders: list[str], table: Table) -> DataFrame | None:
    return spark.read.schema(table.schema).parquet(*folders) if folders else None


def read_keys(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """Every bucket from the newest complete version that has it."""
    found = _read(spark, sorted(_holders(spark, path.rstrip("/")).values()), table)
    return spark.createDataFrame([], table.schema) if found is None else table.conform(found)


def _drop_covered(spark: SparkSession, path: str) -> None:
    """Of every bucket the newest ``KEPT`` versions stay."""
    versions: dict[int, list[str]] = defaultdict(list)
    for _, folder in sorted(_complete(spark, path).items()):
        for bucket, place in _listed(spark, folder, BUCKET).items():
            versions[bucket].append(place)
    for places in versions.values():
        for place in places[:-KEPT]:
            delete_path(spark, place)
