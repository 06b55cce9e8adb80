"""Optional adapters to a message broker and a JDBC store.

They need connector jars and servers that the test environment lacks, so only the option
building is tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Earliest applies to a new query only; afterwards the checkpoint holds the offsets."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_lines(spark: SparkSession, servers: str, topic: str,
                max_offsets: int | None = None) -> DataFrame:
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets))
    return stream.load().select(F.col("value").cast("string").alias("value"))


def write_kafka(lines: DataFrame, servers: str, topic: str) -> None:
    """``lines`` holds key and value; the key (user id) keeps each user's events in order."""
    (lines.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def write_kafka_in_order(sliced: DataFrame, servers: str, topic: str, write=write_kafka) -> int:
    """Replay slices one after the other, so the topic holds nothing older behind a whole slice.

    The slices are laid down once; each is then sent by a job of its own. Within a slice the keys keep
    their users' order; a topic of one partition keeps the order of the slices altogether.
    """
    spark = sliced.sparkSession
    path = scratch_path(spark, "slices")
    sliced.select("key", "value", "slice").write.partitionBy("slice").parquet(path)
    stored = spark.read.schema("key string, value string, slice int").parquet(path)
    numbers = sorted(r[0] for r in stored.select("slice").distinct().collect())
    for number in numbers:
        write(stored.filter(F.col("slice") == number), servers, topic)
    return len(numbers)


def jdbc_options(url: str, query: str, partition_column: str, lower, upper,
                 partitions: int) -> dict[str, str]:
    """A parallel read. The query goes in as a derived table because Spark's ``query`` option
    cannot be combined with a partition column."""
    return {
        "url": url,
        "dbtable": f"({query}) AS src",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str, lower, upper,
              partitions: int, **extra: str) -> DataFrame:
    options = jdbc_options(url, query, partition_column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options, **extra).load()


def append_jdbc(rows: DataFrame, url: str, table: str, **extra: str) -> None:
    """Append to a store that replaces by key itself."""
    (rows.write.format("jdbc").option("url", url).option("dbtable", table)
     .options(**extra).mode("append").save())
