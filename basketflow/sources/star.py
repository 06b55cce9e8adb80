"""Behaviour events derived from the star-schema tables, for tests, checks and benches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DETAIL, PRICE_TYPE, UNKNOWN

CATEGORY_BASE = 2053013555631882655


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product attributes. Whether this side is broadcast is left to Spark's size threshold."""
    key = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        key.alias("product_id"),
        (F.lit(CATEGORY_BASE) + F.col("p_size")).cast("bigint").alias("category_id"),
        F.col("p_type").alias("category_code"),
        F.when(key % 7 == 0, UNKNOWN).otherwise(F.col("p_brand")).alias("brand"))


def _session_id(user: Column, date: Column) -> Column:
    return F.concat_ws("-", user.cast("string"), date.cast("string"))


def _event_type(source: Column) -> Column:
    return F.when(source == "click", "cart").otherwise(source)


def shape_events(raw: DataFrame, products: DataFrame) -> DataFrame:
    """``events`` rows (batch or stream) as detail rows; other event types are filtered out."""
    kept = raw.filter(F.col("event_type").isin("view", "click", "purchase")).select(
        F.col("ts").cast("timestamp").alias("event_time"),
        _event_type(F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.col("value").cast(PRICE_TYPE).alias("price"),
        "user_id",
        F.to_date("ts").alias("event_date"))
    joined = kept.join(products, "product_id")
    return DETAIL.conform(joined.withColumn(
        "session_id", _session_id(F.col("user_id"), F.col("event_date"))))


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(_table(spark, sf_dir, "events"), _product(spark, sf_dir))


def behavior_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events read as a file stream, joined to the static products."""
    path = f"{sf_dir}/events.parquet"
    # The pattern lets a stream read a single file as well as a folder of files.
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")
    return shape_events(stream, _product(spark, sf_dir))


def behavior_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as events: more rows, users, products and days than ``behavior``."""
    items = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_returnflag") == "N", "view").when(F.col("l_returnflag") == "A", "cart")
        .otherwise("purchase").alias("event_type"),
        F.col("l_extendedprice").cast(PRICE_TYPE).alias("price"))
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.to_date("o_orderdate").alias("event_date"))
    joined = items.join(orders, "l_orderkey").join(_product(spark, sf_dir), "product_id")
    return DETAIL.conform(joined.withColumn(
        "session_id", _session_id(F.col("user_id"), F.col("event_date"))))


def raw_columns(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    """Every event as nine text columns, dirt included: error events lose their numbers, known
    gaps in the brand are empty, sign-ups carry a type the cleaner refuses."""
    kept = ["event_id"] if keep_id else []
    events = _table(spark, sf_dir, "events").select(
        *kept, F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id",
        F.col("value").cast(PRICE_TYPE).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"))
    broken = F.col("event_type") == "error"
    date = F.to_date("ts")
    return events.join(_product(spark, sf_dir), "product_id").select(
        *kept, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        _event_type(F.col("event_type")).alias("event_type"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("category_id").cast("string").alias("category_id"),
        "category_code",
        F.when(F.col("brand") == UNKNOWN, "").otherwise(F.col("brand")).alias("brand"),
        F.when(broken, "").otherwise(F.col("price").cast("string")).alias("price"),
        F.when(broken, "n/a").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        _session_id(F.col("user_id"), date).alias("user_session"))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with more dirt by event id: lines cut short, lines with fields too many, times
    that do not parse, ids and prices beyond their types, quoted brands."""
    columns = raw_columns(spark, sf_dir, keep_id=True)
    kind = F.col("event_id") % 97
    changed = columns.withColumns({
        "event_time": F.when(kind == 3, "no time").otherwise(F.col("event_time")),
        "category_id": F.when(kind == 4, "18446744073709551615").otherwise(F.col("category_id")),
        "price": F.when(kind == 5, "123456789.50").otherwise(F.col("price")),
        "brand": F.when(kind == 6, F.lit('"the ""best"", they say"')).otherwise(F.col("brand")),
    })
    fields = [c for c in columns.columns if c != "event_id"]
    line = F.concat_ws(",", *fields)
    line = F.when(kind == 1, F.substring_index(line, ",", 3)) \
        .when(kind == 2, F.concat(line, F.lit(",x,y"))).otherwise(line)
    return changed.select(line.alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = raw_columns(spark, sf_dir)
    return columns.select(F.concat_ws(",", *columns.columns).alias("value"))
