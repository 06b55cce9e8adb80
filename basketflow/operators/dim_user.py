"""Synthetic user attributes, stable per user. Display data only; not for business conclusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import salted_bucket
from ..schema import DIM_USER

# One salt per attribute, then cut points and labels.
SALTS = {
    "h_dev": "device",
    "h_os": "os",
    "h_br": "browser",
    "h_ctry": "country",
    "h_prov": "prov",
    "h_age": "age",
    "h_gen": "gender",
}
DEVICE_CUTS = ((35, "iOS"), (80, "Android"), (100, "Web"))
WEB_OS_CUTS = ((55, "Windows"), (100, "macOS"))
IOS_BROWSER_CUTS = ((70, "Safari"), (100, "Chrome"))
ANDROID_BROWSER_CUTS = ((82, "Chrome"), (100, "Firefox"))
WEB_BROWSER_CUTS = ((60, "Chrome"), (80, "Edge"), (92, "Firefox"), (100, "Safari"))
COUNTRY_CUTS = (
    (55, "中国"), (67, "美国"), (77, "印度"), (83, "德国"),
    (88, "英国"), (92, "巴西"), (96, "日本"), (100, "其他"),
)
PROVINCES = {
    "中国": ("广东", "浙江", "江苏", "山东", "河南", "四川", "北京", "上海", "湖北", "福建"),
    "美国": ("California", "Texas", "New York", "Florida", "Illinois"),
}
ELSEWHERE = "海外其他"
AGE_CUTS = ((22, "18-24"), (60, "25-34"), (85, "35-44"), (100, "45+"))
GENDER_CUTS = ((58, "女"), (100, "男"))


def pick(bucket: str, cuts: tuple[tuple[int, str], ...]) -> Column:
    """Label of the first cut point above the bucket."""
    *head, (_, last) = cuts
    choice = F.when(F.lit(False), F.lit(last))
    for below, label in head:
        choice = choice.when(F.col(bucket) < below, label)
    return choice.otherwise(last)


def salted_buckets(users: DataFrame) -> DataFrame:
    """Seven independent buckets 0..99 per user."""
    return users.select("user_id", *[
        salted_bucket(F.col("user_id"), salt).alias(name) for name, salt in SALTS.items()])


def dim_user(events: DataFrame) -> DataFrame:
    """One row of attributes per distinct user; device fixes the systems and browsers possible."""
    buckets = salted_buckets(events.select("user_id").distinct())
    base = buckets.withColumns({
        "device": pick("h_dev", DEVICE_CUTS), "country": pick("h_ctry", COUNTRY_CUTS)})
    device, country = F.col("device"), F.col("country")
    province = F.lit(ELSEWHERE)
    for name, places in PROVINCES.items():
        index = F.col("h_prov") % len(places) + 1
        listed = F.element_at(F.array(*[F.lit(p) for p in places]), index)
        province = F.when(country == name, listed).otherwise(province)
    return DIM_USER.conform(base.withColumns({
        "os": F.when(device == "Web", pick("h_os", WEB_OS_CUTS)).otherwise(device),
        "browser": F.when(device == "iOS", pick("h_br", IOS_BROWSER_CUTS))
                    .when(device == "Android", pick("h_br", ANDROID_BROWSER_CUTS))
                    .otherwise(pick("h_br", WEB_BROWSER_CUTS)),
        "province": province,
        "age_group": pick("h_age", AGE_CUTS),
        "gender": pick("h_gen", GENDER_CUTS),
    }))


def _clash() -> Column:
    device, system = F.col("device"), F.col("os")
    return F.when(device == "Web", ~system.isin("Windows", "macOS")).otherwise(system != device)


def contradictions(dim: DataFrame) -> DataFrame:
    """Users whose system does not fit the device; must be empty."""
    return dim.filter(_clash())


def dim_checks(dim: DataFrame) -> DataFrame:
    """Users per device and country, and the number of contradictory users, in one pass."""
    facts = F.array(
        F.struct(F.lit("device").alias("attribute"), F.col("device").alias("value")),
        F.struct(F.lit("country").alias("attribute"), F.col("country").alias("value")))
    return (dim.select(_clash().alias("clash"), F.inline(facts))
            .groupBy("attribute", "value")
            .agg(F.count(F.lit(1)).alias("users"),
                 F.count_if("clash").alias("contradictory_users")))
