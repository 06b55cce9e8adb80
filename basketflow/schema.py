"""Column contracts and replace keys of every table the engine reads or writes.

Counts are LONG because Spark has no unsigned types; category ids reach 2.18e18 and
must stay LONG end to end (a double would lose digits).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIEW, CART, PURCHASE = "view", "cart", "purchase"
EVENT_TYPES = (VIEW, CART, PURCHASE)
UNKNOWN = "unknown"

PRICE_TYPE = "decimal(10,2)"
GMV_TYPE = "decimal(18,2)"

VERSION_COL = "_version"


@dataclass(frozen=True)
class Table:
    """A declared table: its columns in order and the key that a rewrite replaces."""

    name: str
    ddl: str
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def conform(self, df: DataFrame) -> DataFrame:
        """Project ``df`` to this table's column order and types."""
        return df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])


RAW = Table(
    "raw",
    "event_time string, event_type string, product_id string, category_id string, "
    "category_code string, brand string, price string, user_id string, user_session string",
)

DETAIL = Table(
    "dwd_user_behavior",
    "event_time timestamp, event_type string, product_id bigint, category_id bigint, "
    f"category_code string, brand string, price {PRICE_TYPE}, user_id bigint, "
    "session_id string, event_date date",
)

FUNNEL_DAILY = Table(
    "ads_funnel_daily",
    "event_date date, view_cnt bigint, cart_cnt bigint, purchase_cnt bigint, "
    f"view_uv bigint, cart_uv bigint, purchase_uv bigint, gmv {GMV_TYPE}, "
    "cart_rate double, buy_rate double",
    ("event_date",),
)

ITEM_STATS = Table(
    "ads_item_stats",
    "event_date date, product_id bigint, category_id bigint, brand string, "
    "view_cnt bigint, cart_cnt bigint, purchase_cnt bigint, view_uv bigint, "
    f"gmv {GMV_TYPE}, buy_rate double",
    ("event_date", "category_id", "product_id"),
)

CATEGORY_STATS = Table(
    "ads_category_stats",
    "event_date date, category_id bigint, category_code string, view_cnt bigint, "
    "cart_cnt bigint, purchase_cnt bigint, view_uv bigint, product_cnt bigint, "
    f"gmv {GMV_TYPE}, buy_rate double",
    ("event_date", "category_id"),
)

BRAND_STATS = Table(
    "ads_brand_stats",
    "event_date date, brand string, view_cnt bigint, cart_cnt bigint, purchase_cnt bigint, "
    "view_uv bigint, buyer_uv bigint, product_cnt bigint, "
    f"gmv {GMV_TYPE}, avg_price decimal(10,2), buy_rate double",
    ("event_date", "brand"),
)

ACTIVE_USER_DAILY = Table(
    "ads_active_user_daily",
    "event_date date, dau bigint, view_uv bigint, purchase_uv bigint, new_user bigint, "
    "session_cnt bigint",
    ("event_date",),
)

REALTIME_GLOBAL = Table(
    "ads_realtime_pv_uv",
    "window_start timestamp, window_end timestamp, pv bigint, uv bigint, "
    f"purchase_cnt bigint, gmv {GMV_TYPE}",
    ("window_start",),
)

REALTIME_CATEGORY = Table(
    "ads_realtime_category_stats",
    "window_start timestamp, window_end timestamp, category_id bigint, pv bigint, uv bigint, "
    f"purchase_cnt bigint, gmv {GMV_TYPE}",
    ("window_start", "category_id"),
)

REALTIME_BRAND = Table(
    "ads_realtime_brand_stats",
    "window_start timestamp, window_end timestamp, brand string, pv bigint, uv bigint, "
    f"purchase_cnt bigint, gmv {GMV_TYPE}",
    ("window_start", "brand"),
)

USER_PROFILE = Table(
    "ads_user_profile",
    f"user_id bigint, recency_days int, frequency bigint, monetary {GMV_TYPE}, "
    "r_score int, f_score int, m_score int, cluster_id int, segment string, "
    "computed_at timestamp",
    ("user_id",),
)

RETENTION_DAILY = Table(
    "ads_retention_daily",
    "cohort_date date, day_offset int, cohort_users int, retained_users int, "
    "retention_rate double",
    ("cohort_date", "day_offset"),
)

# Kept state of daily increments.
FIRST_SEEN = Table("ads_first_seen", "user_id bigint, first_day date", ("user_id",))

USER_ACTIVITY = Table(
    "ads_user_activity", "user_id bigint, cohort_date date, mask bigint", ("user_id",))

# Sketches of a day, merged over any range of days.
BRAND_SKETCHES = Table(
    "ads_brand_sketches",
    "event_date date, brand string, users binary, viewers binary, buyers binary, prices binary",
    ("event_date", "brand"),
)

DIM_USER = Table(
    "dim_user_synthetic",
    "user_id bigint, device string, os string, browser string, country string, "
    "province string, age_group string, gender string",
    ("user_id",),
)

TABLES = {
    t.name: t
    for t in (
        RAW, DETAIL, FUNNEL_DAILY, ITEM_STATS, CATEGORY_STATS, BRAND_STATS,
        ACTIVE_USER_DAILY, REALTIME_GLOBAL, REALTIME_CATEGORY, REALTIME_BRAND,
        USER_PROFILE, RETENTION_DAILY, DIM_USER, FIRST_SEEN, USER_ACTIVITY, BRAND_SKETCHES,
    )
}
