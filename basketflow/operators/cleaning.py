"""Raw lines to typed events."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schema import DETAIL, EVENT_TYPES

# Plausible event times, both ends accepted. Fixed values.
EARLIEST = datetime(2000, 1, 1, tzinfo=timezone.utc)
LATEST = datetime(2100, 1, 1, tzinfo=timezone.utc)


def clean_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse nine-field lines into detail rows and silently drop the ones that do not conform.

    Works on batch and streaming frames alike: only per-row expressions are used.
    """
    fields = tx.split_fields(tx.strip_blanks(F.col(column)))
    rows = lines.select(tx.once(fields).alias("f")).filter(F.size("f") == 9)
    field = [tx.strip_blanks(F.col("f")[i]) for i in range(9)]
    typed = rows.filter(field[1].isin(*EVENT_TYPES)).select(F.inline(F.array(F.struct(
        tx.parse_source_time(field[0]).alias("event_time"),
        field[1].alias("event_type"),
        tx.integer_or_null(field[2]).alias("product_id"),
        tx.integer_or_null(field[3]).alias("category_id"),
        tx.fill_unknown(field[4]).alias("category_code"),
        tx.fill_unknown(field[5]).alias("brand"),
        tx.price_or_null(field[6]).alias("price"),
        tx.integer_or_null(field[7]).alias("user_id"),
        field[8].alias("session_id"),
    ))))
    required = ("event_time", "product_id", "category_id", "price", "user_id")
    valid = F.col("event_time").between(F.lit(EARLIEST), F.lit(LATEST))
    for name in required[1:]:
        valid = valid & F.col(name).isNotNull()
    return DETAIL.conform(derive_event_date(typed.filter(valid)))


def derive_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("event_time"))


def fill_unknown(events: DataFrame) -> DataFrame:
    return events.withColumns({c: tx.fill_unknown(F.col(c)) for c in ("category_code", "brand")})


# Nine non-dropped fields; a date-like head of 19 or more characters; ids all digits; price
# made of digits with at most one dot. One pass of one pattern per line.
COARSE_PATTERN = (
    r"^(?=[^,]{19})\p{Nd}[^,]{3}-[^,]*,[^,]*,\p{Nd}+,\p{Nd}+,[^,]*,[^,]*,"
    r"(?=[^,])\p{Nd}*\.?\p{Nd}*,\p{Nd}+,[^,]+,*$"
)


def coarse_valid(lines: DataFrame, column: str = "value") -> DataFrame:
    """Cheap pre-filter before replay; looser on times and types, stricter on price signs."""
    return lines.filter(F.col(column).rlike(COARSE_PATTERN))


def filter_date_range(events: DataFrame, start=None, end=None) -> DataFrame:
    """Both ends inclusive and optional."""
    if start is not None:
        events = events.filter(F.col("event_date") >= F.lit(start).cast("date"))
    if end is not None:
        events = events.filter(F.col("event_date") <= F.lit(end).cast("date"))
    return events
