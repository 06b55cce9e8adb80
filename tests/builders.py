"""Small inline event frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from basketflow.schema import DETAIL

UTC = dt.timezone.utc


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def row(time: str, kind="view", user=1, product=1, price="1.00", category=10, brand="b",
        code="c", session=None):
    when = at(time)
    return (when, kind, product, category, code, brand, Decimal(price), user,
            session or f"{user}-{when.date()}", when.date())


def events(spark, rows):
    return spark.createDataFrame(rows, DETAIL.schema)
