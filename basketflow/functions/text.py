"""Parsing of raw log lines with built-in string functions; nothing here raises on bad input."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PRICE_TYPE, UNKNOWN

SOURCE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Formats the bulk loader accepts, most common first. Fixed values.
BEST_EFFORT_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "yyyyMMddHHmmss",
)

# All characters up to and including the space count as blanks.
BLANKS = "".join(map(chr, range(33)))


def strip_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def once(value: Column) -> Column:
    """Compute ``value`` one time per row.

    A generator keeps the optimizer from copying the expression into every filter and column
    that uses it. Use it as a column of a select.
    """
    return F.explode(F.array(value))


def split_fields(line: Column) -> Column:
    """Comma fields with trailing empty ones removed (no quoting rules)."""
    return F.split(F.rtrim(line, F.lit(",")), ",", -1)


def parse_source_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with an optional `` UTC`` suffix; null when it does not parse."""
    whole = strip_blanks(text)
    bare = F.when(whole.endswith(" UTC"), F.left(whole, F.length(whole) - 4)).otherwise(whole)
    return F.try_to_timestamp(bare, F.lit(SOURCE_TIME_FORMAT))


def best_effort_time(text: Column) -> Column:
    """First accepted format wins; a bare 9 or 10 digit number is taken as epoch seconds."""
    bare = F.regexp_replace(strip_blanks(text), r" ?(UTC|GMT)$", "")
    epoch = F.timestamp_seconds(
        F.when(bare.rlike(r"^[0-9]{9,10}$"), bare).try_cast("bigint"))
    return F.coalesce(epoch, *[F.try_to_timestamp(bare, F.lit(f)) for f in BEST_EFFORT_FORMATS])


def fill_unknown(c: Column) -> Column:
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", UNKNOWN).otherwise(c)


def integer_or_null(text: Column) -> Column:
    """An optionally signed run of digits as LONG, else null."""
    return text.try_cast("bigint")


def unsigned_or_zero(text: Column, bits: int) -> Column:
    """Digits that fit an unsigned integer of ``bits``, else 0.

    64-bit ids in the upper half do not fit LONG: they are null, so that the row can be refused
    instead of falling into a false key.
    """
    digits = F.when(text.rlike(r"^[0-9]+$"), text)
    wide = digits.try_cast("decimal(20,0)")
    fits = wide <= F.lit(Decimal((1 << bits) - 1))
    zero = F.lit(0).cast("bigint")
    return F.when(F.coalesce(fits, F.lit(False)), wide.try_cast("bigint")).otherwise(zero)


def _price(text: Column) -> Column:
    """Decimal straight from the text; digits beyond the second decimal are discarded."""
    exact = text.try_cast("decimal(18,8)")
    return (exact - exact % F.lit(Decimal("0.01"))).try_cast(PRICE_TYPE)


def price_or_null(text: Column) -> Column:
    """A finite number as price; NaN and infinities are refused."""
    direct = _price(text)
    number = text.try_cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return F.coalesce(direct, finite.try_cast(PRICE_TYPE))


def price_or_zero(text: Column) -> Column:
    """0 where the text is no number; null where it is one too large for a price."""
    number = text.try_cast("double")
    too_large = F.coalesce(F.abs(number) >= F.lit(1e8), F.lit(False)) & ~F.isnan(number)
    return F.when(too_large, F.lit(None).cast(PRICE_TYPE)) \
        .otherwise(F.coalesce(_price(text), F.lit(0).cast(PRICE_TYPE)))
