import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketflow.functions import text as tx
from basketflow.operators.cleaning import clean_events, coarse_valid
from builders import at

BASE = ("2019-11-01 00:00:00 UTC,view,1003461,2053013555631882655,electronics.smartphone,"
        "xiaomi,489.07,520088904,s1")
HEADER = ("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,"
          "user_session")


def changed(**fields):
    parts = dict(zip(HEADER.split(","), BASE.split(",")))
    parts.update(fields)
    return ",".join(parts.values())


# Line and whether it is kept.
GOLDEN = {
    "ok": (BASE, True),
    "pad": (f"  {BASE}  ", True),
    "hdr": (HEADER, False),
    "nosess": (changed(user_session=""), False),
    "trail": (BASE + ",", True),
    "blank": ("   ", False),
    "8f": (BASE.rsplit(",", 1)[0], False),
    "10f": (BASE + ",x", False),
    "badtype": (changed(event_type="remove_from_cart"), False),
    "upper": (changed(event_type="VIEW"), False),
    "badts": (changed(event_time="2019-13-01 00:00:00 UTC"), False),
    "feb30": (changed(event_time="2019-02-30 00:00:00 UTC"), False),
    "old": (changed(event_time="1970-01-01 00:00:00 UTC"), False),
    "first": (changed(event_time="2000-01-01 00:00:00 UTC"), True),
    "last": (changed(event_time="2100-01-01 00:00:00 UTC"), True),
    "y2101": (changed(event_time="2101-01-01 00:00:00 UTC"), False),
    "noutc": (changed(event_time="2019-11-01 00:00:00"), True),
    "emptycat": (changed(category_code=""), True),
    "emptybrand": (changed(brand=" "), True),
    "badpid": (changed(product_id="x1"), False),
    "floatuid": (changed(user_id="5.0"), False),
    "negprice": (changed(price="-1.5"), True),
    "exponent": (changed(price="1e2"), True),
    "nan": (changed(price="NaN"), False),
    "infinite": (changed(price="Infinity"), False),
    "noprice": (changed(price=""), False),
    "quoted": (changed(brand='"a,b"'), False),
    "tab": (changed(brand="\txiaomi\t"), True),
    "usersp": (changed(user_id=" 520088904 "), True),
}


@pytest.fixture(scope="module")
def cleaned(spark):
    lines = spark.createDataFrame([(f"{line}",) for line, _ in GOLDEN.values()], "value string")
    return clean_events(lines).collect()


def test_kept_lines(spark):
    for name, (line, keep) in GOLDEN.items():
        got = clean_events(spark.createDataFrame([(line,)], "value string")).count()
        assert got == int(keep), name


def test_values(cleaned):
    assert len(cleaned) == sum(keep for _, keep in GOLDEN.values())
    first = cleaned[0]
    assert first.category_id == 2053013555631882655
    assert first.price == Decimal("489.07")
    assert first.event_date == dt.date(2019, 11, 1)
    assert first.event_time.replace(tzinfo=None) == at("2019-11-01 00:00:00").replace(tzinfo=None)
    assert {r.brand for r in cleaned} == {"xiaomi", "unknown"}
    assert {r.category_code for r in cleaned} == {"electronics.smartphone", "unknown"}
    assert {r.price for r in cleaned} == {Decimal("489.07"), Decimal("-1.50"), Decimal("100.00")}
    assert {r.user_id for r in cleaned} == {520088904}


COARSE = {
    "ok": (BASE, True),
    "hdr": (HEADER, False),
    "nosess": (changed(user_session=""), False),
    "trail": (BASE + ",", True),
    "any type": (changed(event_type="VIEW"), True),
    "dot price": (changed(price="."), True),
    "no price": (changed(price=""), False),
    "two dots": (changed(price="1.2.3"), False),
    "negative": (changed(price="-1.5"), False),
    "short time": (changed(event_time="2019-11-01"), False),
    "spaced id": (changed(user_id=" 5"), False),
    "10f": (BASE + ",x", False),
    "month 13": (changed(event_time="2019-13-01 00:00:00 UTC"), True),
}


def test_coarse_valid(spark):
    for name, (line, keep) in COARSE.items():
        got = coarse_valid(spark.createDataFrame([(line,)], "value string")).count()
        assert got == int(keep), name


def test_numbers_or_zero(spark):
    cases = [("12", 12, "12.00"), ("x", 0, "0.00"), ("", 0, "0.00"), ("-3", 0, "-3.00"),
             ("4294967296", 0, "0.00"), ("1.239", 0, "1.23"), (None, 0, "0.00")]
    df = spark.createDataFrame([(t,) for t, _, _ in cases], "t string").select(
        "t", tx.unsigned_or_zero(F.col("t"), 32).alias("n"), tx.price_or_zero(F.col("t")).alias("p"))
    got = {r.t: (r.n, r.p) for r in df.collect()}
    for t, number, price in cases:
        assert got[t][0] == number, t
        if t != "4294967296":
            assert got[t][1] == Decimal(price), t


def test_best_effort_time(spark):
    texts = {
        "2019-11-01 00:00:01 UTC": "2019-11-01T00:00:01",
        "2019-11-01T00:00:01": "2019-11-01T00:00:01",
        "2019-11-01T02:00:01+02:00": "2019-11-01T00:00:01",
        "2019-11-01": "2019-11-01T00:00:00",
        "1572566401": "2019-11-01T00:00:01",
        "-1": None, "nonsense": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.s for r in df.select("t", F.date_format(
        tx.best_effort_time(F.col("t")), "yyyy-MM-dd'T'HH:mm:ss").alias("s")).collect()}
    assert got == texts
