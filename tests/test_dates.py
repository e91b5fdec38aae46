"""Dates in many forms, against pandas."""

from datetime import datetime

import pandas as pd
import pytest
from frames import raw, raw_row
from pyspark.sql import functions as F

from tillwise.functions.dates import MixedOrders, Order, order_of, read_date
from tillwise.plans import pipeline

FORMS = [
    "12/1/2010 8:26", "12/01/2010 08:26", "12/1/2010", "12-1-2010 8:26", "12/13/2010 8:26:05", "12/1/10 8:26", "1/2/99",
    "2010-12-01T08:26:00Z", "2010-12-01 08:26:00.000", "2010-12-01 08:26:00+00:00", "2010-12-01 08:26:00.123456",
    "2010-12-01T08:26:00.5+02:00", "2010-12-01 08:26 UTC", "2010-12-01", "2010/12/1 8:26", "2010-12-1 8:26",
    "Dec 1, 2010", "Dec 1 2010 08:26", "December 1, 2010 8:26 PM", "1-Dec-2010 08:26", "1 Dec 2010", "01 December 2010 08:26:59",
    "1st Dec 2010", "Dec. 3rd, 2010", "Wed, 1 Dec 2010 08:26:00", "20101201", "20101201 0826", "20101201T082659",
    "12/1/2010 12:05 am", "12/1/2010 12:05 PM", "12/1/2010 1:05pm", " 12/1/2010 8:26 ", "2012-02-29", "dec-01-2010",
]
WRONG = [
    "soon", "", None, "2010-13-01", "2010-02-30", "13/13/2010", "2011-02-29", "12/1/2010 25:00", "12/1/2010 8:61",
    "12/1/2010 8:26:60", "12/1/2010 13:05 PM", "12/1/2010 0:05 am", "1", "2010", "12/2010", "Foo 1, 2010", "2010-12/01", "20101301",
    "0000-01-01", "12/1/2010 8:26 and more", "\x01" * 11,
]


def read(spark, texts, order=Order.MONTH_FIRST):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.at for r in rows.select("i", read_date(F.col("t"), order).alias("at")).orderBy("i").collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_like_pandas(spark, settings, zone):
    settings(session__timeZone=zone)
    theirs = [pd.to_datetime(t.strip()).tz_localize(None).to_pydatetime() for t in FORMS]
    assert read(spark, FORMS) == theirs


def test_other_texts_are_no_dates(spark):
    assert read(spark, WRONG) == [None] * len(WRONG)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_order_and_dots(spark, settings, ansi):
    settings(ansi__enabled=ansi)
    texts = ["2/1/2020", "13/1/2020", "2-1-2020 10:00", "2.1.2020", "13.1.2020", "Jan 2, 2020", "2020/1/2"]
    second = datetime(2020, 1, 2)
    assert read(spark, texts, Order.DAY_FIRST) == [
        second, datetime(2020, 1, 13), datetime(2020, 1, 2, 10), second, datetime(2020, 1, 13), second, second,
    ]
    assert read(spark, texts)[:4] == [datetime(2020, 2, 1), None, datetime(2020, 2, 1, 10), second]


def order(spark, *texts):
    return order_of(spark.createDataFrame([(t,) for t in texts], "d string"), "d")


def test_the_whole_feed_decides(spark):
    assert order(spark, "1/2/2020", "13/1/2020 8:26", None, "x") == Order.DAY_FIRST
    assert order(spark, "1/2/2020", "1-13-2020", "2020-01-13", "13.1.2020") == Order.MONTH_FIRST
    assert order(spark, "1/2/2020", "13 Jan 2020") is None
    with pytest.raises(MixedOrders, match="1 dates begin with the day and 2 with the month"):
        order(spark, "13/1/2020", "1/13/2020", "1/14/2020", "1/1/2020")


def test_a_feed_with_the_day_first(spark, tmp_path):
    rows = [raw_row(invoice=str(d), when=f"{d}/3/2020 10:00", customer=float(d)) for d in range(1, 20)]
    built = pipeline.build_all(spark, raw(spark, *rows), str(tmp_path / "a"), k=2)
    assert "dates day first" in built.log[0]
    days = pipeline.read_star(spark, str(tmp_path / "a")).dates.collect()
    assert {r.month for r in days} == {3} and len(days) == 19
    with pytest.raises(MixedOrders):
        pipeline.build_all(spark, raw(spark, *rows, raw_row(when="3/19/2020")), str(tmp_path / "b"))
    few = [raw_row(invoice=str(d), when=f"3/{d}/2020 10:00", customer=float(d)) for d in range(1, 9)]
    assert "nothing in the feed decides" in pipeline.build_all(spark, raw(spark, *few), str(tmp_path / "c"), k=2).log[0]
