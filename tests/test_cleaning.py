import math
from datetime import datetime

import pytest
from frames import raw, raw_row

from tillwise.operators.cleaning import DAY_FIRST, DEFAULT_PATTERN, clean, clean_report


def kept(spark, *rows):
    return clean(raw(spark, *rows)).collect()


def test_only_a_capital_c_cancels(spark):
    rows = kept(spark, raw_row(invoice="C1"), raw_row(invoice="c1"), raw_row(invoice=None))
    assert sorted(r.InvoiceNo for r in rows) == ["c1", "nan"]


def test_customer_is_needed_and_loses_its_fraction(spark):
    rows = kept(spark, raw_row(customer=None), raw_row(customer=math.nan), raw_row(customer=12.9))
    assert [r.CustomerID for r in rows] == [12]


@pytest.mark.parametrize("change", [{"quantity": 0}, {"quantity": -1}, {"price": 0.0}, {"price": math.nan},
                                    {"price": -1.0}, {"quantity": None}, {"price": None}])
def test_quantity_and_price_must_be_positive(spark, change):
    assert kept(spark, raw_row(**change)) == []


def test_duplicates_are_judged_on_the_date_text(spark):
    rows = kept(
        spark, raw_row(), raw_row(), raw_row(when="1/2/2020 10:00"), raw_row(text=None), raw_row(text=None)
    )
    assert len(rows) == 3
    assert {r.InvoiceDate for r in rows} == {datetime(2020, 1, 2, 10)}


@pytest.mark.parametrize("text", ["2020-01-02 10:00", "not-a-date", "13/01/2020 10:00", "02/30/2020 10:00", None, ""])
def test_dates_of_another_format_than_the_only_one_are_dropped(spark, text):
    assert clean(raw(spark, raw_row(when=text)), DEFAULT_PATTERN).collect() == []


def test_unreadable_dates_are_dropped(spark):
    rows = kept(spark, *(raw_row(when=t) for t in ("13/01/2020 10:00", "02/30/2020 10:00", "soon", None, "")))
    assert rows == []


@pytest.mark.parametrize("texts, n", [
    (["not-a-date", "2010-12-01 08:26:00", "2010-12-02 08:26:00", "2010-12-03 08:26:00"], 3),
    (["2010-12-01T08:26:00", "2010-12-02T08:26:00", "2010-12-03T08:26:00"], 3),
    (["01.12.2010 08:26", "02.12.2010 08:26", "13.12.2010 08:26"], 3),
    (["12/1/2010 8:26", "2010-12-01 08:27", "2010-12-01", "12/13/2010 08:26:30"], 4),
])
def test_every_date_is_read_on_its_own(spark, texts, n):
    rows = kept(spark, *(raw_row(when=t) for t in texts))
    assert len(rows) == n and all(r.InvoiceDate.year == 2010 and r.InvoiceDate.month == 12 for r in rows)


def test_order_of_day_and_month_is_a_choice(spark):
    table = raw(spark, raw_row(when="13/01/2020 10:00"), raw_row(when="2/1/2020 10:00"))
    assert {r.InvoiceDate for r in clean(table, DAY_FIRST).collect()} == {
        datetime(2020, 1, 13, 10), datetime(2020, 1, 2, 10)
    }


def test_hours_skipped_by_summer_time_survive(spark, settings):
    settings(session__timeZone="America/New_York")
    text = clean(raw(spark, raw_row(when="03/08/2020 02:30"))).selectExpr("cast(InvoiceDate as string)").first()[0]
    assert text == "2020-03-08 02:30:00"


def test_revenue_is_not_rounded(spark):
    assert kept(spark, raw_row(quantity=3, price=0.333))[0].Revenue == 3 * 0.333


def test_aliased_headers(spark):
    table = raw(spark, raw_row()).withColumnsRenamed(
        {"InvoiceNo": "Invoice", "CustomerID": "Customer ID", "UnitPrice": "Price"}
    )
    assert clean(table).count() == 1


def test_report_adds_up(spark):
    table = raw(
        spark, raw_row(), raw_row(), raw_row(), raw_row(invoice="C9"), raw_row(invoice="C9", customer=None),
        raw_row(customer=None), raw_row(quantity=0), raw_row(when="?"), raw_row(when="?"), raw_row(stock="B"),
    )
    row = clean_report(table).first().asDict()
    assert row == {
        "rows_before": 10, "cancelled": 2, "no_customer": 1, "not_positive": 1, "duplicates": 3, "bad_date": 1,
        "rows_after": 2, "dropped": 8, "dropped_rate": 0.8,
    }
    assert clean(table).count() == row["rows_after"]


def test_report_of_an_empty_feed(spark):
    row = clean_report(raw(spark, raw_row()).limit(0)).first()
    assert (row.rows_before, row.rows_after, row.dropped_rate) == (0, 0, None)


def test_fine_prices_are_not_lost_in_sums(spark):
    from tillwise.operators.star import fact_sales
    from tillwise.plans.reports import measures

    table = clean(raw(spark, raw_row(price=0.001, stock="A"), raw_row(price=0.001, stock="B")))
    assert measures(fact_sales(table)).first().total_revenue == 0.002


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_are_whole_or_an_error(spark, settings, ansi):
    from pyspark.errors import PySparkException
    from tillwise.operators.star import fact_sales
    from tillwise.plans.reports import measures

    settings(ansi__enabled=ansi)

    def total(*prices):
        rows = [raw_row(quantity=1, price=p, stock=str(i)) for i, p in enumerate(prices)]
        return measures(fact_sales(clean(raw(spark, *rows)))).first().total_revenue

    assert total(0.00004) == 0.00004
    assert total(2e14, 1.5) == 200000000000001.5
    assert total(math.inf, 2.0) == 2.0
    with pytest.raises(PySparkException, match="amount does not fit"):
        total(1e35)


def test_infinite_prices_are_reported(spark):
    report = clean_report(raw(spark, raw_row(price=math.inf), raw_row())).first()
    assert (report.not_positive, report.rows_after) == (1, 1)
