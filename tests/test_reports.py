import numpy as np
import pytest
from frames import star
from pyspark.sql import functions as F

from tillwise.functions.display import currency, grouped_number, percent
from tillwise.functions.numeric import round_half_even, round_half_up
from tillwise.plans import reports


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def gaps(spark):
    """Sales in January, February and April; two customers of different countries."""
    return star(
        spark,
        ("1", "A", 1, "2020-01-10", 2, 5.0), ("1", "B", 1, "2020-01-10", 1, 2.5), ("2", "A", 2, "2020-02-01", 1, 5.0),
        ("3", "A", 1, "2020-04-30", 4, 5.0), ("4", "B", 2, "2020-04-01", 2, 2.5),
        countries={1: "UK", 2: "EIRE"},
    )


def test_rounding_of_halves(spark):
    row = spark.range(1).select(
        round_half_up(F.lit(2.5), 0), round_half_up(F.lit(-2.5), 0), round_half_up(F.lit(0.125), 2),
        round_half_even(F.lit(0.25), 1), round_half_even(F.lit(0.35), 1),
    ).first()
    assert tuple(row) == (3.0, -3.0, 0.13, 0.2, float(np.round(0.35, 1)))


def test_growth_over_present_and_calendar_month(spark, gaps):
    assert rows_of(reports.month_growth(gaps)) == [
        (2020, 1, 12.5, None, None), (2020, 2, 5.0, 12.5, -60.0), (2020, 4, 25.0, 5.0, 400.0),
    ]
    calendar = {(r.year, r.month): r.mom_growth for r in reports.calendar_month_growth(gaps).collect()}
    assert calendar == {(2020, 1): None, (2020, 2): -0.6, (2020, 4): None}


def test_growth_after_a_month_without_revenue(spark):
    s = star(spark, ("1", "A", 1, "2020-01-10", 1, 0.0), ("2", "A", 1, "2020-02-10", 1, 5.0))
    assert rows_of(reports.month_growth(s))[1] == (2020, 2, 5.0, 0.0, None)
    assert [r.mom_growth for r in reports.calendar_month_growth(s).orderBy("month").collect()] == [None, None]


def test_country_totals_add_up(spark, gaps):
    by_country = reports.revenue_by_country(gaps).collect()
    assert sum(r.total_revenue for r in by_country) == reports.kpis(gaps).first().total_revenue == 42.5
    assert [r.country for r in by_country] == ["UK", "EIRE"]


def test_quarter_change_counts_a_country_that_vanished(spark):
    s = star(spark, ("1", "A", 1, "2020-01-10", 1, 50.0), ("2", "A", 2, "2020-05-10", 1, 5.0),
             countries={1: "UK", 2: "EIRE"})
    assert rows_of(reports.country_quarter_change(s)) == [("UK", 0.0, 50.0, -50.0), ("EIRE", 5.0, 0.0, 5.0)]


def test_last_month_of_one_country(spark, gaps):
    assert rows_of(reports.country_last_month(gaps, "UK")) == [("UK", 20.0, 1, 1)]


def test_cohorts(spark, gaps):
    assert rows_of(reports.cohort_retention(gaps)) == [
        ("2020-01", 0, 1, 1, 100.0), ("2020-01", 3, 1, 1, 100.0),
        ("2020-02", 0, 1, 1, 100.0), ("2020-02", 2, 1, 1, 100.0),
    ]


def test_kpis_of_nothing(spark, gaps):
    empty = gaps.__class__(gaps.fact.limit(0), gaps.customers, gaps.products, gaps.dates)
    assert rows_of(reports.kpis(empty)) == [(None, 0, 0, 0.0)]
    assert reports.measures(empty.fact).first().avg_order_value is None


def test_key_stats(spark, gaps):
    row = reports.key_stats(gaps, reports.customer_orders(gaps)).first()
    assert tuple(row) == (2, 2.0, 21.25, "Apr 2020", 25.0, "A", 35.0)


@pytest.mark.parametrize("values", [[1, 2, 2, 3, 10], [7, 7, 7], [0, 30, 15, 29.9, 1]])
def test_histogram_like_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    rows = reports.histogram(df, "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r.customers for r in rows] == counts.tolist()
    assert np.allclose([r.lower_edge for r in rows] + [rows[-1].upper_edge], edges)


def test_shares_end_at_one(spark, gaps):
    shares = [r.cumulative_share for r in reports.sku_concentration(gaps).orderBy(F.desc("revenue")).collect()]
    assert shares == [35.0 / 42.5, 1.0]


def test_display(spark):
    row = spark.range(1).select(
        grouped_number(F.lit(1234567)), percent(F.lit(0.1234)), currency(F.lit(1234.5))
    ).first()
    assert tuple(row) == ("1,234,567", "12.3%", "£1,234.50")


def test_key_stats_of_nothing(spark, gaps):
    empty = gaps.__class__(gaps.fact.limit(0), gaps.customers, gaps.products, gaps.dates)
    row = reports.key_stats(empty, reports.customer_orders(empty)).first()
    assert tuple(row) == (0, None, None, None, None, None, None)
