from datetime import date, timedelta

import numpy as np
import pytest
from frames import fact
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillwise.plans import forecast as fc


def series(spark, values, start=date(2020, 1, 6), key=None):
    rows = [(start + timedelta(days=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ds DATE, y DOUBLE")
    return df if key is None else df.select(F.lit(key).alias("country"), "ds", "y")


def test_gaps_are_filled_per_key(spark):
    table = fact(spark, ("1", "A", 1, "2020-01-01", 1, 5.0), ("2", "A", 1, "2020-01-04", 1, 7.0),
                 ("3", "B", 1, "2020-01-03", 1, 1.0))
    whole = [(str(r.ds), r.y) for r in fc.fill_days(fc.daily_revenue(table)).orderBy("ds").collect()]
    assert whole == [("2020-01-01", 5.0), ("2020-01-02", 0.0), ("2020-01-03", 1.0), ("2020-01-04", 7.0)]
    split = fc.fill_days(fc.daily_revenue(table, ["stock_code"]), ["stock_code"], horizon=1)
    assert split.where("stock_code = 'A'").count() == 5
    assert split.where("stock_code = 'B'").count() == 2
    assert split.where("y IS NULL").count() == 2


def test_future_frame(spark):
    frame = fc.future_frame(series(spark, [1.0] * 10), 90)
    assert frame.where("is_future").count() == 90 and frame.count() == 100


def test_linear_model_recovers_trend_and_weekday(spark):
    days = 70
    truth = [10.0 + 2.0 * i + (3.0 if i % 7 == 0 else -0.5) for i in range(days + 14)]
    table = fc.forecast_table(series(spark, truth[:days]), horizon=14).orderBy("ds").collect()
    # the weekday pattern is slightly correlated with the trend in a finite sample
    assert np.allclose([r.forecast for r in table], truth, atol=0.5)
    assert all(r.lower <= r.forecast <= r.upper for r in table)
    assert [r.actual for r in table][-14:] == [None] * 14


@pytest.mark.parametrize("model", [fc.fit_linear, fc.fit_additive])
def test_models_work_per_key(spark, model):
    both = series(spark, [5.0 + i for i in range(40)], key="X").unionByName(
        series(spark, [500.0 - i for i in range(60)], key="Y")
    )
    table = fc.forecast_table(both, 5, ["country"], model)
    total = {r.country: (r.days, r.forecast_revenue) for r in fc.forecast_total(table, ["country"]).collect()}
    assert total["X"][0] == total["Y"][0] == 5
    assert total["X"][1] == pytest.approx(sum(45.0 + i for i in range(5)), rel=0.05)
    assert total["Y"][1] == pytest.approx(sum(440.0 - i for i in range(5)), rel=0.05)


def test_additive_model_follows_yearly_and_weekly_waves(spark):
    days = np.arange(900)
    truth = 100 + 0.05 * days + 20 * np.sin(2 * np.pi * days / 365.25) + 5 * (days % 7 == 3)
    score = fc.holdout_score(series(spark, truth.tolist()), model=fc.fit_additive).first()
    assert score.holdout_days == 60 and score.mape < 0.05


def test_holdout_needs_a_longer_history(spark):
    with pytest.raises(PySparkException, match="not longer than the holdout"):
        fc.holdout_score(series(spark, [1.0] * 60)).collect()
    assert fc.holdout_score(series(spark, [1.0] * 61)).first().holdout_days == 60


def test_empty_days_count_as_one_in_the_percentage(spark):
    values = [10.0] * 70 + [0.0] * 60
    row = fc.holdout_score(series(spark, values)).first()
    assert row.mae == pytest.approx(10.0) and row.mape == pytest.approx(10.0)


def test_training_never_sees_the_test_days(spark):
    calm, wild = [10.0] * 100 + [10.0] * 60, [10.0] * 100 + [1e6] * 60
    for model in (fc.fit_linear, fc.fit_additive):
        errors = [fc.holdout_score(series(spark, v), model=model).first().mae for v in (calm, wild)]
        assert errors[0] == pytest.approx(0.0, abs=0.1) and errors[1] == pytest.approx(1e6 - 10, rel=1e-3)


def test_one_series_and_series_by_key_have_the_same_additive_fit(spark):
    days = np.arange(900)
    y = 50 + 0.1 * days + 9 * np.sin(2 * np.pi * days / 365.25) + 4 * (days % 7 == 2) + np.cos(days * 1.7)
    known = fc.fill_days(series(spark, y.tolist()), horizon=60)
    whole = {r.ds: r for r in fc.fit_additive(known).collect()}
    keyed = {r.ds: r for r in fc.fit_additive(known.withColumn("key", F.lit("a")), ["key"]).collect()}
    assert whole.keys() == keyed.keys() and len(whole) == 960
    for ds, r in whole.items():
        assert abs(r.yhat - keyed[ds].yhat) < 1e-3 and abs(r.yhat_lower - keyed[ds].yhat_lower) < 1e-3


def test_one_series_needs_no_python(spark):
    plan = fc.fit_additive(series(spark, [1.0, 2.0, 4.0] * 10))._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_a_wrong_date_is_an_error(spark):
    days = spark.createDataFrame([(date(2020, 1, 1), 1.0), (date(9999, 1, 1), 1.0)], "ds DATE, y DOUBLE")
    with pytest.raises(PySparkException, match="too many days after 2020-01-01"):
        fc.fill_days(days).count()
    long = spark.sql("SELECT explode(sequence(DATE '1800-01-01', DATE '2030-01-01')) AS ds, 1.0D AS y")
    with pytest.raises(PySparkException, match="cannot be fitted"):
        fc.fit_additive(long)


@pytest.mark.parametrize("keys", [[], ["country"]])
def test_the_interval_widens_with_the_days_ahead(spark, keys):
    pick = np.random.default_rng(2)
    values = np.cumsum(np.repeat(pick.normal(0, 1.0, 25), 24)) + pick.normal(0, 2.0, 600) + 100
    table = fc.forecast_table(series(spark, values.tolist(), key="X" if keys else None), 90, keys, fc.fit_additive)
    rows = table.orderBy("ds").collect()
    widths = [r.upper - r.lower for r in rows]
    assert np.allclose(widths[:600], widths[0]) and np.all(np.diff(widths[600:]) > 0)
    assert all(abs((r.upper + r.lower) / 2 - r.forecast) < 1e-9 for r in rows)


def test_about_four_of_five_held_out_days_lie_in_the_interval(spark, small):
    from tillwise.warehouse import Warehouse

    daily = fc.fill_days(fc.daily_revenue(Warehouse(spark, small).fact()))
    marked = fc.mark_holdout(daily, 60).withColumn("actual", F.col("y"))
    fitted = fc.fit_additive(marked.withColumn("y", F.when(~F.col("is_test"), F.col("y"))))
    inside = fitted.where("is_test").agg(F.avg(F.col("actual").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int")))
    assert 0.7 <= inside.first()[0] <= 0.95
