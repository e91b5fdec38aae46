"""Daily revenue series, two forecasting models and the holdout score.

A series may be split by keys (country, product); everything below then runs per key.
The rows of one series are days, so a window or group over one series is bounded by
the calendar however large the fact table is.

Both models write ``yhat``, ``yhat_lower`` and ``yhat_upper`` next to the series. Days
to be predicted are rows whose ``y`` is NULL; they take no part in the fit.
"""

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import PySparkValueError
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.numeric import money_sum, money_total
from tillwise.operators.star import Star
from tillwise.sources.staging import stage

# Half-width of an 80 % normal interval.
INTERVAL_Z = 1.2816

# Days a series may span; more come from a wrong date, not from sales.
MOST_DAYS = 200 * 366

Model = Callable[[DataFrame, Sequence[str]], DataFrame]


def daily_revenue(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Revenue per day: ``ds, y``."""
    return fact.groupBy(*keys, F.col("date_key").alias("ds")).agg(money_sum("revenue").alias("y"))


def daily_revenue_by_country(star: Star) -> DataFrame:
    """Revenue per country of the customer and day: ``country, ds, y``.

    Lines are added up to one row per customer and day before the customers are joined.
    """
    spent = star.fact.groupBy("customer_id", F.col("date_key").alias("ds")).agg(money_total("revenue").alias("amount"))
    located = spent.join(star.customers, "customer_id")
    return located.groupBy("country", "ds").agg(F.sum("amount").cast("double").alias("y"))


def fill_days(daily: DataFrame, keys: Sequence[str] = (), horizon: int = 0) -> DataFrame:
    """A row for every day, zero where nothing was sold, NULL for ``horizon`` days after
    the last one.

    Each row stretches to the day before the next one, so the series is read once and
    joined with nothing. A gap of more than ``MOST_DAYS`` is an error.
    """
    in_order = Window.partitionBy(*keys).orderBy("ds")
    stretched = daily.withColumn("next_ds", F.lead("ds").over(in_order))
    until = F.coalesce(F.date_sub("next_ds", 1), F.date_add("ds", horizon))
    too_long = F.raise_error(F.concat(F.lit("a gap of too many days after "), F.col("ds").cast("string")))
    until = F.when(F.datediff(until, "ds") > MOST_DAYS, too_long.cast("date")).otherwise(until)
    days = stretched.withColumn("day", F.explode(F.sequence("ds", until)))
    y = F.when(F.col("day") == F.col("ds"), F.col("y")).when(F.col("next_ds").isNotNull(), F.lit(0.0))
    return days.select(*keys, F.col("day").alias("ds"), y.alias("y"))


def future_frame(series: DataFrame, horizon: int, keys: Sequence[str] = ()) -> DataFrame:
    """The days of a gap-free series followed by the days to predict."""
    marked = fill_days(series, keys, horizon)
    return marked.select(*keys, "ds", F.col("y").isNull().alias("is_future"))


def mark_holdout(series: DataFrame, days: int = 60, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``is_test``: the last ``days`` days of each gap-free series.

    A series that leaves nothing to train on is an error.
    """
    whole = Window.partitionBy(*keys)
    cutoff = F.date_sub(F.max("ds").over(whole), days)
    too_short = F.raise_error(F.lit(f"the history is not longer than the holdout of {days} days"))
    is_test = F.when(F.min("ds").over(whole) > cutoff, too_short.cast("boolean")).otherwise(F.col("ds") > cutoff)
    return series.withColumn("is_test", is_test)


def fit_linear(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Straight trend plus the mean residual of the weekday, in window aggregates only."""
    whole = Window.partitionBy(*keys)
    weekday = Window.partitionBy(*keys, "weekday")
    t = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
    trend = F.col("slope") * F.col("t") + F.col("intercept")
    return (
        series.withColumn("t", t)
        .withColumn("weekday", F.weekday("ds"))
        .withColumn("slope", F.coalesce(F.regr_slope("y", "t").over(whole), F.lit(0.0)))
        .withColumn("intercept", F.coalesce(F.regr_intercept("y", "t").over(whole), F.avg("y").over(whole)))
        .withColumn("season", F.coalesce(F.avg(F.col("y") - trend).over(weekday), F.lit(0.0)))
        .withColumn("yhat", trend + F.col("season"))
        .withColumn("spread", F.lit(INTERVAL_Z) * F.stddev_pop(F.col("y") - F.col("yhat")).over(whole))
        .withColumn("yhat_lower", F.col("yhat") - F.col("spread"))
        .withColumn("yhat_upper", F.col("yhat") + F.col("spread"))
        .drop("t", "weekday", "slope", "intercept", "season", "spread")
    )


def _additive_fit() -> tuple[Callable, Callable]:
    """The fit of one series: its weights from days and values, and the whole of it as a frame.

    Local functions travel to the executors by value, so the package need not be
    installed there.
    """

    def design(days: np.ndarray, first: float, span: float) -> np.ndarray:
        """Trend with 25 bends in the first 80 % of the history, yearly and weekly waves.

        Waves are left out where the history is too short to show them.
        """
        when = (days - first) / max(span, 1.0)
        columns = [np.ones_like(when), when]
        columns += [np.maximum(when - bend, 0.0) for bend in np.linspace(0.0, 0.8, 26)[1:]]
        waves = []
        if span >= 730:
            waves.append((365.25, 10))
        if span >= 14:
            waves.append((7.0, 3))
        for period, order in waves:
            for n in range(1, order + 1):
                angle = 2.0 * np.pi * n * days / period
                columns += [np.sin(angle), np.cos(angle)]
        return np.column_stack(columns)

    def solve(days: np.ndarray, y: np.ndarray) -> tuple[float, float, np.ndarray, float, float]:
        """First day, span, weights, deviation of the residuals, and how much the variance grows
        with the cube of the days after the last one.

        Ridge regression; level and overall slope are hardly penalised. The trend goes on to
        bend in the future as often as in the past, and as much on average: bends of
        size b at rate r add r b^2 h^3 / 3 to the variance h days ahead, twice that as
        their sizes vary like those of the past.
        """
        first, span = float(days.min()), float(days.max() - days.min())
        x = design(days, first, span)
        size = max(np.abs(y).max(), 1.0)
        penalty = np.diag([1e-9, 1e-6] + [1.0] * (x.shape[1] - 2))
        weights = np.linalg.solve(x.T @ x + penalty, x.T @ (y / size)) * size
        bend = np.abs(weights[2:27]).mean() / max(span, 1.0)
        growth = 25 / (0.8 * max(span, 1.0)) * 2 * bend**2 / 3
        return first, span, weights, float(np.std(y - x @ weights)), float(growth)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ds", ignore_index=True)
        days = (pd.to_datetime(frame["ds"]) - pd.Timestamp(0)).dt.days.to_numpy(float)
        y = frame["y"].to_numpy(float)
        known = ~np.isnan(y)
        first, span, weights, deviation, growth = solve(days[known], y[known])
        yhat = design(days, first, span) @ weights
        ahead = np.maximum(days - first - span, 0.0)
        spread = INTERVAL_Z * np.sqrt(deviation**2 + growth * ahead**3)
        return frame.assign(yhat=yhat, yhat_lower=yhat - spread, yhat_upper=yhat + spread)

    return solve, fit


def _design(day: Column, first: float, span: float) -> list[Column]:
    """The columns that ``_additive_fit`` builds, as expressions."""
    when = (day - F.lit(first)) / F.lit(max(span, 1.0))
    columns = [F.lit(1.0), when, *(F.greatest(when - F.lit(0.8 * i / 25), F.lit(0.0)) for i in range(1, 26))]
    waves = [(365.25, 10)] * (span >= 730) + [(7.0, 3)] * (span >= 14)
    for period, order in waves:
        for n in range(1, order + 1):
            angle = day * F.lit(2.0 * math.pi * n / period)
            columns += [F.sin(angle), F.cos(angle)]
    return columns


def _fit_whole(series: DataFrame) -> DataFrame:
    """The additive model of one series. It has a row a day, so the driver can solve for its
    weights, of at most ``MOST_DAYS`` days; the forecast is a column."""
    series = stage(series, "series")
    day = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
    rows = series.where("y IS NOT NULL").select(day.alias("day"), "y").orderBy("day").limit(MOST_DAYS + 1).collect()
    if not rows:
        raise PySparkValueError("a series without a known day cannot be fitted")
    if len(rows) > MOST_DAYS:
        raise PySparkValueError(f"a series of more than {MOST_DAYS} days cannot be fitted")
    solve, _ = _additive_fit()
    first, span, weights, deviation, growth = solve(*(np.array(c, float) for c in zip(*rows, strict=True)))
    # Sums of columns times weights, as one expression over two arrays.
    pairs = F.zip_with(F.array(*_design(day, first, span)), F.array(*(F.lit(float(w)) for w in weights)), lambda a, b: a * b)
    fitted = series.withColumn("yhat", F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x))
    ahead = F.greatest(day - F.lit(first + span), F.lit(0.0))
    margin = F.lit(INTERVAL_Z) * F.sqrt(F.lit(deviation**2) + F.lit(growth) * ahead * ahead * ahead)
    return fitted.withColumn("yhat_lower", F.col("yhat") - margin).withColumn("yhat_upper", F.col("yhat") + margin)


def fit_additive(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Piecewise linear trend with yearly and weekly seasonality.

    With ``keys`` each series, one row a day, is fitted by itself in one task. The interval
    widens with the days ahead, as the trend may bend again.
    """
    if not keys:
        return _fit_whole(series)
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in series.schema)
    schema += ", yhat DOUBLE, yhat_lower DOUBLE, yhat_upper DOUBLE"
    return series.groupBy(*keys).applyInPandas(_additive_fit()[1], schema)


def forecast_table(
    daily: DataFrame, horizon: int = 90, keys: Sequence[str] = (), model: Model = fit_linear
) -> DataFrame:
    """``ds, forecast, lower, upper, actual`` for the history and the days after it."""
    fitted = model(fill_days(daily, keys, horizon), keys)
    return fitted.select(
        *keys,
        "ds",
        F.col("yhat").alias("forecast"),
        F.col("yhat_lower").alias("lower"),
        F.col("yhat_upper").alias("upper"),
        F.col("y").alias("actual"),
    )


def forecast_total(forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Days after the history and the revenue expected in them.

    Days of the history always have an actual value, zero if nothing was sold.
    """
    future = forecast.where(F.col("actual").isNull())
    return future.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"), F.sum("forecast").alias("forecast_revenue")
    )


def holdout_score(
    daily: DataFrame, days: int = 60, keys: Sequence[str] = (), model: Model = fit_linear
) -> DataFrame:
    """Mean absolute error and mean absolute percentage error on the held-out days.

    The model is fitted on the days before. An empty day counts as one in the divisor.
    """
    series = mark_holdout(fill_days(daily, keys), days, keys)
    training = series.withColumn("actual", F.col("y")).withColumn("y", F.when(~F.col("is_test"), F.col("y")))
    fitted = model(training, keys)
    error = F.abs(F.col("actual") - F.col("yhat"))
    divisor = F.when(F.col("actual") == 0, F.lit(1.0)).otherwise(F.col("actual"))
    return (
        fitted.where("is_test")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("holdout_days"),
            F.avg(error).alias("mae"),
            F.avg(F.abs((F.col("actual") - F.col("yhat")) / divisor)).alias("mape"),
        )
    )
