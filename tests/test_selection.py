"""Tiles and quantiles by selection, against window functions and numpy."""

import numpy as np
import pytest
from frames import star
from pyspark.sql import Window, functions as F

from tillwise.operators import selection
from tillwise.operators.selection import exact_quantiles, with_ntiles
from tillwise.plans import reports


@pytest.fixture(params=[10_000, 3])
def few(request, monkeypatch):
    """Values counted one by one at once, and only after several brackets."""
    monkeypatch.setattr(selection, "FEW", request.param)


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [1.0] * 10 + [9.0], list(range(101)), [3, 1, 2, 2, 2, None], [None]])
def test_quantiles_interpolate_like_numpy(spark, few, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v DOUBLE")
    wanted = {"median": 0.5, "high": 0.95, "low": 0.0, "top": 1.0}
    found = exact_quantiles(df, {name: ("v", p) for name, p in wanted.items()})
    known = [v for v in values if v is not None]
    if not known:
        assert set(found.values()) == {None}
    else:
        expected = np.quantile(known, [0.5, 0.95, 0.0, 1.0])
        assert np.allclose([found["median"], found["high"], found["low"], found["top"]], expected, rtol=0, atol=1e-12)


@pytest.mark.parametrize("n, tiles", [(0, 4), (1, 4), (3, 4), (4, 4), (9, 4), (9, 10), (1001, 4), (1001, 10)])
def test_tiles_equal_the_window_function(spark, few, n, tiles):
    df = spark.range(n).select(
        (F.col("id") * 7 % 10_007).alias("id"), (F.col("id") * 7919 % 13).alias("v"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 3).cast("double").alias("w"),
    )
    found = with_ntiles(df, tiles, "id", a="v", b=("v", True), c="w", d=("w", True))
    assert found.columns == ["id", "v", "w", "a", "b", "c", "d"]
    windows = {"a": ["v", "id"], "b": [F.desc("v"), "id"], "c": ["w", "id"], "d": [F.desc("w"), "id"]}
    theirs = df.withColumns({k: F.ntile(tiles).over(Window.orderBy(*o)) for k, o in windows.items()})
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, theirs.collect()), key=str)


def test_one_value_in_a_third_of_the_rows(spark, few):
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 1.5).alias("v"))
    rows = with_ntiles(df, 4, "id", t="v").groupBy("t").agg(F.count("*").alias("n"), F.max("v").alias("high")).collect()
    assert {r.t: r.n for r in rows} == dict.fromkeys((1, 2, 3, 4), 7500)
    assert {r.t: float(r.high) for r in rows}[1] == 0.0


def test_a_sketch_that_is_off(spark, monkeypatch):
    """Brackets that miss the wanted rows on either side still lead to them."""
    monkeypatch.setattr(selection, "FEW", 20)
    monkeypatch.setattr(selection, "_REACH", 0.04)
    monkeypatch.setattr(selection, "_ACCURACY", 10)
    df = spark.range(3000).select((F.sqrt("id") * 10).alias("v")).cache()
    values = np.sqrt(np.arange(3000)) * 10
    wanted = {str(p): ("v", p) for p in (0.0, 0.13, 0.5, 0.77, 0.999)}
    found = exact_quantiles(df, wanted)
    assert np.allclose([found[k] for k in wanted], np.quantile(values, [p for _, p in wanted.values()]), atol=1e-9)


def test_no_row_is_sorted_or_written(spark):
    df = spark.range(1000)
    plan = with_ntiles(df, 4, "id", t="id")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "Window" not in plan


def test_measures_without_expanding_lines(spark):
    rows = [(str(i % 40), "A", i % 7, f"2020-0{1 + i % 3}-01", 1, 2.5) for i in range(400)]
    s = star(spark, *rows, countries={0: "DE", 1: "FR"})
    plan = reports.kpis(s)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    row = reports.kpis(s).first()
    assert (row.total_revenue, row.total_orders, row.active_customers) == (1000.0, 40, 7)
    assert reports.kpis(s.__class__(s.fact.limit(0), s.customers, s.products, s.dates)).first().total_orders == 0


def test_cube_rolls_up_within_its_error(spark):
    rows = [(str(i), "A", i % 900, f"2020-0{1 + i % 6}-0{1 + i % 9}", 1, 2.5) for i in range(6000)]
    s = star(spark, *rows, countries={i: f"C{i % 5}" for i in range(900)})
    cube = reports.measures_cube(s)
    assert cube.count() == 30
    whole = reports.roll_up(cube).first()
    assert whole.total_revenue == 15_000.0
    assert abs(whole.total_orders - 6000) < 0.05 * 6000 and abs(whole.active_customers - 900) < 0.05 * 900
    exact = {r.country: r for r in reports.measures(s.fact.join(s.customers, "customer_id"), ("country",)).collect()}
    for r in reports.roll_up(cube, "country").collect():
        assert abs(r.active_customers - exact[r.country].active_customers) <= 0.05 * exact[r.country].active_customers
