import pytest
from pyspark.sql import Window, functions as F

from tillwise.operators.ranking import with_ntile, with_position, with_running_total


@pytest.fixture
def many_slices(settings):
    """Keep the sort from folding small partitions into one."""
    settings(adaptive__coalescePartitions__enabled="false", shuffle__partitions=7)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 9, 1001])
@pytest.mark.parametrize("tiles", [4, 10])
def test_ntile_equals_the_window_function(spark, many_slices, n, tiles):
    df = spark.range(n).select("id", (F.col("id") * 7919 % 13).alias("v"))
    ours = {r.id: r.t for r in with_ntile(df, ["v", F.desc("id")], tiles, "t").collect()}
    theirs = df.withColumn("t", F.ntile(tiles).over(Window.orderBy("v", F.desc("id")))).collect()
    assert ours == {r.id: r.t for r in theirs}


def test_positions_are_dense(spark, many_slices):
    df = spark.range(5000).select("id", F.xxhash64("id").alias("v"))
    rows = with_position(df, ["v"], "p").orderBy("v").collect()
    assert [r.p for r in rows] == list(range(5000))


def test_one_value_in_a_third_of_the_rows(spark, many_slices):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    rows = with_ntile(df, ["v", "id"], 4, "t").groupBy("t").count().collect()
    assert {r.t: r["count"] for r in rows} == {1: 750, 2: 750, 3: 750, 4: 750}


def test_running_total(spark, many_slices):
    df = spark.range(1, 1001).select("id", F.col("id").cast("decimal(18,2)").alias("amount"))
    rows = with_running_total(df, ["id"], "amount", "so_far", "overall").collect()
    assert all(r.so_far == r.id * (r.id + 1) // 2 and r.overall == 500500 for r in rows)


def test_no_row_of_the_table_passes_through_a_single_task(spark, many_slices):
    """The only single-partition exchange holds one row per slice."""
    plan = with_ntile(spark.range(1000), ["id"], 4, "t")._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1
    below = plan[plan.index("Exchange SinglePartition"):]
    assert "HashAggregate(keys=[_slice" in below.splitlines()[1]
