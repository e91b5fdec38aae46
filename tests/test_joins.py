import pytest
from pyspark.sql import functions as F

from tillwise.operators.joins import join_lookup


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one key, some keys are unknown, some missing."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(30_000).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(450).select(F.col("id").alias("k"), F.concat(F.lit("name "), F.col("id")).alias("name"))


def contents(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("k", "id", "name").cast("decimal(38,0)"))).first()


@pytest.mark.parametrize("limit", [0, 449, 450])
def test_same_rows_as_a_plain_join(rows, lookup, limit):
    assert contents(join_lookup(rows, lookup, "k", broadcast_rows=limit)) == contents(rows.join(lookup, "k"))


def test_only_a_counted_small_lookup_is_broadcast(rows, lookup, settings):
    settings(autoBroadcastJoinThreshold=-1)

    def plan(limit):
        return join_lookup(rows, lookup, "k", broadcast_rows=limit)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin [k" in plan(450) and "SortMergeJoin" not in plan(450)
    assert "SortMergeJoin [k" in plan(449)


def test_a_frequent_key_is_spread_over_tasks(spark, rows, lookup, settings):
    settings(
        autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1, shuffle__partitions=16,
        adaptive__coalescePartitions__enabled="false", adaptive__skewJoin__enabled="false",
    )

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    even = rows.count() / 16
    assert largest(rows.join(lookup, "k")) > 5 * even
    assert largest(join_lookup(rows, lookup, "k", broadcast_rows=0)) < 3 * even


def test_no_frequent_key(spark, lookup):
    flat = spark.range(4500).select("id", (F.col("id") % 450).alias("k"))
    assert contents(join_lookup(flat, lookup, "k", broadcast_rows=0)) == contents(flat.join(lookup, "k"))


def test_a_lookup_of_few_but_long_rows_is_not_broadcast(spark, settings, monkeypatch):
    from tillwise.operators import joins

    settings(autoBroadcastJoinThreshold=-1)
    monkeypatch.setattr(joins, "BROADCAST_TEXT_BYTES", 1000)
    long = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 200).alias("text"))
    rows = spark.range(100).select("id", (F.col("id") % 10).alias("k"))
    joined = join_lookup(rows, long, "k")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100
