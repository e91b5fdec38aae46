"""Exact positions, running totals and tiles over a whole table, in any order.

A window without PARTITION BY moves every row to one task. Here the table is sorted
across all tasks instead, each row is tagged with its sorted slice and its place in
the slice, and the tagged rows are written once. What then has to be added up across
slices is one number per slice, never more rows than the sort had partitions, and
that is also the proven bound of the only broadcast.

The sort key must identify the row (or leave only interchangeable rows tied): ties
would fall to either side of a slice border, and a value held by a third of the rows
could not be split over tasks.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.sources.staging import stage

# monotonically_increasing_id() holds the partition above bit 33, the row number below.
_ROW_BITS = 33


def _sorted_slices(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    tagged = df.orderBy(*order).withColumn("_tag", F.monotonically_increasing_id())
    return (
        stage(tagged, "sorted")
        .withColumn("_slice", F.shiftright("_tag", _ROW_BITS))
        .withColumn("_row", F.col("_tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )


def _offsets(slices: DataFrame, size: Column) -> DataFrame:
    """What lies before each slice, and the grand total: one row per slice."""
    sizes = slices.groupBy("_slice").agg(size.alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "_slice",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )


def _positioned(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    slices = _sorted_slices(df, order)
    offsets = _offsets(slices, F.count(F.lit(1)))
    return slices.join(F.broadcast(offsets), "_slice").withColumn("_position", F.col("_before") + F.col("_row"))


def with_position(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Add the zero-based place of each row in the order of the whole table."""
    return _positioned(df, order).select(*df.columns, F.col("_position").alias(name))


def tile_number(position: Column, total: Column, tiles: int) -> Column:
    """NTILE of a zero-based position: the first ``total % tiles`` tiles get one more row."""
    small = F.floor(total / F.lit(tiles))
    larger = total % tiles
    border = larger * (small + 1)
    return (
        F.when(position < border, F.floor(position / (small + 1)))
        .otherwise(larger + F.floor((position - border) / F.greatest(small, F.lit(1))))
        .cast("int")
        + 1
    )


def with_ntile(df: DataFrame, order: Sequence[Column | str], tiles: int, name: str) -> DataFrame:
    """Add NTILE(tiles) over the whole table."""
    tile = tile_number(F.col("_position"), F.col("_total"), tiles)
    return _positioned(df, order).select(*df.columns, tile.alias(name))


def with_running_total(
    df: DataFrame, order: Sequence[Column | str], value: str, running: str, total: str
) -> DataFrame:
    """Add the sum of ``value`` up to and including each row, and over all rows.

    The window works on one sorted slice at a time.
    """
    slices = _sorted_slices(df, order)
    offsets = _offsets(slices, F.sum(value))
    within = Window.partitionBy("_slice").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        slices.withColumn("_within", F.sum(value).over(within))
        .join(F.broadcast(offsets), "_slice")
        .select(
            *df.columns,
            (F.col("_before") + F.col("_within")).alias(running),
            F.col("_total").alias(total),
        )
    )
