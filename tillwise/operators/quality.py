"""Checks of the declared keys, which Spark does not enforce by itself."""

from pyspark.sql import DataFrame, functions as F

from tillwise.operators.star import Star

PRIMARY_KEYS = {
    "fact_sales": "line_id",
    "dim_customer": "customer_id",
    "dim_product": "stock_code",
    "dim_date": "date_key",
}

FOREIGN_KEYS = {
    "dim_product": "stock_code",
    "dim_customer": "customer_id",
    "dim_date": "date_key",
}


def primary_key_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, distinct keys, rows without a key, keys held by several rows."""
    report = None
    for name, key in PRIMARY_KEYS.items():
        held = tables[name].groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        present = F.col("key").isNotNull()
        part = held.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
            F.count("key").alias("distinct_keys"),
            F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
            F.count(F.when(present & (F.col("n") > 1), True)).alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*")
        report = part if report is None else report.unionByName(part)
    return report


def foreign_key_check(star: Star) -> DataFrame:
    """Per reference: fact keys and fact rows that find no dimension row.

    The fact is folded to one row per key before the anti join.
    """
    report = None
    for name, key in FOREIGN_KEYS.items():
        held = star.fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = held.join(star.tables()[name], key, "left_anti")
        part = lost.agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*")
        report = part if report is None else report.unionByName(part)
    return report
