"""The raw sales feed and the statement table derived from the order tables.

The order tables carry no defects, so the derivation adds them by rule:
cancelled invoices, missing customers and descriptions, returns, free items,
unreadable dates, spelling variants and exact duplicates.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.operators.joins import join_lookup
from tillwise.sources.files import spread

LINEITEM_SCHEMA = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING"
)
ORDERS_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ"
PART_SCHEMA = "p_partkey BIGINT, p_name STRING"
CUSTOMER_SCHEMA = "c_custkey BIGINT, c_nationkey INT"
NATION_SCHEMA = "n_nationkey INT, n_name STRING"

SCHEMAS = {
    "lineitem": LINEITEM_SCHEMA,
    "orders": ORDERS_SCHEMA,
    "part": PART_SCHEMA,
    "customer": CUSTOMER_SCHEMA,
    "nation": NATION_SCHEMA,
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The eight-column raw feed.

    Customers get their nation and orders their customer first, so the line items meet
    two lookups instead of four. Parts come last and are met by the stock code, as it is written
    in the feed: rows shuffled for that join already lie as dropping duplicates needs them, and
    copies of a row are in one place. Duplicates come from an explode on the joined row, which
    reads everything once where a union would join twice.
    """
    line, orders, part, customer, nation = (
        read_table(spark, folder, name) for name in SCHEMAS
    )
    homes = join_lookup(
        customer.withColumnRenamed("c_nationkey", "n_nationkey"), nation, "n_nationkey"
    ).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    buyers = join_lookup(orders, homes, "o_custkey", customer.count())
    ordered = join_lookup(
        spread(line).withColumn("o_orderkey", F.col("l_orderkey")),
        buyers,
        "o_orderkey",
        orders.count(),
        counted_on=line.select(F.col("l_orderkey").alias("o_orderkey")),
    )
    joined = join_lookup(
        ordered.withColumn("StockCode", F.col("l_partkey").cast("string")),
        part.select(F.col("p_partkey").cast("string").alias("StockCode"), "p_name"),
        "StockCode",
        counted_on=line.select(F.col("l_partkey").cast("string").alias("StockCode")),
    )

    order_text = F.col("o_orderkey").cast("string")
    day = F.col("o_orderdate").cast("string")
    date_text = F.concat(
        F.substring(day, 6, 2), F.lit("/"), F.substring(day, 9, 2), F.lit("/"),
        F.substring(day, 1, 4), F.lit(" "), F.substring(day, 12, 5),
    )
    pieces = F.col("l_quantity").cast("int")
    cancelled = (F.col("l_returnflag") == "R") & (F.col("o_orderkey") % 10 == 0)
    no_text = (F.col("l_orderkey") + F.col("l_linenumber")) % 41 == 0
    shouting = (F.col("l_orderkey") + F.col("l_partkey")) % 7 == 0
    returned = (F.col("l_orderkey") + F.col("l_partkey")) % 97 == 0
    bad_date = (F.col("l_orderkey") + F.col("l_suppkey")) % 101 == 0
    free = (F.col("l_orderkey") * 3 + F.col("l_partkey")) % 89 == 0
    anonymous = (F.col("l_orderkey") + F.col("l_linenumber")) % 33 == 0
    repeated = F.col("l_partkey") % 50 == 0

    return (
        joined.select(
            F.when(cancelled, F.concat(F.lit("C"), order_text)).otherwise(order_text).alias("InvoiceNo"),
            "StockCode",
            F.when(no_text, F.lit(None))
            .when(shouting, F.upper("p_name"))
            .otherwise(F.col("p_name"))
            .alias("Description"),
            F.when(returned, -pieces).otherwise(pieces).alias("Quantity"),
            F.when(bad_date, F.lit("not-a-date")).otherwise(date_text).alias("InvoiceDate"),
            F.when(free, F.lit(0.0))
            .otherwise(F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / F.lit(100.0))
            .alias("UnitPrice"),
            F.when(anonymous, F.lit(None)).otherwise(F.col("o_custkey").cast("double")).alias("CustomerID"),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit("NATION_0"))
            .otherwise(F.col("n_name"))
            .alias("Country"),
            F.explode(F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def _statement(kind, order_text, customer_text):
    """One of eight statement shapes, good and bad."""
    return (
        F.when(kind == 0, F.lit("SELECT count(*) FROM fact_sales"))
        .when(kind == 1, F.concat(F.lit("WITH t AS (SELECT 1 AS x) SELECT "), customer_text, F.lit(" FROM t;")))
        .when(kind == 2, F.lit("drop table fact_sales"))
        .when(kind == 3, F.lit("SELECT 1; SELECT 2"))
        .when(kind == 4, F.lit("  ;; "))
        .when(kind == 5, F.lit("SELECT replace(country, 'a', 'b') FROM dim_customer"))
        .when(
            kind == 6,
            F.concat(F.lit("Here:\n```sql\nselect "), order_text, F.lit(";\n```\ndone")),
        )
        .otherwise(F.lit("SELECTED x"))
    )


def statements(spark: SparkSession, folder: str) -> DataFrame:
    """One model answer per order: ``stmt_id``, ``stmt_text``."""
    orders = spread(read_table(spark, folder, "orders"))
    return orders.select(
        F.col("o_orderkey").alias("stmt_id"),
        _statement(
            F.col("o_orderkey") % 8,
            F.col("o_orderkey").cast("string"),
            F.col("o_custkey").cast("string"),
        ).alias("stmt_text"),
    )


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Two model answers per order, the second one of another shape.

    Columns: ``question_id, user_question, asked_at, attempt, answer, row_count``.
    The row count stands for the size of the result, had the statement been run.
    """
    orders = spread(read_table(spark, folder, "orders"))
    order_text = F.col("o_orderkey").cast("string")
    customer_text = F.col("o_custkey").cast("string")
    return orders.select(
        F.col("o_orderkey").alias("question_id"),
        F.concat(F.lit("Question about order "), order_text).alias("user_question"),
        F.col("o_orderdate").alias("asked_at"),
        F.col("o_custkey").alias("row_count"),
        F.posexplode(
            F.array(
                _statement(F.col("o_orderkey") % 8, order_text, customer_text),
                _statement((F.col("o_orderkey") + 3) % 8, order_text, customer_text),
            )
        ).alias("position", "answer"),
    ).select(
        "question_id",
        "user_question",
        "asked_at",
        (F.col("position") + 1).alias("attempt"),
        "answer",
        "row_count",
    )
