"""Small hand-made inputs."""

from datetime import date, datetime

RAW = (
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity INT, InvoiceDate STRING, "
    "UnitPrice DOUBLE, CustomerID DOUBLE, Country STRING"
)
FACT = (
    "invoice_no STRING, stock_code STRING, customer_id BIGINT, date_key DATE, invoice_datetime TIMESTAMP_NTZ, "
    "quantity INT, unit_price DOUBLE, revenue DOUBLE"
)


def raw_row(invoice="1", stock="A", text="thing", quantity=1, when="01/02/2020 10:00", price=2.5, customer=7.0,
            country="UK"):
    return (invoice, stock, text, quantity, when, price, customer, country)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def fact(spark, *rows):
    """Rows of (invoice, stock, customer, 'YYYY-MM-DD', quantity, price)."""
    full = []
    for invoice, stock, customer, day, quantity, price in rows:
        d = date.fromisoformat(day)
        full.append((invoice, stock, customer, d, datetime(d.year, d.month, d.day), quantity, price, quantity * price))
    return spark.createDataFrame(full, FACT)


def star(spark, *rows, countries=None):
    """A star whose products are described by their code."""
    from pyspark.sql import functions as F

    from tillwise.operators.star import Star, dim_date

    table = fact(spark, *rows)
    names = countries or {}
    customers = spark.createDataFrame(
        [(c, names.get(c, "UK")) for c in sorted({r[2] for r in rows})], "customer_id BIGINT, country STRING"
    )
    products = table.select("stock_code").distinct().select(
        "stock_code", F.col("stock_code").alias("description"), F.lit(1.0).alias("unit_price_avg")
    )
    return Star(table, customers, products, dim_date(table.select(F.col("invoice_datetime").alias("InvoiceDate"))))
