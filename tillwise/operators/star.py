"""Star schema: one fact table at order-line grain and three dimensions."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.calendar import weekend_flag
from tillwise.functions.numeric import money_total
from tillwise.operators.ranking import with_position

# The columns that a stored fact table has besides those of ``fact_sales``.
LINE_ID = "line_id"
LINE_SLOT = "line_slot"
YEAR_MONTH = "year_month"
STORED_ONLY = (LINE_ID, YEAR_MONTH)

FACT_ORDER = ("invoice_datetime", "invoice_no", "stock_code", "customer_id", "quantity", "unit_price")


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    customers: DataFrame
    products: DataFrame
    dates: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fact_sales": self.fact,
            "dim_customer": self.customers,
            "dim_product": self.products,
            "dim_date": self.dates,
        }

    def register(self) -> None:
        """Make the four tables known to SQL by their names."""
        for name, table in self.tables().items():
            table.createOrReplaceTempView(name)


def fact_sales(cleaned: DataFrame) -> DataFrame:
    """The fact columns, without line numbers: a projection, so reports that read it
    still only scan the columns they use."""
    return cleaned.select(
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("CustomerID").alias("customer_id"),
        F.to_date("InvoiceDate").alias("date_key"),
        F.col("InvoiceDate").alias("invoice_datetime"),
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
        F.col("Revenue").alias("revenue"),
    )


def number_lines(fact: DataFrame) -> DataFrame:
    """Fact rows with ``line_id`` 1..n in time order.

    The sort spreads rows over tasks by the whole key, so one busy day, invoice or
    customer does not end up in one task, and the rows come out clustered by time.
    """
    numbered = with_position(fact, FACT_ORDER, "line_id")
    return numbered.select((F.col("line_id") + 1).alias("line_id"), *fact.columns)


def in_line_order(fact: DataFrame) -> DataFrame:
    """The fact sorted by time over all tasks, as it is stored: each row with its slot, that is
    its slice of the sort and its place there, and its month.

    Written by month right away, this gives few files per month, still splits a busy
    month over several tasks, and the rows are written once: line numbers follow from the slots
    and the sizes of the slices.
    """
    slotted = fact.orderBy(*FACT_ORDER).withColumn(LINE_SLOT, F.monotonically_increasing_id())
    return slotted.withColumn(YEAR_MONTH, F.date_format("date_key", "yyyy-MM"))


def lines_before(stored: DataFrame) -> list[int]:
    """Rows before each slice of a stored fact: one number per slice of the sort."""
    slice_of = F.shiftright(LINE_SLOT, 33).alias("slice")
    sizes = {r["slice"]: r["n"] for r in stored.groupBy(slice_of).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for number in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(number, 0)
    return before


def with_line_ids(stored: DataFrame, before: list[int]) -> DataFrame:
    """A stored fact with ``line_id`` 1..n in place of the slots: arithmetic on each row, and
    nothing at all where no one asks for the number."""
    starts = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    place = F.col(LINE_SLOT).bitwiseAND(F.lit((1 << 33) - 1))
    line_id = F.get(starts, F.shiftright(LINE_SLOT, 33).cast("int")) + place + 1
    others = [c for c in stored.columns if c != LINE_SLOT]
    return stored.select(line_id.alias(LINE_ID), *others)


def _most_frequent(column: str):
    """Smallest of the most frequent values, from one row per value with its count."""
    return F.min(F.struct(-F.col("seen"), F.col(column)))[column]


def dim_customer(cleaned: DataFrame) -> DataFrame:
    """One row per customer with the most frequent country.

    Counting per (customer, country) first keeps a customer with a large share of the
    rows spread out; the second step sees one row per country.
    """
    counted = cleaned.groupBy("CustomerID", "Country").agg(F.count("Country").alias("seen"))
    return counted.groupBy(F.col("CustomerID").alias("customer_id")).agg(
        _most_frequent("Country").alias("country")
    )


def dim_product(cleaned: DataFrame) -> DataFrame:
    """One row per stock code: most frequent description and mean price over lines.

    Lines without a stock code stay in the fact table only.
    """
    counted = (
        cleaned.where(F.col("StockCode").isNotNull())
        .groupBy("StockCode", "Description")
        .agg(
            F.count("Description").alias("seen"),
            F.count(F.lit(1)).alias("lines"),
            money_total("UnitPrice").alias("prices"),
        )
    )
    return counted.groupBy(F.col("StockCode").alias("stock_code")).agg(
        _most_frequent("Description").alias("description"),
        (F.sum("prices").cast("double") / F.sum("lines")).alias("unit_price_avg"),
    )


def dim_date(cleaned: DataFrame) -> DataFrame:
    """One row per day that occurs in the data."""
    day = F.col("date_key")
    return (
        cleaned.select(F.to_date("InvoiceDate").alias("date_key"))
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.quarter(day).alias("quarter"),
            F.date_format(day, "EEEE").alias("day_of_week"),
            weekend_flag(day).alias("is_weekend"),
        )
    )


def build_star(cleaned: DataFrame) -> Star:
    """The four tables as lazy plans over a cleaned feed."""
    return Star(fact_sales(cleaned), dim_customer(cleaned), dim_product(cleaned), dim_date(cleaned))


def load_report(star: Star) -> DataFrame:
    """Rows per table. Counting reads no column data."""
    parts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in star.tables().items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
